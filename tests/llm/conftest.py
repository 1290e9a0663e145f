import pytest

#: Nulls, empty and blank texts, ties, repeated rows, one long text, all Unicode classes.
ODD = [
    (1, None, "src0"), (2, "", None), (3, " \t\n ", "src0"), (4, "one", "src1"), (4, "one", "src1"), (None, "no id at all", None),
    (5, "Ünï çødé – “quoted” words… and\x00 zero", "src2"), (6, "a b " * 30_000, "src0"), (7, "x" * 5_000, "src3"), (7, "another text, same id", "src3"),
]


@pytest.fixture()
def documents(spark):
    """Build a documents table with extra columns whose names operators use inside."""

    def build(rows):
        data = [(i, t, "en", s, None if t is None else len(t), 1, "x", 2.0) for i, t, s in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, key int, spans string, score double")

    return build


@pytest.fixture()
def odd(documents):
    return documents(ODD)


@pytest.fixture()
def no_documents(documents):
    return documents([])


@pytest.fixture()
def odd_rows():
    return list(ODD)
