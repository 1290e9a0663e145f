from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areatab.operators.frequency import check_totals, entity_count, frequencies, frequencies_by_levels

ROWS = [("A1", "M", "1"), ("A1", "F", None), ("A1", None, ""), ("A2", "M", "2"), (None, "M", "1")]
SCHEMA = "id_geo string, sexo string, edad string"


def _freq(spark, policy):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = frequencies(df, {"PERSONA_SEXO": "sexo", "PERSONA_EDAD": "edad"}, null_policy=policy)
    return {(r.id_geo, r.codigo_variable, r.valor_categoria): r.conteo for r in out.collect()}


def test_keep_counts_null_as_sentinel(spark):
    f = _freq(spark, "keep")
    assert f[("A1", "PERSONA_SEXO", "Sin dato")] == 1
    assert f[("A1", "PERSONA_EDAD", "Sin dato")] == 1
    assert f[("A1", "PERSONA_EDAD", "")] == 1
    assert not any(k[0] is None for k in f)  # rows without area are dropped


def test_drop_and_drop_blank(spark):
    d = _freq(spark, "drop")
    assert ("A1", "PERSONA_SEXO", "Sin dato") not in d
    assert d[("A1", "PERSONA_EDAD", "")] == 1
    b = _freq(spark, "drop_blank")
    assert ("A1", "PERSONA_EDAD", "") not in b
    assert b[("A1", "PERSONA_EDAD", "1")] == 1


def test_by_levels(spark):
    df = spark.createDataFrame([("P1", "D1", "M"), ("P1", "D1", "M"), ("P1", "D2", None)], "prov string, dpto string, sexo string")
    out = {tuple(r) for r in frequencies_by_levels(df, "sexo", ["prov", "dpto"], null_policy="keep").collect()}
    assert out == {("P1", "D1", "M", 2), ("P1", "D2", "Sin dato", 1)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["x", "y", None]), st.sampled_from(["1", "2", None])), min_size=1, max_size=40))
def test_totals_invariant(spark, rows):
    df = spark.createDataFrame(rows, "id_geo string, v1 string, v2 string")
    f = frequencies(df, {"E_V1": "v1", "E_V2": "v2"}, null_policy="keep")
    res = check_totals(f, entity_count(df, "E")).collect()
    assert all(r.ok and r.total == len(rows) for r in res)
    d = frequencies(df, {"E_V1": "v1"}, null_policy="drop")
    total = d.agg(F.sum("conteo")).first()[0] or 0
    assert total == sum(1 for r in rows if r[1] is not None)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from([1, 2, 10, None]), st.sampled_from([0, 7, None])),
                min_size=1, max_size=40))
def test_integer_codes_path_equals_text_path(spark, rows):
    df = spark.createDataFrame(rows, "id_geo string, a int, b long")
    for policy in ("keep", "drop", "drop_blank"):
        native = frequencies(df, {"E_A": "a", "E_B": "b"}, null_policy=policy)
        text = frequencies(df, {"E_A": F.col("a").cast("string"), "E_B": F.col("b").cast("string")}, null_policy=policy)
        assert dict(native.dtypes) == dict(text.dtypes)
        assert sorted(map(tuple, native.collect())) == sorted(map(tuple, text.collect())), policy


def test_integer_path_is_planned_on_long_codes(spark):
    import contextlib
    import io

    df = spark.createDataFrame([("A", 1), ("A", None)], "id_geo string, a int")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        frequencies(df, {"E_A": "a"}, null_policy="keep").explain()
    plan = buf.getvalue()
    # grouped on the numeric code; text is made after the aggregate
    assert "_v#" in plan and "partial_count" in plan


def test_rollup_keeps_variables_apart(spark):
    from areatab.operators.frequency import rollup_levels

    f = spark.createDataFrame([("p", "P_X", "A", 1), ("p", "P_Y", "A", 2), ("p", "P_X", "A", 4)], "prov string, codigo_variable string, valor_categoria string, conteo long")
    assert sorted(map(tuple, rollup_levels(f, ["prov"]).collect())) == [("p", "P_X", "A", 5), ("p", "P_Y", "A", 2)]


def test_floating_codes_are_refused(spark):
    import pytest

    from areatab.operators.frequency import frequencies

    df = spark.createDataFrame([("020070101", 1.0, "a")], "id_geo string, x double, y string")
    with pytest.raises(TypeError, match="text or integers"):
        frequencies(df, ["x", "y"])
