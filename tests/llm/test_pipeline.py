
import pytest

import corpus_pipeline
from areatab.llm import decontaminate, packing, pii, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_over_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.schema
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    # plain Python over what each stage is given
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    items = [(*r, 1) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    tests = decontaminate.Tests.of(items)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = sorted(docs.collect())
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        assert docs.schema == columns
        after = sorted(docs.collect())
        if name == "toxicity":
            marks = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(before, columns), model).collect()}
            want = [r for r in before if not marks[r.doc_id]]
        elif name == "simhash_near_dedup":
            prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in before}
            seen, want = [], []
            groups = {}
            for r in before:  # by ascending doc_id
                near = [d for d in seen if (prints[d] ^ prints[r.doc_id]).bit_count() <= 3]
                merged = {x for d in near for x in groups[d]} | {r.doc_id}
                for d in merged:
                    groups[d] = merged
                seen.append(r.doc_id)
            want = [r for r in before if min(groups[r.doc_id]) == r.doc_id]
        elif name == "benchmark_decontamination":
            want = [r for r in before if not tests.overlaps(*decontaminate.word_hashes([r.text]))]
        else:
            want = [r.__class__(*[pii.pseudonyms(v or "")[0] if c == "text" else v for c, v in r.asDict().items()]) for r in before]
            want = [tuple(r) for r in want]
            after = [tuple(r) for r in after]
        assert after == want
    _, pack = corpus_pipeline.STAGES[-1]
    packed = pack(spark, docs, SF).collect()
    sizes = {r.doc_id: len((r.text or "").encode().split()) for r in docs.collect()}
    assert {d: sum(r.n_words for r in packed if r.doc_id == d) for d in sizes} == sizes
    for b in {r.bin_id for r in packed if r.bin_id is not None}:
        part = [r for r in packed if r.bin_id == b]
        assert sum(r.n_words for r in part) <= packing.CAPACITY and len({r.source for r in part}) == len(part)


def test_run_and_queries(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(queries.QUERIES)
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_every_query_reads_its_whole_table(spark, name):
    found = queries.QUERIES[name](spark, SF)
    table, key = {"op1": ("pages", "page_id"), "op11": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = {r[0] for r in found.select(key).distinct().collect()}
    assert got <= ids and (got == ids or name.startswith("op10_"))


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
