import os

from areatab.plans.census import Census
from areatab.plans.job import read_current, read_outputs, run_census
from areatab.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_resume_computes_only_pending(spark, tmp_dir):
    c = Census(spark, SF)
    out = os.path.join(tmp_dir, "run")
    r1 = run_census(c, out, entities=("PERSONA",))
    assert set(r1.computed) == set(c.variables["PERSONA"]) and r1.skipped == []
    r2 = run_census(c, out)
    assert set(r2.skipped) == set(c.variables["PERSONA"])
    assert set(r2.computed) == set(c.variables["HOGAR"]) | set(c.variables["VIVIENDA"])
    r3 = run_census(c, out)
    assert r3.computed == []
    got = read_outputs(spark, r3)
    expected = QUERIES["publish_long"](spark, SF)
    assert sorted(map(tuple, got["largo"].collect())) == sorted(map(tuple, expected.collect()))
    man = {r.codigo_variable: r.status for r in got["manifiesto"].collect()}
    assert set(man.values()) == {"skipped"} and len(man) == 6  # the third run reused everything
    assert got["metadatos"].count() == QUERIES["publish_metadata"](spark, SF).count()


def test_changed_inputs_invalidate_resume(spark, tmp_dir):
    from areatab.plans.job import fingerprint

    c = Census(spark, SF)
    out = os.path.join(tmp_dir, "run")
    run_census(c, out, entities=("HOGAR", "VIVIENDA"))
    man = read_current(spark, out)["manifiesto"].first()
    assert man.huella == fingerprint(spark, [c.table(t) for t in ("lineitem", "orders", "customer", "nation", "region")])
    # same inputs: nothing recomputed
    assert run_census(c, out, entities=("VIVIENDA",)).computed == []
    # a different input folder (different files): recomputed, and the old
    # household variables are gone instead of mixed with the new ones
    c2 = Census(spark, "/root/testdata/sf0.01")
    r = run_census(c2, out, entities=("VIVIENDA",))
    assert r.computed == ["VIVIENDA_SEGMENT"]
    codes = {x[0] for x in read_outputs(spark, r)["largo"].select("codigo_variable").distinct().collect()}
    assert codes == {"VIVIENDA_SEGMENT"}


def _codes(spark, result):
    return {x[0] for x in read_outputs(spark, result)["largo"].select("codigo_variable").distinct().collect()}


def test_other_policy_is_another_output(spark, tmp_dir):
    c = Census(spark, SF)
    out = os.path.join(tmp_dir, "run")
    run_census(c, out, entities=("PERSONA",))
    r = run_census(c, out, entities=("PERSONA",), null_policy="drop")
    assert r.skipped == [] and set(r.computed) == set(c.variables["PERSONA"])
    assert read_outputs(spark, r)["largo"].where("valor_categoria = 'Sin dato'").count() == 0
    # and the first one is still there for the asking
    assert run_census(c, out, entities=("PERSONA",)).computed == []


def test_crash_before_the_manifest_then_new_input(spark, tmp_dir):
    import pytest

    from areatab.plans.job import run_resumable

    out = os.path.join(tmp_dir, "run")

    def run(n, codes, fail=False):
        path = os.path.join(tmp_dir, f"input-{n}")
        if not os.path.exists(path):
            spark.range(n).selectExpr("'020070101' AS id_geo", "cast(id % 2 as string) AS X", "cast(id % 3 as string) AS Y").write.parquet(path)
        rows = spark.read.parquet(path)

        def publish_fn(freq):
            if fail:
                raise InterruptedError
            from areatab.operators.publish import to_long

            return to_long(freq)

        return run_resumable(spark, {"P": (rows, {f"P_{k}": k for k in codes})}, publish_fn, out, [rows])

    with pytest.raises(InterruptedError):
        run(2, ["X"], fail=True)
    r = run(5, ["X", "Y"])
    assert r.skipped == [] and sorted(r.computed) == ["P_X", "P_Y"]
    totals = read_outputs(spark, r)["largo"].groupBy("codigo_variable").sum("conteo").collect()
    assert {tuple(t) for t in totals} == {("P_X", 5), ("P_Y", 5)}
    # what the crash left is whole and is taken over for its own input
    again = run(2, ["X"])
    assert again.skipped == ["P_X"] and _codes(spark, again) == {"P_X"}
    # asking for less publishes less
    assert _codes(spark, run(5, ["Y"])) == {"P_Y"}


def test_failing_and_empty_variables_are_reported(spark, tmp_dir):
    from areatab.operators.publish import to_long
    from areatab.plans.job import run_resumable

    rows = spark.createDataFrame([("020070101", "1", None)], "id_geo string, A string, B string")
    r = run_resumable(spark, {"P": (rows, {"P_A": "A", "P_B": "B", "P_C": "missing"})}, to_long, os.path.join(tmp_dir, "run"), null_policy="drop")
    man = {m.codigo_variable: m for m in read_outputs(spark, r)["manifiesto"].collect()}
    assert {k: m.status for k, m in man.items()} == {"P_A": "success", "P_B": "empty", "P_C": "error"}
    assert "missing" in man["P_C"].mensaje and man["P_A"].mensaje is None


def test_fingerprint_is_one_row_whatever_the_files(spark, tmp_dir):
    from areatab.plans.job import fingerprint

    path = os.path.join(tmp_dir, "many")
    spark.range(40).repartition(20).write.parquet(path)
    a = fingerprint(spark, [spark.read.parquet(path)])
    assert a == fingerprint(spark, [spark.read.parquet(path)])
    spark.range(1).write.mode("append").parquet(path)
    assert a != fingerprint(spark, [spark.read.parquet(path)])


def test_a_run_that_breaks_between_its_tables_is_not_seen(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F

    from areatab.operators import publish
    from areatab.plans.job import run_resumable

    c = Census(spark, SF)
    out = os.path.join(tmp_dir, "run")
    with pytest.raises(FileNotFoundError):
        read_current(spark, out)
    run_census(c, out, entities=("HOGAR",))
    before = {name: sorted(map(str, df.collect())) for name, df in read_current(spark, out).items()}
    # the long table gets written, then the metadata fail
    broken = c.variable_labels().withColumn("etiqueta_variable", F.raise_error(F.lit("no dictionary")))
    sources = {"VIVIENDA": (c.entity("VIVIENDA"), c.variables["VIVIENDA"])}
    with pytest.raises(Exception, match="no dictionary"):
        run_resumable(spark, sources, lambda freq: publish.to_long(freq), out, [c.table("customer")], broken)
    versions = os.listdir(os.path.join(out, "versiones"))
    assert len(versions) == 2 and sum(os.path.exists(os.path.join(out, "versiones", v, "metadatos", "_SUCCESS")) for v in versions) == 1
    assert all(os.path.exists(os.path.join(out, "versiones", v, "largo", "_SUCCESS")) for v in versions)
    assert {name: sorted(map(str, df.collect())) for name, df in read_current(spark, out).items()} == before
    # a reader that has the old pair open keeps it when the next run publishes
    held = read_current(spark, out)
    run_census(c, out, entities=("VIVIENDA",))
    assert sorted(map(str, held["metadatos"].collect())) == before["metadatos"]
    now = read_current(spark, out)
    assert {r.codigo_variable for r in now["largo"].select("codigo_variable").distinct().collect()} == {"VIVIENDA_SEGMENT"}
    assert {r.codigo_variable for r in now["metadatos"].collect()} == {"VIVIENDA_SEGMENT"}
