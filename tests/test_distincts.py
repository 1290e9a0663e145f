"""Mergeable distinct areas and footer answers against plain counts."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from areatab.operators import distincts, footers
from areatab.operators.publish import dataset_stats

SCHEMA = "codigo_variable string, id_geo string, conteo long"


def rows(spark, spec):
    """{variable: (first area, number of areas, rows an area)}"""
    data = [(v, f"{a:09d}" if a >= 0 else None, k) for v, (first, n, times) in spec.items() for a in range(first, first + n) for k in range(times)]
    return spark.createDataFrame(data, SCHEMA)


def test_adding_and_replacing_variables_equals_counting_again(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "d")
    now = {}
    assert tuple(distincts.stats(spark, folder).first()) == (0, 0, 0)
    # more areas than a bucket holds, NULL areas (-1), then a variable replaced by fewer and other areas, then one that adds none
    for step in ({"A": (0, 40_000, 1), "B": (39_990, 30, 2)}, {"C": (-1, 5, 3)}, {"A": (100, 20, 1)}, {"D": (50_000, 3, 1), "B": (39_990, 1, 1)}, {"E": (100, 2, 4)}):
        now |= step
        distincts.update(spark, folder, rows(spark, step))
        assert tuple(distincts.stats(spark, folder).first()) == tuple(dataset_stats(rows(spark, now)).first()), step
    places = spark.read.parquet(f"{folder}/posiciones")
    assert places.count() == places.select("id_geo").distinct().count() == places.select("posicion").distinct().count()
    assert places.agg(F.max("posicion") + 1).first()[0] == places.count()  # no gaps


def test_numbers_depend_on_the_areas_only(spark):
    long = rows(spark, {"A": (0, 500, 2)})
    one = {tuple(r) for r in distincts.number_areas(long.repartition(7)).collect()}
    assert one == {tuple(r) for r in distincts.number_areas(long.coalesce(1)).collect()}
    assert sorted(p for _, p in one) == list(range(500))


def test_statistics_take_one_shuffle_and_no_long_table(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "d")
    distincts.update(spark, folder, rows(spark, {"A": (0, 10, 1)}))
    plan = distincts.stats(spark, folder)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan and "id_geo" not in plan


def explained(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_footers_answer_without_pages(spark, tmp_dir):
    path, empty = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "e")
    df = rows(spark, {"A": (0, 30, 2), "B": (7, 3, 2)}).withColumn("k", F.when(F.col("conteo") > 0, F.col("id_geo").cast("int")))
    df.coalesce(1).write.partitionBy("codigo_variable").parquet(path)
    df.where("false").write.parquet(empty)
    found = footers.footer_ranges(spark, {"t": (path, "k"), "e": (empty, "k")})
    assert sorted(map(tuple, found.collect())) == [("e", 0, None, None), ("t", 66, 0, 29)]
    plan = explained(footers.footer_range(spark, path, "k"))
    assert "PushedAggregation: [COUNT(*), MIN(k), MAX(k)]" in plan and "partial_min(k" not in plan
    by = footers.footer_variables(spark, path)
    assert sorted(map(tuple, by.collect())) == [("A", 60), ("B", 6)]
    assert "PushedAggregation: [COUNT(*)]" in explained(by) and "PushedGroupBy: [codigo_variable]" in explained(by)
    with pytest.raises(ValueError, match="extremes of id_geo"):
        footers.footer_range(spark, path, "id_geo")
    # the session itself is left as it was
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_a_file_with_nulls_only_is_scanned(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows(spark, {"A": (0, 30, 1), "B": (-1, 3, 1)}).select("codigo_variable", F.col("id_geo").cast("int").alias("k")).coalesce(1).write.partitionBy("codigo_variable").parquet(path)
    assert tuple(footers.footer_range(spark, path, "k").first()) == (33, 0, 29)
    assert sorted(map(tuple, footers.footer_variables(spark, path).collect())) == [("A", 30), ("B", 3)]
