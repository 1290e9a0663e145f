"""Exact distinct areas from stored bitmaps, one set for each published variable.

Every area has a position, a number given once in a dictionary that only grows.
A variable's areas are bitmaps over these positions, in buckets of Spark's fixed
size, stored beside its row count in the variable's own folder. Adding or
replacing a variable writes that folder only; the statistics of the whole table
are the bitmaps' union, bucket by bucket, and never look at the long table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITIONS = "id_geo string, posicion long"
BITMAPS = "cubeta long, mapa binary, n_filas long, primera boolean, codigo_variable string"
#: Groups in which new areas are numbered side by side.
GROUPS = 512


def number_areas(long: DataFrame, known: DataFrame | None = None, groups: int = GROUPS) -> DataFrame:
    """``(id_geo, posicion)`` of the areas of ``long`` that ``known`` lacks; NULL areas have none.

    New areas are numbered within groups by their hash, a group after the other
    (``groups`` counts, a fixed number, are summed in order), so no task sees
    all areas, and equal inputs give equal numbers. Positions begin after the
    highest known one and have no gaps.
    """
    areas = long.select("id_geo").where("id_geo is not null").distinct()
    base = F.lit(0)
    if known is not None:
        areas = areas.join(known.select("id_geo"), "id_geo", "left_anti")
        base = F.coalesce(known.agg(F.max("posicion")).scalar() + 1, F.lit(0))
    areas = areas.withColumn("_g", F.pmod(F.xxhash64("id_geo"), F.lit(groups)).cast("int"))
    sizes = areas.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)  # one row a group
    starts = sizes.select("_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_antes"))
    placed = areas.withColumn("_k", F.row_number().over(Window.partitionBy("_g").orderBy("id_geo")) - 1).join(F.broadcast(starts), "_g")
    return placed.select("id_geo", (base + F.col("_antes") + F.col("_k")).cast("long").alias("posicion"))


def variable_bitmaps(long: DataFrame, positions: DataFrame) -> DataFrame:
    """``(cubeta, mapa, n_filas, primera, codigo_variable)``: each variable's areas as bitmaps, and its rows.

    ``primera`` marks one row a variable. Rows without an area count in
    ``n_filas`` and set no bit. Partial aggregation combines bitmaps map side.
    """
    rows = long.select("codigo_variable", "id_geo").join(positions, "id_geo", "left")
    # an area's rows fall together before they meet: what is aggregated is areas, not rows
    areas = rows.groupBy("codigo_variable", "posicion").agg(F.count(F.lit(1)).alias("n"))
    maps = areas.groupBy("codigo_variable", F.coalesce(F.bitmap_bucket_number("posicion"), F.lit(0)).alias("cubeta")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("posicion")).alias("mapa"), F.sum("n").alias("n_filas")
    )
    first = F.row_number().over(Window.partitionBy("codigo_variable").orderBy("cubeta")) == 1  # a variable's buckets
    return maps.select("cubeta", "mapa", "n_filas", first.alias("primera"), "codigo_variable")


def update(spark: SparkSession, folder: str, long: DataFrame) -> None:
    """Take the variables of ``long`` into the stored bitmaps, instead of what was stored of them; the others stay."""
    known = read(spark, f"{folder}/posiciones", POSITIONS)
    number_areas(long, known).write.mode("append").parquet(f"{folder}/posiciones")
    maps = variable_bitmaps(long, read(spark, f"{folder}/posiciones", POSITIONS))
    (
        maps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("codigo_variable").parquet(f"{folder}/mapas")
    )


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; empty if nothing is there yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def stats(spark: SparkSession, folder: str) -> DataFrame:
    """``(total_rows, unique_vars, unique_geos)`` from the stored bitmaps: one shuffle, by bucket."""
    maps = read(spark, f"{folder}/mapas", BITMAPS)
    buckets = maps.groupBy("cubeta").agg(
        F.bitmap_count(F.bitmap_or_agg("mapa")).alias("areas"), F.sum("n_filas").alias("rows"),
        F.count_if(F.col("primera") & F.col("codigo_variable").isNotNull()).alias("vars"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return buckets.agg(total("rows").alias("total_rows"), total("vars").alias("unique_vars"), total("areas").alias("unique_geos"))
