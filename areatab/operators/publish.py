"""Publishing: the long table, the metadata table, run manifests and stats.

Writes go to the shared folder under ``spark.checkpoint.dir`` (see
``areatab.session``). The long table is range-partitioned and sorted by
``id_geo`` so Parquet min/max statistics prune area lookups, compressed with
ZSTD; the per-variable layout is ``partitionBy('codigo_variable')`` with
dynamic partition overwrite, which replaces the reference's one file per
variable and makes a re-run idempotent per variable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areatab.functions.codes import code_entity, code_name
from areatab.operators.broadcast import bounded_broadcast

LONG_COLUMNS = (
    "id_geo",
    "valor_provincia",
    "etiqueta_provincia",
    "valor_departamento",
    "etiqueta_departamento",
    "valor_fraccion",
    "etiqueta_fraccion",
    "valor_radio",
    "etiqueta_radio",
    "codigo_variable",
    "valor_categoria",
    "etiqueta_categoria",
    "conteo",
)

METADATA_COLUMNS = (
    "valor_categoria",
    "etiqueta_categoria",
    "codigo_variable",
    "nombre_variable",
    "etiqueta_variable",
    "entidad",
)

LONG_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "conteo" else T.StringType(), True) for c in LONG_COLUMNS]
)


def to_long(df: DataFrame, year: int | None = None) -> DataFrame:
    """Published column names and order; ``conteo`` is always long.

    One schema for every input model: levels without names (fraction and
    radio labels are only in some sources) are NULL columns, never dropped.
    Area codes are not comparable across census years, so tables of several
    years must never be stacked on ``id_geo`` alone: pass ``year`` to add a
    leading ``anio`` column when stacking.
    """
    cols = [] if year is None else [F.lit(int(year)).alias("anio")]
    for c in LONG_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c).cast("long" if c == "conteo" else "string").alias(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    return df.select(*cols)


def to_metadata(long: DataFrame, variable_labels: DataFrame | None = None) -> DataFrame:
    """Distinct category x variable dictionary with variable labels.

    Distinct is taken first on the three label columns (partial aggregation
    map side), then the small result is joined to the variable labels
    ``(codigo_variable, etiqueta_variable[, nombre_variable, entidad])``.
    Name and entity come from that dictionary when it has them (names may
    contain ``_``); otherwise they are cut from the code.
    """
    cats = long.select("valor_categoria", "etiqueta_categoria", "codigo_variable").distinct()
    name = code_name("codigo_variable")
    entity = code_entity("codigo_variable")
    vlabel = name
    if variable_labels is not None:
        extra = [c for c in ("nombre_variable", "entidad") if c in variable_labels.columns]
        vl = variable_labels.select(
            "codigo_variable", F.col("etiqueta_variable").alias("_vlabel"), *[F.col(c).alias(f"_{c}") for c in extra]
        )
        cats = cats.join(bounded_broadcast(vl), "codigo_variable", "left")
        if "nombre_variable" in extra:
            name = F.coalesce(F.col("_nombre_variable"), name)
        if "entidad" in extra:
            entity = F.coalesce(F.col("_entidad"), entity)
        vlabel = F.coalesce(F.col("_vlabel"), name)
    return cats.select(
        "valor_categoria",
        "etiqueta_categoria",
        "codigo_variable",
        name.alias("nombre_variable"),
        vlabel.alias("etiqueta_variable"),
        entity.alias("entidad"),
    )


def write_long(
    long: DataFrame,
    path: str,
    partitions: int | None = None,
    max_records_per_file: int = 1_000_000,
    mode: str = "overwrite",
) -> None:
    """Write sorted by ``id_geo``: range partitions, sorted within, ZSTD."""
    n = partitions or int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        long.repartitionByRange(n, "id_geo")
        .sortWithinPartitions("id_geo", "codigo_variable", "valor_categoria")
        .write.mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


#: Rows of a Parquet row group, the unit that statistics skip.
ROW_GROUP = 1_000_000
#: Cells into which each side of the (area, variable) plane is cut, a power of two.
CELLS = 64


def clustered(long: DataFrame, codes: Sequence[str], cells: int = CELLS) -> DataFrame:
    """``long`` with ``_z``: the place of the row's cell along a Z curve over areas and variables.

    Areas are cut into ``cells`` ranges of equal numbers of areas (a sample of
    the distinct ones gives the bounds), variables into as many runs of ``codes``
    (the sorted list of variables, metadata); a cell's place takes the two
    numbers' bits in turn, so rows that are near in both lie near on the curve.
    """
    spark, bits = long.sparkSession, (cells - 1).bit_length()
    areas = long.select("id_geo").distinct().repartitionByRange(cells, "id_geo").select("id_geo", F.spark_partition_id().alias("_a"))
    order = sorted(codes)
    numbered = spark.createDataFrame([(c, k * cells // max(1, len(order))) for k, c in enumerate(order)], "codigo_variable string, _v int")
    placed = long.join(areas.withColumnRenamed("id_geo", "_area"), F.col("id_geo").eqNullSafe(F.col("_area")), "left").drop("_area")
    placed = placed.join(F.broadcast(numbered), "codigo_variable", "left")  # one literal row a variable
    bit = lambda c, k: F.shiftleft(F.shiftright(F.coalesce(F.col(c), F.lit(0)), k).bitwiseAND(F.lit(1)), 2 * k)
    z = F.lit(0)
    for k in range(bits):
        z = z + bit("_a", k) + 2 * bit("_v", k)
    return placed.withColumn("_z", z).drop("_a", "_v")


def write_clustered(
    long: DataFrame, path: str, codes: Sequence[str], partitions: int | None = None, row_group: int = ROW_GROUP, cells: int = CELLS, mode: str = "overwrite"
) -> None:
    """Write for filters on areas and on variables alike: along a Z curve over both, in row groups of at most ``row_group`` rows.

    A row group covers a small piece of both, so its least and greatest area and
    variable, and the page indexes within, let a reader skip it for either
    filter; sorted by area alone, a variable would be in every row group.
    """
    n = partitions or int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        clustered(long, codes, cells).repartitionByRange(n, "_z", "id_geo", "codigo_variable")
        .sortWithinPartitions("_z", "id_geo", "codigo_variable", "valor_categoria").drop("_z")
        .write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", row_group)
        .parquet(path)
    )


def write_by_variable(
    long: DataFrame, path: str, partitions: int | None = None, replace_all: bool = False, keys: Sequence[str] = ()
) -> None:
    """One folder per variable (under one per value of ``keys``); re-running a variable replaces only its folder
    (``replace_all=True`` replaces the whole table instead).

    Range partitioning on (variable, area) keeps each task on a contiguous
    slice: a large variable spans several tasks, small ones share a task,
    so the file count stays near partitions + variables.
    """
    n = partitions or int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        long.repartitionByRange(n, "codigo_variable", "id_geo")
        .sortWithinPartitions("codigo_variable", "id_geo")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("compression", "zstd")
        .partitionBy(*keys, "codigo_variable")
        .parquet(path)
    )


def export(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """Write any query result as Parquet (``COPY (query) TO path``)."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def read_long(spark: SparkSession, path: str) -> DataFrame:
    """Read a published long table with its fixed schema (codes stay text)."""
    return spark.read.schema(LONG_SCHEMA).parquet(path).select(*LONG_COLUMNS)


def produced_variables(long: DataFrame) -> DataFrame:
    """``(codigo_variable, n_rows)`` of what a long table holds."""
    return long.groupBy("codigo_variable").agg(F.count(F.lit(1)).alias("n_rows"))


def pending_variables(requested: DataFrame, produced: DataFrame) -> DataFrame:
    """Requested variables not yet produced (resume = anti join)."""
    return requested.select("codigo_variable").distinct().join(
        produced.select("codigo_variable"), "codigo_variable", "left_anti"
    )


def run_manifest(
    requested: DataFrame, produced: DataFrame, ran: Sequence[str] | None = None, errors: Mapping[str, str] | None = None
) -> DataFrame:
    """``(codigo_variable, status, n_rows, mensaje)`` for every requested variable.

    status: ``error`` (named in ``errors``, with its text), ``success`` (rows
    produced), ``empty`` (named in ``ran``, but every value was dropped) or
    ``missing`` (requested but never run, e.g. unknown).
    """
    req = requested.select("codigo_variable").distinct()
    out = req.join(produced.select("codigo_variable", "n_rows"), "codigo_variable", "left")
    rows = [(c, True, None) for c in ran or () if c not in (errors or {})] + [(c, False, m) for c, m in (errors or {}).items()]
    known = produced.sparkSession.createDataFrame(rows, "codigo_variable string, _ran boolean, mensaje string")
    out = out.join(F.broadcast(known), "codigo_variable", "left")  # one literal row a variable
    status = (
        F.when(F.col("mensaje").isNotNull(), F.lit("error"))
        .when(F.col("n_rows") > 0, F.lit("success"))
        .when(F.col("_ran") | (F.col("n_rows") == 0), F.lit("empty"))
        .otherwise(F.lit("missing"))
    )
    return out.select(
        "codigo_variable", status.alias("status"), F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows"), "mensaje"
    )


def resume_counts(requested: DataFrame, produced: DataFrame) -> DataFrame:
    """``(n_done, n_todo)``: requested variables already produced vs. still pending."""
    req = requested.select("codigo_variable").distinct()
    flag = req.join(produced.select("codigo_variable").distinct().withColumn("_done", F.lit(True)), "codigo_variable", "left")
    done = F.coalesce(F.col("_done"), F.lit(False))
    return flag.agg(
        F.sum(done.cast("long")).alias("n_done"),
        F.sum((~done).cast("long")).alias("n_todo"),
    )


def dataset_stats(long: DataFrame) -> DataFrame:
    """Rows, distinct variables, distinct areas (exact counts)."""
    return long.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("codigo_variable").alias("unique_vars"),
        F.countDistinct("id_geo").alias("unique_geos"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(tabla, n)``: row count of each named table, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tabla"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
