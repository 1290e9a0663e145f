"""Counts and extremes of stored Parquet tables from their footers alone.

Every row group's footer holds its rows and each column's least and greatest
value. The second version of Spark's Parquet source answers ``count``, ``min``
and ``max`` from them (aggregate push-down), so a table of any size costs its
footers, and no page of data is read. Sessions read Parquet by the first version
by default, so these queries run in a session of their own that differs in two
settings only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column types whose extremes footers hold whole (those of texts may be cut off, and decimals' are not used).
WHOLE = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads Parquet by the second version and pushes aggregates down."""
    own = spark.newSession()
    first = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in first if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_range(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``(n, menor, mayor)`` of one stored table, one row, answered from footers.

    A file in which the column is NULL throughout has no extremes in its footer,
    which Spark takes for an error, and a table without rows gives it none to
    count in; such tables are scanned instead. The footers tell, so they are asked first.
    """
    own = footer_session(spark)

    def one(session: SparkSession) -> DataFrame:
        return session.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("menor"), F.max(column).alias("mayor"))

    kind = own.read.parquet(path).schema[column].dataType.simpleString()
    if kind not in WHOLE:
        raise ValueError(f"{path}: footers don't hold the extremes of {column} ({kind})")
    pushed = one(own)
    try:
        known = pushed.first()["n"] is not None
    except Exception as e:
        if "No min/max found" not in str(e):
            raise
        known = False
    if known:
        return pushed
    own.conf.set("spark.sql.parquet.aggregatePushdown", "false")
    return one(own)


def footer_ranges(spark: SparkSession, tables: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``(tabla, n, menor, mayor)`` of each ``{tabla: (path, column)}``, extremes as whole numbers.

    NULLs count as rows and are no extremes; an empty table has 0 rows and NULL
    extremes. A column whose extremes footers don't hold whole is an error.
    """
    out = None
    for name, (path, column) in tables.items():
        row = footer_range(spark, path, column)
        row = row.select(F.lit(name).alias("tabla"), "n", F.col("menor").cast("long").alias("menor"), F.col("mayor").cast("long").alias("mayor"))
        out = row if out is None else out.unionByName(row)
    return out


def footer_variables(spark: SparkSession, path: str) -> DataFrame:
    """``(codigo_variable, n_rows)`` of a table stored with a folder for each variable."""
    df = footer_session(spark).read.parquet(path)
    return df.groupBy("codigo_variable").agg(F.count(F.lit(1)).alias("n_rows")).select(F.col("codigo_variable").cast("string").alias("codigo_variable"), "n_rows")
