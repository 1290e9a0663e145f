"""Delimited files whose dialects have drifted: a verdict for each file, and one read over all of them.

Files of one folder may differ in delimiter and charset. Both are told from the
lines themselves, in one aggregate over the folder: the delimiter that parts the
lines of a file into the same number of fields, and UTF-8 unless a line is no
UTF-8. Types are never guessed: every field is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Delimiters told apart; of equally good ones the first wins.
SEPARATORS = (";", ",", "\t", "|")
CHARSETS = ("UTF-8", "ISO-8859-1")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(archivo, lugar, linea)``: every line that isn't empty, as bytes."""
    return spark.read.text(path).where("value <> ''").select(
        F.col("_metadata.file_name").alias("archivo"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("lugar"),
        F.col("value").alias("linea"),
    )


def _fields(line: Column, sep: str) -> Column:
    """Number of fields: delimiters outside quotation marks, and one."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def file_dialects(spark: SparkSession, path: str) -> DataFrame:
    """``(archivo, separador, juego, comillas, regular, n_campos, n_filas, cabecera)`` for every file of a folder.

    ``separador``: the delimiter whose usual number of fields is the highest, or
    NULL if no line has any; ``regular``: all lines have that number of fields;
    ``n_filas``: lines after the header; ``cabecera``: the header's column names.
    """
    counts = [_fields(F.col("linea"), s).alias(f"n{k}") for k, s in enumerate(SEPARATORS)]
    lines = _lines(spark, path).select("*", *counts)
    many = range(len(SEPARATORS))
    by = lines.groupBy("archivo").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("linea", "lugar").alias("primera"), F.count_if(~F.is_valid_utf8("linea")).alias("mal"),
        F.count_if(F.contains("linea", F.lit('"'))).alias("con_comillas"), *(F.mode(f"n{k}", True).alias(f"moda{k}") for k in many),
        *(f(f"n{k}").alias(f"{f.__name__}{k}") for k in many for f in (F.min, F.max)),
    )
    top = F.greatest(*(F.col(f"moda{k}") for k in many))
    which = F.coalesce(*(F.when((F.col(f"moda{k}") == top) & (top > 1), F.lit(k)) for k in many))
    pick = lambda name: F.coalesce(*(F.when(F.col("cual") == k, F.col(f"{name}{k}")) for k in many))
    out = by.withColumn("cual", which).select(
        "archivo", F.coalesce(*(F.when(F.col("cual") == k, F.lit(s)) for k, s in enumerate(SEPARATORS))).alias("separador"),
        F.when(F.col("mal") > 0, F.lit(CHARSETS[1])).otherwise(F.lit(CHARSETS[0])).alias("juego"), (F.col("con_comillas") > 0).alias("comillas"),
        F.coalesce(pick("min") == pick("max"), F.lit(True)).alias("regular"), F.coalesce(pick("moda"), F.lit(1)).cast("int").alias("n_campos"),
        (F.col("n") - 1).alias("n_filas"), "primera",
    )
    text = _decoded(F.col("primera"), F.col("juego"))
    names = F.when(F.col("separador").isNull(), F.array(text)).otherwise(F.split(text, F.concat(F.lit("["), F.col("separador"), F.lit("]"))))
    return out.withColumn("cabecera", F.transform(names, lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))).drop("primera")


def _decoded(line: Column, charset: Column) -> Column:
    raw = line.cast("binary")
    return F.when(charset == CHARSETS[1], F.decode(raw, CHARSETS[1])).otherwise(F.decode(raw, CHARSETS[0]))


def read_mixed(spark: SparkSession, path: str, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """All rows of a folder's files, each read in its own dialect; every column text.

    Every file's header must have ``columns`` in this order, and every line that
    number of fields; otherwise the read fails and names a file. ``strict`` also
    refuses folders with more than one dialect. A line equal to its file's
    header is the header. Quoted fields may hold the delimiter, but no line
    break. Dialects (at most delimiters x charsets) come to the driver, files don't.
    """
    verdicts = file_dialects(spark, path)
    odd = ~F.col("regular") | (F.col("cabecera") != F.array(*map(F.lit, columns)))
    seen = verdicts.groupBy("separador", "juego").agg(F.min(F.when(odd, F.col("archivo"))).alias("mal"), F.min("archivo").alias("uno")).collect()
    wrong = sorted(r.mal for r in seen if r.mal is not None)
    if wrong:
        raise ValueError(f"{wrong[0]}: header or number of fields differs from {';'.join(columns)}")
    if strict and len(seen) > 1:
        raise ValueError("more than one dialect: " + ", ".join(f"{r.uno} {r.separador!r} {r.juego}" for r in sorted(seen, key=lambda r: r.uno)))
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    known = verdicts.select("archivo", "separador", "juego")
    heads = _lines(spark, path).groupBy("archivo").agg(F.min_by("linea", "lugar").alias("primera"))
    lines = _lines(spark, path).select("archivo", "linea").join(known.join(heads, "archivo"), "archivo").where("linea <> primera")
    out = None
    for r in seen:
        own = lines.where(F.col("separador").eqNullSafe(F.lit(r.separador)) & (F.col("juego") == r.juego))
        row = F.from_csv(_decoded(F.col("linea"), F.lit(r.juego)), ", ".join(f"`{c}` string" for c in columns), {"sep": r.separador or SEPARATORS[0], "mode": "FAILFAST"})
        part = own.select(row.alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out
