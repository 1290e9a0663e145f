"""File sources: delimited microdata, category-label files, XML dictionaries.

Codes are read as text with an explicit schema: inference would turn ``02``
into ``2`` (H3). Label files carry their entity and variable in the file
name; the name comes from ``_metadata.file_name`` so one distributed read
covers a whole folder of label files.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areatab.operators.broadcast import bounded_broadcast


# Text of a row whose number of fields is wrong.
MALFORMED = "_malformada"


def path_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, time of the last change) of a file or folder, from its file system's own summary; zeros if it isn't there.

    A folder's time changes as files come and go. No list of files comes to the driver.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return 0, 0, 0
    total = fs.getContentSummary(at)
    return total.getFileCount(), total.getLength(), fs.getFileStatus(at).getModificationTime()


def string_schema(columns: Sequence[str]) -> T.StructType:
    """All-string schema for code-bearing files."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def header_columns(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> list[str]:
    """Column names from the header line only (reads one line, no inference)."""
    first = spark.read.option("encoding", encoding).text(path).limit(1).collect()
    if not first:
        return []
    return [c.strip().strip('"') for c in first[0][0].split(sep)]


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    header: bool = True,
    quote: str = '"',
    malformed: str = "fail",
) -> DataFrame:
    """``sep``-delimited files with a header; every column text unless a schema says otherwise.

    With ``schema=None`` the header of the first file names the columns and all
    of them are read as strings. Every file's own header is held against the
    schema: a file with other columns, or the same in another order, fails the
    read instead of filling the wrong columns. So does a row with too few or
    too many fields (``malformed="fail"``); ``malformed="keep"`` reads what it
    can and adds ``_malformada`` with the row's text (NULL for sound rows), see
    :func:`malformed_rows`. All fields are parsed, or a short row could not be
    told.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError("malformed must be 'fail' or 'keep'")
    if schema is None:
        first = path if isinstance(path, str) else path[0]
        schema = string_schema(header_columns(spark, first, sep, encoding))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if malformed == "keep":
        schema = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", False)
        .option("quote", quote)
        .option("encoding", encoding)
        .option("columnPruning", False)
        .option("mode", "FAILFAST" if malformed == "fail" else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
    )
    return reader.csv(path if isinstance(path, str) else list(path))


def malformed_rows(df: DataFrame) -> DataFrame:
    """``(archivo, n_filas, n_malformadas, n_sin_clave)`` of rows read with ``malformed="keep"``.

    ``n_sin_clave`` counts the rows without a value in the first column.
    """
    key = next(c for c in df.columns if c != MALFORMED)
    rows = df.select(
        F.col("_metadata.file_name").alias("archivo"), F.col(MALFORMED).isNotNull().cast("long").alias("mal"),
        F.col(key).isNull().cast("long").alias("blank"),
    )
    return rows.groupBy("archivo").agg(
        F.count(F.lit(1)).alias("n_filas"), F.sum("mal").alias("n_malformadas"), F.sum("blank").alias("n_sin_clave")
    )


LABEL_SCHEMA = T.StructType(
    [T.StructField("valor_categoria", T.StringType(), True), T.StructField("etiqueta_categoria", T.StringType(), True)]
)


#: Style of label files: names that a folder's listing takes, and where entity and variable stand in them.
LABEL_STYLES = {
    "lower": ("*_labels_*.csv*", r"^(\w+?)_labels_(\w+)\.csv(?:\.gz)?$"),
    "upper": ("*-LABELS.csv*", r"^([^-]+)-([^-]+)-(?:.*-)?LABELS\.csv(?:\.gz)?$"),
}


def _label_rows(spark: SparkSession, path: str, sep: str, encoding: str, skip_unreadable: bool = False) -> DataFrame:
    df = (
        spark.read.schema(LABEL_SCHEMA)
        .option("sep", sep)
        .option("header", True)
        .option("encoding", encoding)
        .option("ignoreCorruptFiles", skip_unreadable)
        .csv(path)
    )
    # source order: file name, then position within the file
    return df.select(
        "valor_categoria",
        "etiqueta_categoria",
        F.col("_metadata.file_name").alias("archivo"),
        F.monotonically_increasing_id().alias("linea"),
    )


def read_label_files(
    spark: SparkSession,
    folder: str,
    style: str = "lower",
    sep: str = ";",
    encoding: str = "UTF-8",
    skip_unreadable: bool = False,
) -> DataFrame:
    """All label files of a folder as ``(codigo_variable, valor_categoria, etiqueta_categoria, archivo, linea)``.

    style "lower": files ``<entity>_labels_<variable>.csv``; code is upper-cased.
    style "upper": files ``<ENTITY>-<VARIABLE>-LABELS.csv``; code kept as written
    (further ``-`` parts before ``LABELS`` are ignored).
    ``linea`` increases with the position in a file (use with ``archivo`` as
    the source order when de-duplicating). A file that can't be read fails the
    read, or is left out with ``skip_unreadable`` (see :func:`check_label_files`).
    """
    if style not in LABEL_STYLES:
        raise ValueError("style must be 'lower' or 'upper'")
    glob, pat = LABEL_STYLES[style]
    rows = _label_rows(spark, f"{folder.rstrip('/')}/{glob}", sep, encoding, skip_unreadable)
    ent = F.regexp_extract("archivo", pat, 1)
    var = F.regexp_extract("archivo", pat, 2)
    code = F.concat_ws("_", ent, var)
    if style == "lower":
        code = F.upper(code)
    out = rows.withColumn("codigo_variable", F.when((ent != "") & (var != ""), code))
    return out.filter(F.col("codigo_variable").isNotNull()).select(
        "codigo_variable", "valor_categoria", "etiqueta_categoria", "archivo", "linea"
    )


@F.arrow_udf(T.BooleanType())
def _breaks_off(content: pa.Array) -> pa.Array:
    """Whether a gzip file can't be unpacked to its end."""

    def broken(data: bytes) -> bool:
        try:
            with gzip.open(io.BytesIO(data)) as f:
                while f.read(1 << 20):
                    pass
        except (OSError, EOFError, zlib.error):
            return True
        return False

    return pa.array([None if x is None else broken(x) for x in content.to_pylist()], pa.bool_())


def check_label_files(spark: SparkSession, folder: str, style: str = "lower", sep: str = ";", header: Sequence[str] | None = None) -> DataFrame:
    """``(archivo, estado, motivo, n_filas)`` for every ``.csv`` file of a folder: is it a sound label file?

    ``estado`` is ``success``, ``empty`` (a header at most) or ``error`` with the
    first of these reasons: ``nombre`` (the name tells no variable), ``ilegible``
    (reading breaks off), ``texto`` (bytes that are no UTF-8), ``cabecera`` (the
    first line isn't two fields, or not those of ``header``), ``campos`` (a row
    with more or fewer fields). Files are judged one by one in one aggregate over
    their lines; a broken one says nothing about the others. Files without a byte
    are in no listing of Spark's and have no row.
    """
    _, pat = LABEL_STYLES[style]
    at = f"{folder.rstrip('/')}/*.csv*"
    files = spark.read.format("binaryFile").load(at).select(F.element_at(F.split("path", "/"), -1).alias("archivo"), "path", "length")
    # Spark's reader passes over a compressed file that breaks off, with what came before: those are unpacked to see
    packed = spark.read.format("binaryFile").load(at).where("path like '%.gz'").select("path", _breaks_off("content").alias("roto"))
    files = files.join(packed, "path", "left").drop("path")
    lines = spark.read.option("ignoreCorruptFiles", True).text(at).select(
        "value", F.col("_metadata.file_name").alias("archivo"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("lugar"),
    ).where("value <> ''")
    fields = lambda c: F.size(F.split(F.regexp_replace(c, '"[^"]*"', ""), f"[{sep}]"))
    seen = lines.groupBy("archivo").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("value", "lugar").alias("primera"),
        F.count_if(~F.is_valid_utf8("value")).alias("n_texto"), F.count_if(fields("value") != 2).alias("n_campos"),
    )
    head = fields("primera") == 2
    if header is not None:
        head = F.transform(F.split("primera", f"[{sep}]"), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit("")))) == F.array(*map(F.lit, header))
    reason = (
        F.when(~F.col("archivo").rlike(pat), "nombre")
        .when(F.col("roto") | (F.col("n").isNull() & (F.col("length") > 0)), "ilegible")
        .when(F.col("n_texto") > 0, "texto")
        .when(~head, "cabecera")
        .when(F.col("n_campos") > 0, "campos")
    )
    rows = F.when(F.col("roto"), 0).otherwise(F.greatest(F.coalesce("n", F.lit(0)) - 1, F.lit(0))).cast("long")
    out = files.join(seen, "archivo", "left").select("archivo", reason.alias("motivo"), rows.alias("n_filas"))
    state = F.when(F.col("motivo").isNotNull(), "error").when(F.col("n_filas") == 0, "empty").otherwise("success")
    return out.select("archivo", state.alias("estado"), "motivo", "n_filas")


def read_sound_label_files(spark: SparkSession, folder: str, checks: DataFrame, style: str = "lower", sep: str = ";") -> DataFrame:
    """The labels of the files that ``checks`` (see :func:`check_label_files`) calls sound; the others are set apart, not read in."""
    rows = read_label_files(spark, folder, style, sep, skip_unreadable=True)
    return rows.join(checks.where("estado = 'success'").select("archivo"), "archivo", "left_semi")


def read_mapped_label_files(
    spark: SparkSession,
    folder: str,
    mapping: DataFrame,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Label files named by an explicit ``(codigo_variable, label_file)`` map.

    Files present in the folder but absent from the map are ignored; map rows
    without a file simply produce no labels.
    """
    rows = _label_rows(spark, f"{folder.rstrip('/')}/*.csv", sep, encoding)
    m = bounded_broadcast(mapping.select("codigo_variable", F.col("label_file").alias("archivo")).filter(F.col("archivo").isNotNull()))
    return rows.join(m, "archivo", "inner").select(
        "codigo_variable", "valor_categoria", "etiqueta_categoria", "archivo", "linea"
    )


# -- XML variable dictionary ---------------------------------------------------


def read_dictionary(spark: SparkSession, path: str, row_tag: str = "Entity") -> DataFrame:
    """Variable dictionary ``(codigo_variable, etiqueta_variable, entidad, nombre_variable)``.

    Each ``<Entity name=..>`` holds ``<Variable name=.. description=..>``
    elements at any depth, wrapped in other elements or not, and entities may
    nest. Spark's XML reader returns the outer entity as a row and everything
    below as struct fields, so the nesting is walked from the inferred schema.
    A variable belongs to the nearest entity around it; a missing description
    is NULL. A file without any variable is an error.
    """
    raw = spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "_").load(path)
    parts: list[DataFrame] = []

    def attribute(st: T.StructType, name: str) -> Column:
        return F.col(f"node.{name}").cast("string") if name in st.fieldNames() else F.lit(None).cast("string")

    def walk(df: DataFrame, st: T.StructType) -> None:
        for f in st.fields:
            many = isinstance(f.dataType, T.ArrayType)
            inner = f.dataType.elementType if many else f.dataType
            if not isinstance(inner, T.StructType):
                continue
            below = F.col(f"node.`{f.name}`")
            child = df.select("entidad", F.explode(below if many else F.array(below)).alias("node")).where("node is not null")
            if f.name == "Variable":
                parts.append(child.select(
                    "entidad", attribute(inner, "_name").alias("nombre_variable"),
                    attribute(inner, "_description").alias("etiqueta_variable"),
                ))
            elif f.name == row_tag:
                walk(child.select(attribute(inner, "_name").alias("entidad"), "node"), inner)
            else:
                walk(child, inner)

    top = raw.select(F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("node")) if raw.columns else raw
    if raw.columns:
        walk(top.select(attribute(raw.schema, "_name").alias("entidad"), "node"), raw.schema)
    if not parts:
        raise ValueError(f"no <Variable> below any <{row_tag}> in {path}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        F.concat_ws("_", "entidad", "nombre_variable").alias("codigo_variable"),
        "etiqueta_variable",
        "entidad",
        "nombre_variable",
    )


# -- introspection --------------------------------------------------------------


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``(tabla, columna, posicion, n_filas, n_nulos)`` for every column.

    One aggregate per table computes all column counts in a single scan; the
    one-row result is unpivoted into one row per column.
    """
    parts = []
    for name, df in tables.items():
        cols = df.columns
        aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)]
        one = df.agg(*aggs)
        stacked = one.select(
            "_rows",
            F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.lit(i + 1).alias("posicion"), F.col(f"_c{i}").alias("nn"))
                                for i, c in enumerate(cols)])).alias("s"),
        )
        parts.append(stacked.select(
            F.lit(name).alias("tabla"), "s.columna", "s.posicion", F.col("_rows").alias("n_filas"),
            (F.col("_rows") - F.col("s.nn")).alias("n_nulos"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``(tabla, columna, posicion, tipo)`` for each table's schema (schema only, no scan)."""
    rows = [
        (name, f.name, i + 1, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "tabla string, columna string, posicion int, tipo string")
