"""Helpers that several operators share: text batches, written tables, groups, running totals.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; ``bytes.split()`` has
exactly that rule. Nothing here collects rows: the driver gets counts only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areatab.session import scratch_path

#: Bytes of text that a task holds decoded at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and return the written table.

    Cuts the lineage and keeps what was computed when an executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def meet(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """Join two tables that both grow with the input: sorted and merged, which spills and splits skewed keys, never broadcast."""
    return left.join(right.hint("merge"), on, how)


def temporary(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes) - sizes) // limit
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of all texts: (id of each word, distinct words, first word of each text and the end)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    ids, words = coded.indices.to_numpy(), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # white space at either end, or no word at all
        keep = ids != empty
        offsets = np.r_[0, np.cumsum(keep)][offsets]
        ids = ids[keep]
    return ids, words, offsets


BASES = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** n modulo 2 ** 64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def ranges_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """Polynomial hash modulo 2 ** 64 of values[start:end], whatever the place; ``values`` are mixed or small."""
    up = powers(base, len(values))
    down = powers(pow(base, -1, 1 << 64), len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    x = (total[end] - total[start]) * down[start]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def components(edges: DataFrame, left: str, right: str, name: str = "groups") -> DataFrame:
    """Connected components of an undirected graph: (node, root) for each node that has an edge.

    Each round hooks every node onto its least neighbour by a hashed order and
    contracts, so a round removes a constant share of the nodes whatever the
    ids look like. Minima are combined before the shuffle, so a hub costs one
    row a task; the rounds' tables are written to the shared folder.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    current = written(
        edges.where(F.col(left) != F.col(right))
        .select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v"))
        .groupBy("u", "v").agg(F.lit(1).alias("one")).drop("one"), f"{name}-edges",
    )
    total: DataFrame | None = None
    while not current.isEmpty():
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(rank("v")).alias("m"))
        parent = written(
            least.select(F.col("u").alias("node"), F.least(rank("u"), F.col("m"))["id"].alias("root")), f"{name}-parents"
        )
        grand = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = meet(parent, grand, "root").select("node", F.col("top").alias("root"))
        jumped = written(jumped, f"{name}-jumped")
        if total is None:
            total = jumped
        else:
            step = jumped.select(F.col("node").alias("root"), F.col("root").alias("top"))
            total = written(
                meet(total, step, "root", "left").select("node", F.coalesce("top", "root").alias("root")), f"{name}-roots"
            )
        pu = jumped.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        pv = jumped.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        moved = meet(meet(current, pu, "u"), pv, "v").where("ru <> rv")
        current = written(
            moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v"))
            .groupBy("u", "v").agg(F.lit(1).alias("one")).drop("one"), f"{name}-edges",
        )
    if total is None:
        return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return total


def range_buckets(df: DataFrame, key: str, rows: int, per_bucket: int = 4096) -> DataFrame:
    """Add ``bucket``: consecutive ranges of ``key`` of about ``per_bucket`` rows; null keys come first.

    The bounds are quantiles of the whole column (a bounded sketch, error 0.1 of
    a bucket), so buckets stay even whatever the ids look like.
    """
    n = max(1, -(-rows // per_bucket))
    n = min(n, 4096)
    if n == 1:
        return df.withColumn("bucket", F.lit(0))
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    found = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= F.col(key))) if cuts else F.lit(0)
    return df.withColumn("bucket", F.when(F.col(key).isNull(), 0).otherwise(found))


def totals_before(sizes: DataFrame, value: str) -> DataFrame:
    """(bucket, before): the sum of ``value`` over all smaller buckets; one row a bucket, at most 4,096."""
    sums = sizes.groupBy("bucket").agg(F.sum(value).alias("total"))
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("bucket", F.coalesce(F.sum("total").over(w), F.lit(0)).alias("before"))
