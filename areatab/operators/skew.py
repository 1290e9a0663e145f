"""Equi-joins that survive a hot key.

If one parent key owns a large share of the child rows (one household with a
third of all persons), a hash-partitioned join sends all of them to one task.
AQE's skew-join splitting covers the common case at run time; ``salted_join``
is the explicit, deterministic alternative:

1. find hot keys with one map-side-combined count per key (only keys above
   ``hot_rows`` survive, so the hot set is at most ``rows / hot_rows`` keys);
   the set is checkpointed to the shared checkpoint folder once, so its two
   joins read it instead of re-aggregating the big table;
2. give each child row of a hot key a salt in ``[0, salts)`` and every other
   row salt 0; the salt is a hash of the row's identity, not of its values
   (equal rows would all get one salt), and not a random number, so a task
   re-run after an executor loss assigns the same salts. Callers pass the
   child's own key where there is one; else a row is known by its place in the
   files that are read;
3. replicate the parent row of each hot key once per salt;
4. join on ``(key, salt)``.

Children without a key match nothing: under a left join they are spread over
all salts, under an inner join they are dropped first. Every other child row
still meets exactly one copy of its parent, so inner and left joins return the
same rows as the plain join; no row is dropped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys of ``df`` with more than ``hot_rows`` rows: ``(key, _hot)``."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > F.lit(hot_rows)).select(key, F.lit(True).alias("_hot"))


def row_identity(df: DataFrame) -> Column:
    """Hash of a row's place: its file and row index for Parquet, else its split and position in the scan.

    Both are the same when a lost task reads its part of the files again.
    """
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return F.xxhash64(F.monotonically_increasing_id())
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    hot_rows: int = 1_000_000,
    salts: int = 64,
    identity: Column | Sequence[str] | None = None,
) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys of ``big`` spread over ``salts`` tasks.

    ``identity``: columns (or an expression over them) that tell the rows of
    one key apart; by default the rows' places in the files behind ``big``.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if identity is None:
        ident = row_identity(big)
    else:
        ident = identity if isinstance(identity, Column) else F.xxhash64(*identity)
    hot = hot_keys(big.select(key), key, hot_rows).checkpoint(eager=True)
    spread = big.withColumn("_salt", F.pmod(ident, F.lit(salts)).cast("int"))
    if how == "inner":
        spread = spread.where(F.col(key).isNotNull())
    # salts of the keyless rows under a left join stay: no parent row has a NULL key
    b = spread.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), F.col("_salt")).otherwise(F.lit(0))
    ).drop("_hot")
    s = small.join(hot, key, "left").withColumn(
        "_salt",
        F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))),
    ).drop("_hot")
    return b.join(s, [key, "_salt"], how).drop("_salt")
