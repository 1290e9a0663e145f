"""Conflict-constrained best-fit packing of documents into bins of fixed length.

Documents are dealt by a hash of their id to shards of about ``shard_rows``, so
a hot source is spread over all shards, and each shard is packed by itself,
longest piece first. Its open bins are ordered by residual; every bin carries a
bitmap of the sources and one of the duplicate clusters it holds, numbered
within the shard. The search starts at the least residual that fits, by the
successor in a bit set of residuals, and goes on until it meets the tightest bin
that holds neither the piece's source nor its cluster.

Texts longer than a bin are cut into whole bins and a rest; no word is dropped.

Defined cases: a null or empty text has length 0 and its row no bin; a null
source or cluster conflicts with nothing; repeated rows are packed each (their
cluster keeps them apart); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_ROWS = 4096


def best_fit(pieces: Iterable[tuple[int, str | None, int | None]], capacity: int) -> list[tuple[int, int]]:
    """(bin, place in the bin) of each piece (length, source, cluster), longest first in the order given."""
    pieces = list(pieces)
    sources: dict = {}
    clusters: dict = {}
    by_residual: dict[int, list[int]] = defaultdict(list)  # residual -> bins, oldest first
    present = 0  # bit r: there is a bin of residual r
    residual: list[int] = []
    held: list[tuple[int, int]] = []
    filled: list[int] = []
    out: list[tuple[int, int]] = [(-1, -1)] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][0]):
        length, source, cluster = pieces[i]
        s = 0 if source is None else 1 << sources.setdefault(source, len(sources))
        c = 0 if cluster is None else 1 << clusters.setdefault(cluster, len(clusters))
        found, at = -1, length
        while found < 0 and (later := present >> at):
            at += (later & -later).bit_length() - 1
            found = next((b for b in by_residual[at] if not (held[b][0] & s or held[b][1] & c)), -1)
            if found < 0:
                at += 1
        if found < 0:
            found = len(residual)
            residual.append(capacity)
            held.append((0, 0))
            filled.append(0)
        else:
            by_residual[at].remove(found)
            if not by_residual[at]:
                present &= ~(1 << at)
        out[i] = (found, filled[found])
        filled[found] += 1
        residual[found] -= length
        held[found] = (held[found][0] | s, held[found][1] | c)
        by_residual[residual[found]].append(found)
        present |= 1 << residual[found]
    return out


OUT = "bin_id long, place int, doc_id long, start long, n_words long, source string, cluster long"
FIELDS = pa.schema([
    ("bin_id", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()),
    ("source", pa.string()), ("cluster", pa.int64()),
])


def pack(items: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pieces of the items (doc_id, n_words, source, cluster): (bin_id, place, doc_id, start, n_words, source, cluster).

    A bin's words sum to at most ``capacity``, no two of its pieces share a
    source or a cluster. ``bin_id`` is null for items without words.
    """
    if capacity < 1 or shard_rows < 1:
        raise ValueError("capacity and shard_rows are at least 1")
    whole = F.floor(F.col("n_words") / F.lit(capacity)).cast("long")
    last = F.when((F.col("n_words") % capacity > 0) | (F.col("n_words") == 0), whole).otherwise(whole - 1)
    pieces = items.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id", "source", "cluster", (F.col("k") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("n_words") - F.col("k") * capacity).alias("n_words"),
    )
    shards = max(1, -(-items.count() // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "source", F.lit(11)), F.lit(shards)))

    def work(key: tuple, part: pa.Table) -> pa.Table:
        rows = part.select(["n_words", "doc_id", "start", "source", "cluster"]).to_pylist()
        rows.sort(key=lambda r: (-r["n_words"], *((r[c] is not None, r[c] or 0) for c in ("doc_id", "start")), *map(str, (r["source"], r["cluster"]))))
        some = [(r["n_words"], r["source"], r["cluster"]) for r in rows if r["n_words"]]
        places = best_fit(some, capacity) + [(None, None)] * (len(rows) - len(some))  # empty ones sort last
        high = key[0].as_py() << 32
        new = [{"bin_id": None if b is None else high | b, "place": p, **r} for (b, p), r in zip(places, rows, strict=True)]
        return pa.Table.from_pylist(new, FIELDS)

    types = {"doc_id": "long", "start": "long", "n_words": "long", "source": "string", "cluster": "long", "shard": "long"}
    dealt = dealt.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
    return dealt.groupBy("shard").applyInArrow(work, OUT)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, source, cluster): words of the whole text; exact copies, but for case, share a cluster."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    words = F.when(F.length("t") == 0, 0).otherwise(F.size(F.split("t", r"[\x20\x09-\x0D]+"))).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), trimmed.alias("t"))
    return rows.select("doc_id", words.alias("n_words"), "source", F.when(F.length("t") > 0, F.xxhash64(F.lower("t"))).alias("cluster"))
