"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by bit distance.

Links are found on the distinct fingerprints. The 64 bits are cut into six
blocks; two fingerprints that differ in at most three bits agree on three
blocks, so each of the 20 ways to choose three gives a key of about 32 bits
under which every link meets at least once. Inside a key the comparison is
bit-sliced: the fingerprints' bit planes lie vertically, 64 candidates to a
machine word, distances add up in carry-save bitwise counters, and words whose
candidates are all beyond the radius are abandoned. A key emits a spanning
forest of its links, never all pairs; keys above ``BLOCK`` rows are dealt as
pairs of blocks to many tasks.

Defined cases: a null text is an empty one; texts without words have the
fingerprint zero and link like any other; equal doc_ids and repeated rows are
rows of their own with the same group; a null doc_id is never a group's id,
unless all its group's are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from areatab.llm.common import components, meet, slices, temporary, texts_of, written

#: Rows of one key that are compared in one place; a larger key is split.
BLOCK = 2048
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the shingles' XXH64 (unsigned), repeats included; zero without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), 1 << 15):  # bounds what a very long text holds
        pairs = zip(first[at : at + (1 << 15)], last[at : at + (1 << 15)], strict=True)
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in pairs], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): ``fp`` is the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch, "text")], np.uint64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        work, "doc_id long, fp long"
    )


def key_masks(radius: int = 3, blocks: int = 6) -> list[int]:
    """Bit masks such that two values within ``radius`` bits agree under one of them."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [reduce(int.__or__, chosen) for chosen in combinations(part, blocks - radius)]


def sliced_links(values: np.ndarray, group: np.ndarray, radius: int = 3, chunk: int = 1 << 17) -> np.ndarray:
    """Least linked row of each row, through any chain of links inside its group.

    ``group`` is sorted. Words of 64 candidates never span groups.
    """
    n = len(values)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, n])
    n_words = -(-count // 64)
    word0 = np.cumsum(n_words) - n_words
    which = np.repeat(np.arange(len(first)), count)
    place = np.arange(n) - first[which]
    words = int(n_words.sum())
    padded = np.zeros(words * 64, np.uint64)
    slot = (word0[which] * 64 + place).astype(np.int64)
    padded[slot] = values
    row_of = np.full(words * 64, -1, np.int64)
    row_of[slot] = np.arange(n)
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8)[:, ::-1], axis=1)  # column 0: highest bit
    upright = np.ascontiguousarray(bits.reshape(words, 64, 64).transpose(2, 0, 1))
    planes = np.packbits(upright, axis=2, bitorder="little").view(np.uint64)[:, :, 0]
    valid = np.packbits((row_of >= 0).reshape(words, 64), axis=1, bitorder="little").view(np.uint64)[:, 0]
    mine = np.unpackbits(values.view(np.uint8).reshape(-1, 8)[:, ::-1], axis=1).T.astype(bool)
    label = np.arange(n)
    # a query meets its own word and the later ones of its group
    todo = n_words[which] - place // 64
    before = np.cumsum(todo) - todo
    step = 0
    while step < n:
        upto = max(step + 1, int(np.searchsorted(before, before[step] + chunk)))
        q = np.repeat(np.arange(step, upto), todo[step:upto])
        w = word0[which[q]] + place[q] // 64 + (np.arange(len(q)) - (before[q] - before[step]))
        ones = twos = np.zeros(len(q), np.uint64)
        over = ~valid[w]
        for b in range(64):
            differ = planes[b][w] ^ np.where(mine[b][q], ~np.uint64(0), np.uint64(0))
            # carry-save counters of two bits; a count that passes three is over the radius for good
            carry = ones & differ
            ones = ones ^ differ
            over = over | (twos & carry)
            twos = twos ^ carry
            if b % 8 == 7:
                alive = over != ~np.uint64(0)
                if alive.mean() < 0.7:
                    q, w, ones, twos, over = q[alive], w[alive], ones[alive], twos[alive], over[alive]
        near = ~over
        for less in range(radius + 1, 4):
            near &= ~(np.where(less & 1, ones, ~ones) & np.where(less & 2, twos, ~twos))
        hit = np.flatnonzero(near)
        for at in range(0, len(hit), 1 << 14):
            h = hit[at : at + (1 << 14)]
            flags = np.unpackbits(near[h].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
            r, c = np.nonzero(flags)
            merge(label, q[h][r], row_of[w[h][r] * 64 + c])
        step = upto
    return label


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of the linked rows, in place; labels are each class's least row."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def link_forest(values: DataFrame, radius: int = 3, blocks: int = 6, block_rows: int = BLOCK) -> DataFrame:
    """(a, b): links among the distinct longs ``fp`` that join just what the full set of links joins."""
    if not 0 <= radius <= 3 or blocks <= radius:
        raise ValueError("radius is 0 to 3, and blocks exceed it")
    masks = [m - (1 << 64) if m >> 63 else m for m in key_masks(radius, blocks)]
    keyed = values.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(block_rows)).cast("int")
    dealt = meet(keyed, sizes, ["t", "key"]).withColumn("parts", parts)
    own = F.pmod(F.xxhash64("fp", "t"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(
        "fp", F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("g"),
    )
    dealt = dealt.repartition("g").sortWithinPartitions("g", "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, g = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def emit(fp: np.ndarray, g: np.ndarray) -> pa.RecordBatch:
            label = sliced_links(fp.view(np.uint64), g, radius)
            moved = np.flatnonzero(label != np.arange(len(label)))
            return pa.record_batch({"a": pa.array(fp[moved]), "b": pa.array(fp[label[moved]])})

        for batch in batches:
            fp = np.r_[fp, batch.column("fp").to_numpy()]
            g = np.r_[g, batch.column("g").to_numpy()]
            cut = int(np.searchsorted(g, g[-1])) if len(g) else 0  # the last group may go on
            if cut:
                yield emit(fp[:cut], g[:cut])
                fp, g = fp[cut:], g[cut:]
        if len(fp):
            yield emit(fp, g)

    return dealt.mapInArrow(work, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, blocks: int = 6, block_rows: int = BLOCK, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, fp, root, component_id), one row per row of ``docs``; ``root`` is a fingerprint that names the group."""
    marks = written(fingerprints(docs, shingle, seed, text, doc_id), "simhash")
    distinct = written(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(link_forest(distinct.select("fp"), radius, blocks, block_rows), "a", "b", "simhash")
    known = meet(distinct, roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = written(known, "simhash-groups")
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = meet(known, ids, "root").select("fp", "root", "component_id")
    return meet(marks, classes, "fp").select("doc_id", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each group: that of its least doc_id; of several such rows, one.

    An id that stands on one row picks that row; rows that share an id (or have
    none) are told apart by their fingerprints.
    """
    found = near_duplicates(docs, shingle, radius, seed)
    mine, n, fp, root, other = (temporary(x) for x in ("id", "n", "fp", "root", "other"))
    chosen = F.col("doc_id").eqNullSafe(F.col("component_id"))
    counts = found.groupBy(F.col("doc_id").alias(mine)).agg(F.count("*").alias(n), F.count_if(chosen).alias(other))
    counts = written(counts.where(F.col(other) > 0).select(mine, n), "simhash-kept")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(mine))
    single = meet(docs, counts.where(F.col(n) == 1), same, "left_semi")
    again = counts.where(F.col(n) > 1)
    if again.isEmpty():
        return single
    # several rows with that id: those whose fingerprint stands for a group, and of equal ones, one
    mark = F.pandas_udf(lambda t: t.map(lambda x: _signed(fingerprint((x or "").encode(), shingle, seed))), "long")
    several = written(meet(docs, again, same, "left_semi"), "simhash-several").withColumn(fp, mark(F.col("text").cast("string")))
    groups = found.where(chosen).groupBy(F.col("doc_id").alias(mine), F.col("fp").alias(other)).agg(F.first("root").alias(root))
    of_row = several["doc_id"].cast("long").eqNullSafe(F.col(mine)) & (F.col(fp) == F.col(other))
    several = meet(several, groups, of_row).dropDuplicates(["doc_id", root]).select(*docs.columns)
    return single.unionByName(several)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def hex_digits(column: str) -> F.Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
