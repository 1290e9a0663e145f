"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; its hash leaves the masked-out
words unread, so a substituted word there does no harm. The four masks are
lossless for the rule below: of any 15 or more aligned words, a fifth of them
substituted wherever one likes, at least one mask finds its words untouched
(``least_to_spoil``; for long stretches since its parts have that property). Hashes of the test items meet the hashes of every position of every
document; around each hit the item is laid on the document along that diagonal,
and an overlap counts if at least 15 aligned words, 80 % of them equal, begin
and end with equal words. Items shorter than that must occur whole and
unchanged.

The benchmark's distinct items are cut into blocks of bounded size, by their
words as they are compared, each sent to the tasks once; documents stay where they are and nothing is shuffled, so copies, hot sources
and common passages cost no more than their length.

Defined cases: words are lower-cased, and white space and ASCII punctuation
part them; null and empty texts and items without words overlap nothing; equal
items and repeated rows are rows of their own; an empty benchmark leaves all
documents clean.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import BASES, ranges_hash, slices, split_words

MASKS = ("1111011", "11001000111", "11010110001", "1100000110101")
LEAST = 15
SIMILAR = 0.8
#: Words of the benchmark in one block: about 40 MB where it is used.
BLOCK_WORDS = 500_000
PARTS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
FOLD = 20


def least_to_spoil(masks: tuple[str, ...], n: int) -> int:
    """The least number of ``n`` words that must be substituted for every mask to be hit at every place.

    Runs along the words; of what lies behind, only the last places that a mask can reach count.
    """
    own = [(len(m), int(m, 2)) for m in masks]  # the last bit is the current word
    keep = (1 << max(map(len, masks)) - 1) - 1
    least = {0: 0}
    for i in range(n):
        found: dict[int, int] = {}
        for behind, cost in least.items():
            for b in (0, 1):
                at = behind << 1 | b
                if all(i + 1 < size or at & mask for size, mask in own):
                    found[at & keep] = min(found.get(at & keep, n), cost + b)
        least = found
    return min(least.values())


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word of all texts, and where each text begins (and the end)."""
    plain = pa.array([(t or "").lower().encode().translate(PARTS) for t in texts], pa.binary()).cast(pa.string())
    ids, words, offsets = split_words(plain)
    data = words.cast(pa.large_binary())
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    coded = ranges_hash(raw, ends[:-1] - ends[0], ends[1:] - ends[0], BASES[1])
    return coded[ids], offsets


def seeds(words: np.ndarray, offsets: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the mask's words at each position where the whole mask lies in one text, and the positions."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(n, len(mask), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            out = (out * np.uint64(BASES[0])) ^ words[k : k + n]
            out ^= out >> np.uint64(32)
    room = np.repeat(offsets[1:], np.diff(offsets))[:n] - np.arange(n) >= len(mask)
    at = np.flatnonzero(room)
    return out[at], at


@dataclass
class Tests:
    """A block of the benchmark, ready to be searched for; an item that stands on several rows is there once."""

    items: list
    rows: list[int]
    words: np.ndarray
    offsets: np.ndarray
    tables: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # mask, bitmap, hashes, item, place

    @classmethod
    def of(cls, rows: list[tuple]) -> Tests:
        words, offsets = word_hashes([t for _, t, _ in rows])
        size = np.diff(offsets)
        tables = []
        short = sorted({int(n) for n in size if 0 < n < LEAST})
        for mask, chosen in [*((m, size >= LEAST) for m in MASKS), *(("1" * n, size == n) for n in short)]:
            h, at = seeds(words, offsets, mask)
            item = np.searchsorted(offsets, at, "right") - 1
            keep = chosen[item]
            h, at, item = h[keep], at[keep], item[keep]
            order = np.argsort(h, kind="stable")
            h, at, item = h[order], at[order], item[order]
            bitmap = np.zeros(1 << FOLD, bool)
            bitmap[(h >> np.uint64(64 - FOLD)).astype(np.int64)] = True
            tables.append((mask, bitmap, h, item, at - offsets[item]))
        return cls([i for i, _, _ in rows], [n for _, _, n in rows], words, offsets, tables)

    def overlaps(self, words: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(text, item, first word in the text, first word in the item, words, equal words): the best of each pair."""
        found: set[tuple[int, int, int]] = set()
        for mask, bitmap, h, item, place in self.tables:
            mine, at = seeds(words, offsets, mask)
            some = np.flatnonzero(bitmap[(mine >> np.uint64(64 - FOLD)).astype(np.int64)])
            mine, at = mine[some], at[some]
            low, high = np.searchsorted(h, mine), np.searchsorted(h, mine, "right")
            hit = np.repeat(np.arange(len(mine)), high - low)
            if not len(hit):
                continue
            first = np.repeat(np.cumsum(high - low) - (high - low), high - low)
            entry = np.arange(len(hit)) - first + low[hit]
            text = np.searchsorted(offsets, at[hit], "right") - 1
            shift = at[hit] - offsets[text] - place[entry]
            found.update(map(tuple, np.unique(np.stack([text, item[entry], shift], axis=1), axis=0).tolist()))
        best: dict[tuple[int, int], tuple] = {}
        for text, item, shift in sorted(found):
            a, b = offsets[text], offsets[text + 1]
            c, d = self.offsets[item], self.offsets[item + 1]
            first = max(0, -shift)
            last = min(d - c, b - a - shift)
            same = words[a + shift + first : a + shift + last] == self.words[c + first : c + last]
            start, size = longest(same, SIMILAR if d - c >= LEAST else 1.0)
            if size < min(LEAST, d - c):
                continue
            row = (text, item, shift + first + start, first + start, size, int(same[start : start + size].sum()))
            if (text, item) not in best or row[5] > best[text, item][5]:
                best[text, item] = row
        return list(best.values())


def longest(same: np.ndarray, share: float) -> tuple[int, int]:
    """First longest stretch that begins and ends with equal words and holds at least ``share`` of them."""
    hits = np.flatnonzero(same)
    if not len(hits):
        return 0, 0
    # in tenths, so that sums are exact
    gain = np.where(same, 10, 0) - round(share * 10)
    total = np.r_[0, np.cumsum(gain)]
    left, right = total[hits], total[hits + 1]
    # least left value so far; the last right end that is no lower
    low = np.minimum.accumulate(left)
    high = np.maximum.accumulate(right[::-1])[::-1]
    best, i, j = (0, 0), 0, 0
    n = len(hits)
    while i < n and j < n:
        if high[j] >= low[i]:
            if hits[j] - hits[i] + 1 > best[1] and j >= i:
                best = (int(hits[i]), int(hits[j] - hits[i] + 1))
            j += 1
        else:
            i += 1
            j = max(j, i)
    return best


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Broadcast]:
    """The benchmark's distinct items in blocks of about ``block_words`` words, whatever its size and its repeats."""
    spark = benchmark.sparkSession
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    rows = rows.groupBy("item_id", "text").agg(F.count("*").alias("n"))
    size = F.size(F.split("text", r"[\s\p{Punct}]+"))
    total = rows.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-int(total) // block_words))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        yield spark.sparkContext.broadcast(Tests.of(sorted(map(tuple, part.collect()), key=str)))


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words, n_equal, similarity): the best overlap of each pair that has one."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    names = f"doc_id long, item_id {kind}, doc_word long, item_word long, n_words long, n_equal long, similarity double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(tests: Broadcast) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = tests.value
            for batch in slices(batches, "text"):
                found = [r for r in t.overlaps(*word_hashes(batch.column("text").to_pylist())) for _ in range(t.rows[r[1]])]
                ids = batch.column("doc_id").take(pa.array([r[0] for r in found], pa.int64()))
                item = pa.array([t.items[r[1]] for r in found])
                rest = [pa.array([r[k] for r in found], pa.int64()) for k in (2, 3, 4, 5)]
                share = pa.array([r[5] / r[4] for r in found], pa.float64())
                if found:
                    yield pa.RecordBatch.from_arrays([ids, item, *rest, share], ["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal", "similarity"])

        return rows.mapInArrow(work, names)

    found = None
    for tests in blocks(benchmark, block_words):
        part = search(tests)
        found = part if found is None else found.unionByName(part)
    return found


def remove(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that overlap an item; every column stays as it is."""
    schema = docs.schema

    def clean(df: DataFrame, tests: Broadcast) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, bool)
                for r in tests.value.overlaps(*word_hashes(batch.column("text").to_pylist())):
                    keep[r[0]] = False
                yield batch.filter(pa.array(keep))

        return df.mapInArrow(work, schema)

    for tests in blocks(benchmark, block_words):
        docs = clean(docs, tests)
    return docs
