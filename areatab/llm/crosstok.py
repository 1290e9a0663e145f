"""Two tokenizers' ids of the same texts, aligned, with corpus-wide counts of linked ids.

Both tokenizers part a text's bytes. Bytes at which tokens of both end cut the
text into groups; two tokens whose byte ranges overlap are linked. A mark for
each byte at which a token ends gives all of it without a loop: every marked
byte ends exactly one link.

The first pass keeps each slice's ids and its distinct linked pairs with their
counts. The distinct pairs of all slices are dealt to shards by their B id, and
every shard gets a minimal perfect hash: level by level, keys that are alone at
their place of a bit array take it, the others go on to the next level; a pair's
number is the count of set bits before its own. Keys stand beside, in the order
of their numbers, so a look-up is verified. Counts are dense vectors indexed by
these numbers, one a task, summed in a tree. The second pass aligns the kept ids
anew and looks every link up.

What tasks look up is broadcast in blocks of whole shards of at most ``BLOCK``
pairs; kept ids are read once a block. Two vocabularies have a fixed number of
pairs, so the number of blocks is bounded however long the corpus is.

Defined cases: a null or empty text, and one whose joined tokens aren't the
text's bytes, has no tokens: zeros, and '' for the groups' hash; special tokens
written in a text are plain text; equal rows stay apart; a null doc_id is kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import slices, written
from areatab.llm.tokens import ALPHABET, SHOWN

#: Bytes of text in a slice, and characters that the tokenizers get at once, where a blank between two letters is near.
SLICE = 1 << 18
CHUNK = 1 << 18
#: Distinct pairs in a shard, on average, and in a block at most (one shard more).
SHARD = 1 << 17
BLOCK = 1 << 22
#: Bits of a level for each of its keys.
ROOM = 2
#: Pairs that a task gathers before it passes them on; vectors that meet in one sum.
GATHERED = 1 << 21
FAN_IN = 16
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """Byte-level BPE from a tokenizers file, run by tiktoken: ids must stand in the order of the merges."""

    def __init__(self, path: str):
        import tiktoken

        with open(path) as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        added = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if made != sorted(made) or len(set(made)) != len(made):
            raise ValueError(f"{path}: ids aren't in the order of the merges")
        back = {chr(c): b for b, c in ALPHABET.items()} | {chr(b): b for b in SHOWN}
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces: list[bytes] = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece

    def __call__(self, text: str) -> list[int]:
        """Ids of a blank and the text."""
        return self.encoding.encode_ordinary(" " + text)


class PieceTokens:
    """A sentencepiece model, which sets a blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # cutting before a blank is safe if no piece has one behind another character
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.pieces = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]

    def __call__(self, text: str) -> list[int]:
        return self.model.encode(text)


BORDER = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in parts, without the blank between two letters at which it is cut."""
    at = 0
    while len(text) - at > size:
        cut = BORDER.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def key_type(n_a: int, n_b: int) -> str:
    """What a pair's number is stored as."""
    return "<u4" if n_a * n_b <= 1 << 32 else "<i8"


class Pair:
    """Both vocabularies, their ids' bytes, and how ids are written in groups."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.n_a, self.n_b = len(self.a.pieces), len(self.b.pieces)
        self.bytes = [pa.array(x.pieces, pa.large_binary()) for x in (self.a, self.b)]
        self.sizes = [np.array([len(p) for p in x.pieces], np.int64) for x in (self.a, self.b)]
        marks = [f"{i}{m}" for n, ms in ((self.n_a, ",|"), (self.n_b, ",;")) for i in range(n) for m in ms]
        self.marked = pa.array(marks, pa.large_string())
        self.key_type = key_type(self.n_a, self.n_b)
        self.kinds = [np.uint16 if n <= 1 << 16 else np.uint32 for n in (self.n_a, self.n_b)]

    def ids(self, texts: list[str | None], which: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; none for null and empty texts."""
        encode, kind = (self.a, self.b)[which], self.kinds[which]
        parts, counts, held, n_held = [], [], [], 0
        for text in texts:
            n = 0
            for part in chunks(text, CHUNK if self.b.cuts else 1 << 62) if text else ():
                found = encode(part)
                held.append(found)
                n += len(found)
                n_held += len(found)
                if n_held >= 1 << 16:
                    parts.append(np.fromiter(chain.from_iterable(held), kind, n_held))
                    held, n_held = [], 0
            counts.append(n)
        parts.append(np.fromiter(chain.from_iterable(held), kind, n_held))
        return np.concatenate(parts), np.array(counts, np.int64)

    def agrees(self, ids: np.ndarray, count: np.ndarray, texts: list[bytes], which: int) -> np.ndarray:
        """Of each text, whether its tokens' bytes are a blank and the text."""
        stop = np.cumsum(count)
        after = np.r_[0, np.cumsum(self.sizes[which][ids])]
        length = after[stop] - after[stop - count]
        taken = self.bytes[which].take(pa.array(ids))
        data = memoryview(taken.buffers()[2] or b"")
        starts = after[stop - count].tolist()
        return np.array([bool(t) and n == len(t) + 1 and bytes(data[a : a + 1]) == b" " and bytes(data[a + 1 : a + n]) == t for t, n, a in zip(texts, length.tolist(), starts, strict=True)], bool)


@cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Alignment:
    """Links and groups of texts laid end to end; ``count_*``: tokens of each text."""

    def __init__(self, own: Pair, a: np.ndarray, count_a: np.ndarray, b: np.ndarray, count_b: np.ndarray):
        after_a, after_b = np.cumsum(own.sizes[0][a]), np.cumsum(own.sizes[1][b])
        ends = np.r_[0, after_a][np.cumsum(count_a)]  # of texts
        mark = np.zeros(int(after_a[-1]) if len(after_a) else 0, np.uint8)
        mark[after_a - 1] = 1
        mark[after_b - 1] |= 2
        at = np.flatnonzero(mark)
        mark = mark[at]
        is_a, is_b, both = (mark & 1).astype(np.int64), (mark >> 1).astype(np.int64), mark == 3
        self.is_a, self.is_b, self.both, self.a, self.b, self.own = is_a, is_b, both, a, b, own
        self.link_a, self.link_b = a[np.cumsum(is_a) - is_a], b[np.cumsum(is_b) - is_b]
        self.stop = np.searchsorted(at, ends)  # links up to each text's end
        self.n_links = np.diff(np.r_[0, self.stop])
        self.n_groups = np.diff(np.r_[0, np.cumsum(both)][np.r_[0, self.stop]])

    def keys(self) -> np.ndarray:
        """Of each link, its pair as one number."""
        return self.link_a.astype(np.int64) * self.own.n_b + self.link_b

    def groups(self, count_a: np.ndarray, count_b: np.ndarray) -> list[str]:
        """The hash of each text's groups as they are written; '' without tokens."""
        before = np.cumsum(self.both) - self.both  # groups that end before each link does
        of_a, of_b = before[self.is_a == 1], before[self.is_b == 1]
        upto_a, upto_b = np.cumsum(self.is_a)[self.both], np.cumsum(self.is_b)[self.both]
        n_a = np.arange(len(self.a))
        n_b = np.arange(len(self.b))
        codes = np.empty(len(n_a) + len(n_b), np.int32)
        codes[n_a + np.r_[0, upto_b][of_a]] = self.a.astype(np.int32) * 2 + (n_a + 1 == upto_a[of_a])
        codes[n_b + upto_a[of_b]] = 2 * self.own.n_a + self.b.astype(np.int32) * 2 + (n_b + 1 == upto_b[of_b])
        taken = self.own.marked.take(pa.array(codes))
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
        ends = offsets[np.r_[0, np.cumsum(count_a + count_b)]].tolist()
        view = memoryview(taken.buffers()[2] or b"")
        return [hashlib.sha256(view[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:], strict=False)]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of the links' ``values`` over each text."""
        return np.diff(np.r_[0, np.cumsum(values, dtype=np.int64)][np.r_[0, self.stop]])


# --- minimal perfect hash


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_of(keys: np.ndarray, n_b: int, shards: int) -> np.ndarray:
    """All pairs of one B id are in one shard."""
    return (mixed(keys % n_b, -1) % np.uint64(shards)).astype(np.int32)


def perfect_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all bits as 64-bit words, the distinct ``keys`` in the order of their numbers)."""
    sizes, words, order = [], [], []
    while len(keys):
        size = -(-ROOM * len(keys) // 64) * 64
        at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        order.append(keys[alone][np.argsort(at[alone])])
        sizes.append(size)
        keys = keys[~alone]
    none = np.zeros(0, np.int64)
    return sizes, np.concatenate([*words, none.astype("<u8")]), np.concatenate([*order, none])


class Numbers:
    """Numbers of the pairs of a block of shards, one after the other."""

    def __init__(self, shards: int, n_b: int, stored: str, rows: list[tuple[int, list[int], bytes, bytes]]):
        """``rows``: of each shard (shard, bits of each level, words, keys)."""
        self.shards, self.n_b = shards, n_b
        self.members = [r[0] for r in rows]
        self.slot = np.full(shards, -1, np.int32)
        self.slot[self.members] = np.arange(len(rows))
        levels = max([0, *(len(r[1]) for r in rows)])
        self.sizes = np.zeros((len(rows), levels), np.int64)
        for k, r in enumerate(rows):
            self.sizes[k, : len(r[1])] = r[1]
        self.words = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(r[2], "<u8") for r in rows)])
        keys = [np.frombuffer(r[3], stored) for r in rows]
        self.first = np.cumsum([0, *map(len, keys)])  # the first number of each shard, and the end
        self.keys = np.concatenate([np.zeros(0, stored), *keys])
        start = np.cumsum(self.sizes.sum(axis=1)) - self.sizes.sum(axis=1)
        self.base = start[:, None] + np.cumsum(self.sizes, axis=1) - self.sizes
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each pair; -1 if the block doesn't hold it."""
        out = np.full(len(keys), -1, np.int64)
        slot = self.slot[shard_of(keys, self.n_b, self.shards)]
        left = np.flatnonzero(slot >= 0)
        for level in range(self.sizes.shape[1]):
            left = left[self.sizes[slot[left], level] > 0]
            if not len(left):
                break
            own = slot[left]
            at = self.base[own, level] + (mixed(keys[left], level) % self.sizes[own, level].astype(np.uint64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below)
            left = left[~hit]
        known = np.flatnonzero(out >= 0)
        out[known[self.keys[out[known]] != keys[known]]] = -1
        return out


# --- the two passes

LONGS = pa.list_(pa.int64())
KEPT = "slice long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, a binary, b binary, pairs binary, counts binary"
KEPT_FIELDS = pa.schema([
    ("slice", pa.int64()), *((c, LONGS) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")), ("groups", pa.list_(pa.string())),
    *((c, pa.binary()) for c in ("a", "b", "pairs", "counts")),
])


def first_pass(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each slice of documents: their ids, groups, and distinct pairs (ascending) with their counts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = pair(path_a, path_b), TaskContext.get().partitionId()
        for k, batch in enumerate(slices(batches, "text", SLICE)):
            texts = batch.column("text").to_pylist()
            raw = [t.encode() if t else b"" for t in texts]
            found = [own.ids(texts, w) for w in (0, 1)]
            good = own.agrees(*found[0], raw, 0) & own.agrees(*found[1], raw, 1)
            (a, n_a), (b, n_b) = ((ids[np.repeat(good, n)], n * good) for ids, n in found)
            x = Alignment(own, a, n_a, b, n_b)
            pairs, counts = np.unique(x.keys(), return_counts=True)
            row = {"slice": task << 32 | k, "doc_ids": batch.column("doc_id").to_pylist(), "n_a": n_a, "n_b": n_b, "n_groups": x.n_groups, "n_links": x.n_links, "groups": x.groups(n_a, n_b)}
            row |= {"a": a.tobytes(), "b": b.tobytes(), "pairs": pairs.astype(own.key_type).tobytes(), "counts": counts.astype("<u4").tobytes()}
            yield pa.RecordBatch.from_pylist([row], KEPT_FIELDS)

    return rows.mapInArrow(work, KEPT)


def alignment(own: Pair, batch: pa.RecordBatch, i: int) -> Alignment:
    """The texts of a kept row, aligned anew; the ids stay in the batch's memory."""
    n_a, n_b = (batch.column(c).slice(i, 1).flatten().to_numpy() for c in ("n_a", "n_b"))
    a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in zip("ab", own.kinds, strict=True))
    return Alignment(own, a, n_a, b, n_b)


def distinct_pairs(kept: DataFrame, stored: str) -> DataFrame:
    """(pair): every linked pair once; a task merges its slices' pairs before they are shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [np.zeros(0, np.int64)], 0
        for batch in batches:
            for x in batch.column("pairs"):
                held.append(np.frombuffer(x.as_buffer(), stored).astype(np.int64))
                n += len(held[-1])
                if n >= GATHERED:
                    held = [np.unique(np.concatenate(held))]
                    n = len(held[0])
                    if n >= GATHERED:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0])], ["pair"])
                        held, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], ["pair"])

    return kept.select("pairs").mapInArrow(work, "pair long").distinct()


def hashed(pairs: DataFrame, n_b: int, shards: int, stored: str) -> DataFrame:
    """(shard, n, levels, words, keys): a perfect hash of each shard's pairs; a shard is bounded by the vocabularies."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("pair").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys, n_b, shards)), batch.column("pair")], ["shard", "pair"])

    def build(table: pa.Table) -> pa.Table:
        sizes, words, keys = perfect_hash(table.column("pair").to_numpy())
        row = {"shard": table.column("shard")[0].as_py(), "n": len(keys), "levels": sizes, "words": words.tobytes(), "keys": keys.astype(stored).tobytes()}
        return pa.Table.from_pylist([row], pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("levels", LONGS), ("words", pa.binary()), ("keys", pa.binary())]))

    return pairs.mapInArrow(deal, "shard int, pair long").groupBy("shard").applyInArrow(build, "shard int, n long, levels array<long>, words binary, keys binary")


def summed(kept: DataFrame, numbers, stored: str, parts: int) -> DataFrame:
    """(shard, counts): dense vectors of the pairs' counts, indexed by their numbers, one a task, summed in a tree."""

    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: Numbers = numbers.value
        total = np.zeros(int(x.first[-1]), np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column("pairs"), batch.column("counts"), strict=True):
                at = x.find(np.frombuffer(keys.as_buffer(), stored).astype(np.int64))
                here = at >= 0
                total[at[here]] += np.frombuffer(counts.as_buffer(), "<u4")[here]  # a slice's pairs are distinct
        task = TaskContext.get().partitionId()
        for shard, a, b in zip(x.members, x.first, x.first[1:], strict=False):
            own = total[a:b]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([task], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["shard", "part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        vectors = (np.frombuffer(v.as_buffer(), "<i8") for v in table.column("counts"))
        total = next(vectors).copy()
        for v in vectors:
            total += v
        return pa.Table.from_arrays([table.column("shard").slice(0, 1), table.column("part").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["shard", "part", "counts"])

    fields = "shard int, part int, counts binary"
    rows = kept.select("pairs", "counts").coalesce(parts).mapInArrow(count_up, fields)
    while parts > 1:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("shard", "part").applyInArrow(add, fields)
        parts = -(-parts // FAN_IN)
    return rows.select("shard", "counts")


def best(keys: np.ndarray, counts: np.ndarray, n_b: int) -> np.ndarray:
    """Whether each pair's count is the highest of its B id."""
    _, which = np.unique(keys % n_b, return_inverse=True)
    top = np.zeros(int(which.max()) + 1 if len(which) else 0, np.int64)
    np.maximum.at(top, which, counts)
    return counts == top[which]


LOOKED_UP = "slice long, row long, n_best long, count_sum long"


def second_pass(kept: DataFrame, numbers, values, path_a: str, path_b: str) -> DataFrame:
    """Of each document, what the block's pairs add: links whose count is their B id's highest, and the sum of counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, x, (counts, top) = pair(path_a, path_b), numbers.value, values.value
        for batch in batches:
            for i, slice_ in enumerate(batch.column("slice").to_pylist()):
                links = alignment(own, batch, i)
                at = x.find(links.keys())
                here = at >= 0
                sums = [links.per_text(np.where(here, v[at], 0)) if len(v) else np.zeros(len(links.n_links), np.int64) for v in (top, counts)]
                place = [pa.array(np.full(len(sums[0]), slice_, np.int64)), pa.array(np.arange(len(sums[0])))]
                yield pa.RecordBatch.from_arrays([*place, *map(pa.array, sums)], ["slice", "row", "n_best", "count_sum"])

    return kept.select("slice", "n_a", "n_b", "a", "b").mapInArrow(work, LOOKED_UP)


def blocks(sizes: list[tuple[int, int]], most: int = BLOCK) -> list[list[int]]:
    """Shards (shard, pairs) in blocks of at most ``most`` pairs, or of one shard."""
    out: list[list[int]] = []
    held = 0
    for shard, n in sizes:
        if not out or held + n > most:
            out.append([])
            held = 0
        out[-1].append(shard)
        held += n
    return out


def pair_counts(kept: DataFrame, path_a: str, path_b: str, shard_pairs: int = SHARD, block_pairs: int = BLOCK) -> Iterator[tuple]:
    """Of each block: the broadcast numbers of its pairs, and the broadcast counts and best marks by number."""
    spark = kept.sparkSession
    own = pair(path_a, path_b)
    pairs = written(distinct_pairs(kept, own.key_type), "crosstok-pairs")
    n = pairs.count()
    shards = max(1, -(-n // shard_pairs))
    tables = written(hashed(pairs, own.n_b, shards, own.key_type), "crosstok-hashes")
    entries = kept.agg(F.sum(F.length("pairs"))).first()[0] or 0
    sizes = sorted((r.shard, r.n) for r in tables.select("shard", "n").collect())  # a row for each shard, not for each pair
    for members in blocks(sizes, block_pairs):
        rows = tables.where(F.col("shard").isin(members)).select("shard", "levels", "words", "keys").collect()
        block = Numbers(shards, own.n_b, own.key_type, sorted((r.shard, list(r.levels), bytes(r.words), bytes(r["keys"])) for r in rows))
        del rows
        numbers = spark.sparkContext.broadcast(block)
        # no more dense vectors than what they sum up outweighs
        parts = max(8, min(4096, entries // np.dtype(own.key_type).itemsize // max(1, int(block.first[-1]))))
        found = written(summed(kept, numbers, own.key_type, parts), "crosstok-counts")
        counts = np.zeros(int(block.first[-1]), np.int64)
        for r in found.collect():
            k = int(block.slot[r.shard])
            counts[block.first[k] : block.first[k + 1]] = np.frombuffer(r["counts"], "<i8")
        # a B id's pairs are all in one block
        yield numbers, spark.sparkContext.broadcast((counts, best(block.keys.astype(np.int64), counts, own.n_b)))


def align(docs: DataFrame, path_a: str, path_b: str, shard_pairs: int = SHARD, block_pairs: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    kept = written(first_pass(docs, path_a, path_b), "crosstok-kept")
    names = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups"]
    each = kept.select("slice", F.posexplode(F.arrays_zip(*names)).alias("row", "d"))
    each = each.select("slice", F.col("row").cast("long").alias("row"), *(F.col(f"d.{c}").alias(c) for c in names), F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    for numbers, values in pair_counts(kept, path_a, path_b, shard_pairs, block_pairs):
        found = written(second_pass(kept, numbers, values, path_a, path_b), "crosstok-found")
        each = each.unionByName(found, allowMissingColumns=True)
        numbers.unpersist()
        values.unpersist()
    total = each.groupBy("slice", "row").agg(*(F.max(c).alias(c) for c in names), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return total.select(F.col("doc_ids").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
