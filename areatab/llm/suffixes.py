"""Suffix arrays by linear grouping, and exact removal of repeated byte strings.

``suffix_array`` builds the order in two passes, without recursion or renaming.
The first deals the suffixes to groups, one for each Lyndon prefix: groups are
taken in descending order, every member points to its previous smaller suffix,
and the suffixes pointed to move to new groups right above their own, those
with more pointers higher. The second writes the order out: taking the suffixes
in the order known so far, the one before each and the chain of its previous
smaller suffixes get their group's next place.

``repeated_bytes`` finds every 400-byte string that also starts elsewhere. The
contexts of recurring anchors (see ``contexts``) are dealt to bounded shards by
their anchor; equal contexts count as one. An anchor's contexts are dealt in
parts of bounded size, however many it has. In a shard each context is a
sequence of 8-byte symbols laid out from its anchor, so equal strings are cut
alike; the suffix array of all sequences brings those together that share 49
symbols, which any two equal 400-byte strings around an anchor do, and the
bytes beside them decide exactly. Of the strings that a part holds, the first of
each kind stands for it before the anchor's other parts: strings there meet by
128-bit digests, at first of the bytes that 64 neighbouring strings share, then 8,
then of the string itself, and what no other context holds goes at each step.

Defined cases: a null text is empty; texts under 400 bytes keep all; equal rows
are copies of each other and lose all that the length allows; a null doc_id is
kept as it is. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import meet, slices, texts_of, written
from areatab.llm.contexts import CONTEXT_FIELDS, contexts, recurring

LENGTH = 400
#: Bytes of an anchor: long enough that unrelated texts don't share one by chance.
GRAM = 128
SYMBOL = 8
#: Bytes of contexts in a shard, on average.
SHARD_BYTES = 1 << 19
#: Contexts of one anchor that meet in one suffix array; an anchor with more of them is dealt in parts.
PART = 1024
#: Neighbouring strings that are compared at once by what they share, step by step.
STEPS = (64, 8, 1)


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes of ``text``; a suffix that is another's beginning comes first."""
    n = len(text)
    if not n:
        return []
    # groups: a linked list in ascending order, at first one for each symbol
    symbols = sorted(set(text))
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for s, g in enumerate(group):
        members[g].append(s)
    lower = list(range(-1, len(symbols) - 1))
    higher = [*range(1, len(symbols)), -1]
    # left[s]: a suffix at or before s that may not be done yet (path halving); -1: none
    left = list(range(n))
    prev = [-1] * n
    current = len(symbols) - 1
    while current >= 0:
        here = [s for s in members[current] if group[s] == current]
        members[current] = here
        for s in here:
            left[s] = s - 1
        count: dict[int, int] = {}
        for s in here:
            p = s - 1
            while p >= 0 and left[p] != p:
                q = left[p]
                if q >= 0:
                    left[p] = left[q]
                p = q
            prev[s] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        if count:
            most = max(count.values())
            if most == 1:
                levels = [list(count)]
            else:
                by: dict[int, list[int]] = {}
                for p, k in count.items():
                    by.setdefault(k, []).append(p)
                levels = [by[k] for k in sorted(by, reverse=True)]
            for level in levels:
                made: dict[int, int] = {}
                for p in level:
                    g = group[p]
                    new = made.get(g)
                    if new is None:
                        new = made[g] = len(members)
                        members.append([])
                        up = higher[g]
                        lower.append(g)
                        higher.append(up)
                        higher[g] = new
                        if up >= 0:
                            lower[up] = new
                    members[new].append(p)
                    group[p] = new
        current = lower[current]
    # where each group's part of the order begins
    first = 0  # the lowest group is never moved behind another
    place = [0] * len(members)
    at, g = 0, first
    while g >= 0:
        place[g] = at
        at += len(members[g])
        g = higher[g]
    out = [-1] * n
    done = bytearray(n)
    # the end of the text precedes every suffix: its chain comes first
    for i in range(-1, n):
        j = n - 1 if i < 0 else out[i] - 1
        while j >= 0 and not done[j]:
            done[j] = 1
            g = group[j]
            out[place[g]] = j
            place[g] += 1
            j = prev[j]
    return out


def windows_that_recur(pieces: list[bytes], anchors: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each piece, the starts of its 400-byte windows that another piece holds at the same distance from the anchor,
    and of these the ones that an earlier piece holds.

    ``anchors``: the anchor's place in each piece, which every window holds.
    """
    span = LENGTH // SYMBOL - 1
    # 8-byte symbols from the first place that is a whole number of symbols from the anchor
    phase = [a % SYMBOL for a in anchors]
    counts = [max(0, (len(p) - f) // SYMBOL) for p, f in zip(pieces, phase, strict=True)]
    cut = np.frombuffer(b"".join(p[f : f + SYMBOL * c] for p, f, c in zip(pieces, phase, counts, strict=True)), np.uint64)
    _, rank = np.unique(cut, return_inverse=True)
    owner = np.repeat(np.arange(len(pieces)), counts)
    # a separator of its own after each piece, so that no match spans two
    ends = np.cumsum(counts)
    text = np.insert(rank + len(pieces), ends, np.arange(len(pieces)))
    spot = np.arange(len(cut)) + owner  # where each symbol stands in the text
    sa = np.array(suffix_array(text.tolist()), np.int64)
    back = np.full(len(text), -1, np.int64)
    back[spot] = np.arange(len(cut))
    order = back[sa]
    order = order[order >= 0]
    room = ends[owner] - np.arange(len(cut)) >= span
    order = order[room[order]]  # suffixes of at least 49 symbols, in order
    none = [np.zeros(0, np.int64)] * len(pieces)
    if len(order) < 2:
        return none, none
    same = np.ones(len(order) - 1, bool)
    for k in range(span):
        at = np.flatnonzero(same)
        if not len(at):
            return none, none
        same[at] = rank[order[at] + k] == rank[order[at + 1] + k]
    label = np.r_[0, np.cumsum(~same)]
    size = np.bincount(label)[label]
    order, label = order[size > 1], label[size > 1]
    own = owner[order]
    begin = np.array(phase)[own] + SYMBOL * (order - (ends[own] - np.array(counts)[own]))
    raw = np.frombuffer(b"".join(b"\0" * SYMBOL + p + b"\0" * SYMBOL for p in pieces), np.uint8)
    length = np.array([len(p) for p in pieces])
    base = np.cumsum(length + 2 * SYMBOL) - length - SYMBOL
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    distance = np.array(anchors)[own] - begin
    for shift in range(SYMBOL):  # windows that begin so many bytes before the shared symbols
        whole = (begin >= shift) & (begin - shift + LENGTH <= length[own])
        w = np.flatnonzero(whole)
        if len(w) < 2:
            continue
        start = base[own[w]] + begin[w] - shift
        key = np.zeros((len(w), 4), np.int64)
        key[:, 0], key[:, 1] = label[w], distance[w]
        for k in range(shift):
            key[:, 2] = key[:, 2] * 256 + raw[start + k]
        for k in range(SYMBOL - shift):
            key[:, 3] = key[:, 3] * 256 + raw[start + LENGTH - 1 - k]
        by = np.lexsort((own[w], *key.T))
        new = np.r_[True, (np.diff(key[by], axis=0) != 0).any(axis=1)]
        many = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
        hit = by[many]
        found.append((own[w][hit], begin[w][hit] - shift, ~new[many]))
    if not found:
        return none, none
    owners, starts, later = (np.concatenate(x) for x in zip(*found, strict=True))
    return split_by(owners, starts, len(pieces)), split_by(owners[later], starts[later], len(pieces))


def split_by(owner: np.ndarray, value: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct values of each of ``n`` owners."""
    by = np.lexsort((value, owner))
    owner, value = owner[by], value[by]
    if len(by):
        new = np.r_[True, (np.diff(owner) != 0) | (np.diff(value) != 0)]
        owner, value = owner[new], value[new]
    return np.split(value, np.searchsorted(owner, np.arange(1, n)))


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    new = np.flatnonzero(np.r_[True, np.diff(starts) != 1]) if len(starts) else np.zeros(0, np.int64)
    return starts[new], starts[np.r_[new[1:], len(starts)] - 1] if len(starts) else starts


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): rows with equal id and text have the same key, and the same windows recur in them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def find_contexts(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = texts_of(batch, "text")
            offsets = np.cumsum([0, *map(len, texts)])
            c = contexts(np.frombuffer(b"".join(texts), np.uint8), offsets, length, gram)
            key = batch.column("key").to_numpy()[c.text]
            columns = [key, *(x.astype(np.int32) for x in (c.place, c.first, c.last)), c.anchor, c.content]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "place", "first", "last", "anchor", "content"])

    return rows.select("key", "text").mapInArrow(work, CONTEXT_FIELDS)


def shared_digest(text: bytes, anchor: int, at: int, first: int, last: int) -> bytes:
    """128 bits of the bytes that the windows beginning at ``first`` to ``last`` share, and where they lie from the anchor.

    ``anchor``: the anchor's hash; ``at``: its place in ``text``.
    """
    where = anchor.to_bytes(8, "big", signed=True) + (at - last).to_bytes(4, "big") + (at - first).to_bytes(4, "big")
    return hashlib.blake2b(where + text[last : first + LENGTH], digest_size=16).digest()


def stretches(first: int, last: int, at: int, step: int) -> Iterator[tuple[int, int, int, int]]:
    """Windows from ``first`` to ``last`` cut where their distance from the anchor is a whole number of steps.

    (first, last, and the bounds of the whole stretch that they are part of), so that equal windows are in equal stretches.
    """
    for t in range((at - last) // step, (at - first) // step + 1):
        low, high = at - t * step - step + 1, at - t * step
        yield max(first, low), min(last, high), low, high


LOOSE = "digest binary, anchor long, content long, skip int, at int, first int, last int, bytes binary"
RUNS = "anchor long, content long, lo int, hi int"


def cut_stretches(rows: DataFrame, step: int) -> DataFrame:
    """The rows' windows in stretches of ``step``, each with the digest of the bytes that a whole stretch shares.

    ``first`` and ``last`` count from the start of ``bytes``, which begins ``skip`` bytes into the context.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
        names = ["digest", "anchor", "content", "skip", "at", "first", "last", "bytes"]
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in names[1:]]
            for anchor, content, skip, at, first, last, text in zip(*columns, strict=True):
                for a, b, low, high in stretches(first, last, at, step):
                    # what a whole stretch shares lies within any part of it
                    digest = shared_digest(text, anchor, at, low, high)
                    out.append((digest, anchor, content, skip + a, at - a, 0, b - a, text[a : b + LENGTH]))
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)

    return rows.select("anchor", "content", "skip", "at", "first", "last", "bytes").mapInArrow(work, LOOSE)


def across_parts(loose: DataFrame) -> DataFrame:
    """(anchor, content, lo, hi): windows that stand for their part's equal ones and that another context holds too."""
    for step in STEPS:
        cut = written(cut_stretches(loose, step), f"suffix-stretches-{step}")
        # counted before they meet; what one context holds alone goes
        many = cut.groupBy("digest").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a <> b").select("digest")
        loose = meet(cut, written(many, f"suffix-shared-{step}"), "digest")
    return loose.select("anchor", "content", F.col("skip").alias("lo"), F.col("skip").alias("hi"))


def open_windows(rows: DataFrame, open_: DataFrame, shard_bytes: int | None = None, part: int | None = None) -> DataFrame:
    """(anchor, content, lo, hi): runs of windows, counted from the context's first, that recur in another content.

    An anchor's contexts go to suffix arrays in parts of about ``part``, by
    their content, so no task's memory grows with a passage's texts; what stands
    for the others of its part meets the other parts' (see ``across_parts``).
    """
    shard_bytes, part = shard_bytes or SHARD_BYTES, part or PART
    wanted = open_.select("key", F.struct("anchor", "content", "place", "first", "last", "kinds").alias("c"))
    wanted = wanted.groupBy("key").agg(F.collect_list("c").alias("cs"))  # a text's own contexts: bounded by its length
    cut = meet(rows, wanted, "key")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = None
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for key, text, cs in zip(batch.column("key").to_pylist(), texts_of(batch, "text"), batch.column("cs").to_pylist(), strict=True):
                if key == done:  # equal rows come one after another and are cut the same
                    continue
                done = key
                for c in cs:
                    parts = -(-c["kinds"] // part)
                    deal = c["anchor"] ^ (c["content"] % parts * 0x9E3779B97F4A7C15 & 0x7FFFFFFFFFFFFFFF)
                    out.append((c["anchor"], c["content"], deal, parts, c["place"] - c["first"], text[c["first"] : c["last"] + LENGTH]))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["anchor", "content", "deal", "parts", "at", "bytes"])

    cuts = written(cut.select("key", "text", "cs").mapInArrow(pieces, "anchor long, content long, deal long, parts long, at int, bytes binary"), "suffix-pieces")
    total = cuts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))

    def shard(table: pa.Table) -> pa.Table:
        marks = list(zip(*(table.column(c).to_pylist() for c in ("anchor", "content")), strict=True))
        table = table.take(pa.array(list({m: i for i, m in enumerate(marks)}.values())))  # equal rows have cut the same
        order = np.argsort(table.column("deal").to_numpy(), kind="stable")
        anchors, contents, parts, at = (table.column(c).to_numpy()[order].tolist() for c in ("anchor", "content", "parts", "at"))
        texts = table.column("bytes").take(pa.array(order)).to_pylist()
        # anchors that fall together in a shard can't share a window, so one array serves them all
        found, later = windows_that_recur(texts, at)
        out: list[tuple] = []
        for k, (anchor, content, starts, again) in enumerate(zip(anchors, contents, found, later, strict=True)):
            for lo, hi in zip(*runs(starts), strict=True):
                out.append((anchor, content, int(lo), int(hi), None, None))
            if parts[k] > 1:
                own = np.ones(len(texts[k]) - LENGTH + 1, bool)
                own[again] = False
                for lo, hi in zip(*runs(np.flatnonzero(own)), strict=True):
                    # with the bytes that whole stretches share, which reach no further than a stretch
                    out.append((anchor, content, int(lo), int(hi), at[k], texts[k]))
        columns = list(zip(*out, strict=True)) if out else [()] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["anchor", "content", "lo", "hi", "at", "bytes"])

    dealt = cuts.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)))
    known = written(dealt.groupBy("shard").applyInArrow(shard, f"{RUNS}, at int, bytes binary"), "suffix-runs")
    loose = known.where("bytes is not null").select("anchor", "content", F.lit(0).alias("skip"), "at", F.col("lo").alias("first"), F.col("hi").alias("last"), "bytes")
    return known.where("bytes is null").select("anchor", "content", "lo", "hi").unionByName(across_parts(loose))


def repeated_spans(rows: DataFrame, found: DataFrame, open_runs, length: int, name: str) -> DataFrame:
    """(key, spans): the runs of window starts that recur, for each text that has any."""
    known = recurring(found, name)
    # another content shares the anchor: some windows may recur there
    partly = written(open_runs(rows, known.where("kinds > 1")), f"{name}-open")
    # a content that stands twice recurs whole; this join alone meets the hot contents, and Spark may split them
    whole = meet(found, known.where("n > 1").select("anchor", "content"), ["anchor", "content"])
    whole = written(whole.select("key", F.col("first").alias("lo"), F.col("last").alias("hi")), f"{name}-whole")
    # one that stands once has only its open windows
    once = known.where("n = 1 and kinds > 1").select("key", "anchor", "content", "first")
    part = meet(once, partly, ["anchor", "content"]).select("key", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi"))
    spans = whole.unionByName(part).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return written(spans, f"{name}-spans")


def merged(spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Disjoint maximal (start, end) of the units that the windows cover."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"] + length) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def without(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in gone)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(text)], strict=True))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) of every row."""
    rows = keyed(docs)
    found = written(find_contexts(rows), "suffix-contexts")
    spans = repeated_spans(rows, found, open_windows, LENGTH, "suffix")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text, own in zip(texts_of(batch, "text"), batch.column("spans").to_pylist(), strict=True):
                gone = merged(own, LENGTH)
                kept = without(text, gone)
                spans = [{"start": a, "end": b} for a, b in gone]
                out.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept, spans))
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), SPANS]
            arrays = [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:int,end:int>>"
    return meet(rows, spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(work, names)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
