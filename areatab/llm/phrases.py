"""Removal of passages that recur, by sharded Aho-Corasick automata over words.

A window is 35 consecutive words of one text. First the recurring windows are
confirmed: windows meet in one place by their anchor (see ``contexts``), equal
contexts as one row, and where contents of one anchor differ, the windows'
hashes of 128 bits are compared. The passages they make up are cut into phrases
of 35 words. Every shard, a bounded slice of the documents, gets an automaton of
its phrases, and all its texts are streamed through it; what any phrase matches
is removed. The phrases of a text's own passages are always in its shard, so
every occurrence is met, and every match is a window confirmed to recur.

Defined cases: a null text has no words; texts under 35 words keep all; equal
rows are copies of each other; words keep their case and punctuation; a null
doc_id is kept as it is. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import BASES, meet, ranges_hash, slices, split_words, texts_of, written
from areatab.llm.contexts import CONTEXT_FIELDS, contexts
from areatab.llm.suffixes import keyed, merged, repeated_spans, runs

LENGTH = 35
GRAM = 5
#: Bytes of text in a shard, whose automaton holds at most about as many letters.
SHARD_BYTES = 1 << 20


def word_codes(texts: pa.Array, base: int = BASES[1]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, and where each text begins (and the end)."""
    ids, words, offsets = split_words(texts)
    data = words.cast(pa.large_binary())
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return ranges_hash(raw, ends[:-1] - ends[0], ends[1:] - ends[0], base)[ids], offsets


def find_contexts(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            c = contexts(*word_codes(batch.column("text")), length, gram)
            key = batch.column("key").to_numpy()[c.text]
            columns = [key, *(x.astype(np.int32) for x in (c.place, c.first, c.last)), c.anchor, c.content]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "place", "first", "last", "anchor", "content"])

    return rows.select("key", "text").mapInArrow(work, CONTEXT_FIELDS)


def open_windows(rows: DataFrame, open_: DataFrame) -> DataFrame:
    """(anchor, content, lo, hi): runs of windows, counted from the context's first, that recur in another content.

    The windows of open contents meet by their 128-bit hash; counts are combined
    before the shuffle, so a passage that many texts share costs no more.
    """
    wanted = open_.select("key", F.struct("anchor", "content", "first", "last").alias("c"))
    wanted = wanted.groupBy("key").agg(F.collect_list("c").alias("cs"))  # a text's own contexts: bounded by its length

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, offsets = word_codes(batch.column("text"))
            other = (words ^ (words >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
            cs = batch.column("cs")
            which = np.repeat(np.arange(len(cs)), np.diff(cs.offsets.to_numpy()))
            flat = cs.flatten()
            first, last = (flat.field(c).to_numpy().astype(np.int64) for c in ("first", "last"))
            n = last - first + 1
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(first + offsets[which], n) + at
            h1, h2 = (ranges_hash(w, start, start + LENGTH, b) for w, b in ((words, BASES[0]), (other, BASES[1])))
            names = ["h1", "h2", "anchor", "content", "at"]
            rest = [np.repeat(flat.field(c).to_numpy(), n) for c in ("anchor", "content")]
            columns = [h1.view(np.int64), h2.view(np.int64), *rest, at.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    schema = "h1 long, h2 long, anchor long, content long, at int"
    found = written(meet(rows, wanted, "key").select("text", "cs").mapInArrow(windows, schema), "phrase-windows")
    # equal rows give equal contents: a window counts once for each content
    many = found.groupBy("h1", "h2").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a <> b").select("h1", "h2")
    hit = meet(found, many, ["h1", "h2"]).groupBy("anchor", "content").agg(F.array_sort(F.collect_set("at")).alias("ats"))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, int(lo), int(hi)) for i, ats in enumerate(batch.column("ats").to_pylist()) for lo, hi in zip(*runs(np.array(ats)), strict=True)]
            i, lo, hi = (pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(i), batch.column("content").take(i), lo, hi], ["anchor", "content", "lo", "hi"])

    return hit.mapInArrow(ranges, "anchor long, content long, lo int, hi int")


def phrases_of(words: list[bytes], passages: list[tuple[int, int]]) -> Iterator[bytes]:
    """Runs of 35 words that cover each passage; the last one ends where the passage does."""
    for a, b in passages:
        for at in [*range(a, b - LENGTH, LENGTH), b - LENGTH]:
            yield b" ".join(words[at : at + LENGTH])


def stream(texts: list[list[bytes]], phrases: set[bytes]) -> list[np.ndarray]:
    """Of each text, which words a phrase covers, wherever it occurs."""
    automaton = ahocorasick.Automaton()
    for p in phrases:
        # one character a byte; blanks on both sides keep matches to whole words
        automaton.add_word(" " + p.decode("latin-1") + " ", True)
    automaton.make_automaton()
    out = []
    for words in texts:
        covered = np.zeros(len(words) + 1, np.int64)
        if len(words) >= LENGTH:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1)  # place of the blank after each word, in " w w w "
            line = " " + b" ".join(words).decode("latin-1") + " "
            hits = np.fromiter((at for at, _ in automaton.iter(line)), np.int64)
            if len(hits):
                last = np.searchsorted(ends, hits)
                np.add.at(covered, last - LENGTH + 1, 1)
                np.add.at(covered, last + 1, -1)
        out.append(np.cumsum(covered)[: len(words)] > 0)
    return out


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept, spans) of every row."""
    rows = keyed(docs)
    found = written(find_contexts(rows), "phrase-contexts")
    spans = repeated_spans(rows, found, open_windows, LENGTH, "phrase")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHARD_BYTES):
            texts = [t.split() for t in texts_of(batch, "text")]
            passages = [merged(own, LENGTH) for own in batch.column("spans").to_pylist()]
            phrases = {p for words, own in zip(texts, passages, strict=True) for p in phrases_of(words, own)}
            covered = stream(texts, phrases) if phrases else [np.zeros(len(w), bool) for w in texts]
            out = []
            for words, gone in zip(texts, covered, strict=True):
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)
                lo, hi = runs(np.flatnonzero(gone))
                own = [{"start": int(a), "end": int(b) + 1} for a, b in zip(lo, hi, strict=True)]
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept, own))
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary(), SPANS]
            arrays = [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "spans"])

    names = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary, spans array<struct<start:int,end:int>>"
    return meet(rows, spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(work, names)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
