"""Token ids in a bit-packed file format.

A table of blocks, written as Parquet to a folder that Spark reaches, holds the
ids of all documents in ascending doc_id order. Each id takes the least number
of bits that the vocabulary needs. A block holds whole documents, at least
``BLOCK_IDS`` ids unless it ends a range, with its place (range, block), its
documents' ids and lengths, so that a document's bits are found from the lengths
before it. Packing and unpacking are vectorised: 64 ids take as many 64-bit
words as an id has bits, and every one of the 64 places has the same shift in
all of them.

Texts are tokenised word by word: the vocabulary's rules drop white space and
never join across it, so each distinct word of a slice is encoded once.
Tokenizers whose ids of a text aren't those of its words, which a probe on
loading finds, encode whole texts.

Defined cases: a null or empty text has the end id only; of equal doc_ids the
order is that of their texts; null doc_ids come first; an empty table gives an
empty file and result.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from areatab.llm.common import range_buckets, slices, split_words, totals_before
from areatab.session import scratch_path

END = 1
PUNCTUATION = string.punctuation
#: Parts of words that a task remembers at most.
REMEMBERED = 800_000
BLOCK_IDS = 1 << 16
PROBE = "It's a  test,\tof 12 words' ends:\n<|endoftext|>x  Ünï-çødé's I'M don't 3.14 «so» … end"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


# The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
ALPHABET = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in SHOWN)}


def letters(word: str) -> str | None:
    """A Latin word of letters only as the byte-level model reads it; None for any other word."""
    if not word.isalpha():
        return None
    if word.isascii():
        return word.lower()
    # each letter has one lower case of its own here
    if max(word) >= "\u0250" or "\u0130" in word or not unicodedata.is_normalized("NFC", word):
        return None
    return word.lower().encode().decode("latin-1").translate(ALPHABET)


@cache
def loaded(path: str) -> tuple[Tokenizer, bool, bool]:
    """The tokenizer; whether a text's ids are its words' ids; whether plain words go to its model unchanged."""
    t = Tokenizer.from_file(path)
    whole = t.encode(PROBE, add_special_tokens=False).ids
    parts = [i for w in PROBE.split() for i in t.encode(w, add_special_tokens=False).ids]
    latin = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    probes = [*latin, *("x" + a + b for a, b in zip(latin, latin[7:], strict=False)), "unbelievable", "Straße", "œuvre", string.ascii_lowercase * 3]
    same = all([x.id for x in t.model.tokenize(y)] == t.encode(w, add_special_tokens=False).ids for w in probes if (y := letters(w)))
    return t, whole == parts, same


def bits_for(path: str) -> int:
    """Bits that every id of the vocabulary fits in."""
    return max(1, (loaded(path)[0].get_vocab_size(with_added_tokens=True) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids of ``width`` bits (1 to 32) each, least bit first."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    lanes = np.ascontiguousarray(padded.reshape(groups, 64).T)
    words = np.zeros((width, groups), np.uint64)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        words[word] |= lanes[k] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()[: (len(ids) * width + 7) // 8]


def unpack(data: bytes, count: int, width: int, start: int = 0) -> np.ndarray:
    """``count`` ids from the id ``start`` on, reading only the words that hold them."""
    first = start // 64
    groups = -(-(start + count) // 64) - first
    raw = np.frombuffer(data, np.uint8)[first * 8 * width : (first + groups) * 8 * width]
    words = np.zeros(groups * 8 * width, np.uint8)
    words[: len(raw)] = raw
    words = np.ascontiguousarray(words.view("<u8").reshape(groups, width).T)
    out = np.empty((64, groups), np.uint64)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[k] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            out[k] |= words[word + 1] << np.uint64(64 - shift)
    mask = np.uint64((1 << width) - 1)
    return (out.T.ravel()[start - first * 64 : start - first * 64 + count] & mask).astype(np.uint32)


class Encoder:
    """Ids of texts, each followed by the end id; remembers the parts of words it has met.

    A word's closing run of ASCII punctuation is a part of its own, and ASCII
    letters are lowered beforehand, as the vocabulary's rules do anyway; words
    that might hold a special token are left as they are. Parts of Latin
    letters only go to the tokenizer's model directly.
    """

    def __init__(self, path: str, end: int = END):
        self.tokenizer, self.by_word, self.plain = loaded(path)
        self.end = end
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.flat = [np.zeros(0, np.uint32), np.array([self.end], np.uint32)]
        self.sizes = [np.array([0, 1], np.int64)]  # nothing, the end
        self.count = 2

    def ids_of(self, part: str) -> list[int]:
        if self.plain and (own := letters(part)):
            return [x.id for x in self.tokenizer.model.tokenize(own)]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def numbers(self, parts: pa.Array) -> np.ndarray:
        """The number by which each part is known; new ones are encoded."""
        coded = parts.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [x for x in names if x not in self.known]
        if new:
            found = [self.ids_of(x) for x in new]
            self.known.update(zip(new, range(self.count, self.count + len(new)), strict=True))
            self.count += len(new)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.sizes.append(sizes)
            self.flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))
        numbers = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        return numbers[coded.indices.to_numpy()]

    def parts(self, words: pa.Array) -> np.ndarray:
        """Two parts of each word; the second may be nothing."""
        stems = pc.utf8_rtrim(words, PUNCTUATION)
        # only after a letter or a digit does the run begin a part of its own
        apart = pc.and_(pc.match_substring_regex(stems, r"[\pL0-9]$"), pc.invert(pc.match_substring(words, "<|")))
        stems = pc.if_else(apart, pc.ascii_lower(stems), words)
        out = np.zeros((len(words), 2), np.int64)
        out[:, 0] = self.numbers(stems)
        cut = pc.binary_length(stems).to_numpy()
        rest = np.flatnonzero(pc.binary_length(words).to_numpy() > cut)
        # the run is ASCII: its length in bytes is its length in characters
        tails = [w[len(w) - n :] for w, n in zip(words.take(pa.array(rest)).to_pylist(), (pc.binary_length(words).to_numpy() - cut)[rest].tolist(), strict=True)]
        out[rest, 1] = self.numbers(pa.array(tails, pa.string()))
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        if not self.by_word:
            found = [[*self.tokenizer.encode(t or "", add_special_tokens=False).ids, self.end] for t in texts.to_pylist()]
            return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)
        if self.count > REMEMBERED:
            self.forget()
        ids, words, offsets = split_words(texts)
        parts = self.parts(words)[ids]
        parts = np.insert(parts, offsets[1:], [[1, 0]], axis=0)
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets) + 1)
        sizes, flat = np.concatenate(self.sizes), np.concatenate(self.flat)
        self.sizes, self.flat = [sizes], [flat]
        begin = np.cumsum(sizes) - sizes
        per_word = sizes[parts].sum(axis=1)
        parts = parts.ravel()
        count = sizes[parts]
        from_ = begin[parts] - (np.cumsum(count) - count)
        return flat[np.repeat(from_, count) + np.arange(int(count.sum()))], np.bincount(doc, per_word, len(texts)).astype(np.int64)


@cache
def encoder(path: str, end: int) -> Encoder:
    """One for all tasks of a worker process: what it remembers depends on the words only."""
    return Encoder(path, end)


BLOCKS = "bucket int, block int, width int, n_ids long, doc_ids array<bigint>, n_tokens array<bigint>, payload binary"
FIELDS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int32()), ("width", pa.int32()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("payload", pa.binary()),
])


def write(docs: DataFrame, out: str, path: str, end: int = END, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all texts in ascending doc_id order to the folder ``out``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = range_buckets(rows, "doc_id", rows.count(), 1024)
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, block, at, encode = bits_for(path), 0, -1, encoder(path, end)
        docs_, sizes, parts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            row = {"bucket": at, "block": block, "width": width, "n_ids": held, "doc_ids": docs_, "n_tokens": sizes}
            return pa.RecordBatch.from_pylist([row | {"payload": pack(np.concatenate(parts), width)}], FIELDS)

        for batch in slices(batches, "text"):
            ids, count = encode(batch.column("text"))
            stop = np.cumsum(count)
            for bucket, doc, a, b in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), stop - count, stop, strict=True):
                if docs_ and (bucket != at or held >= block_ids):
                    yield close()
                    docs_, sizes, parts, held, block = [], [], [], 0, block + 1
                if bucket != at:
                    at, block = bucket, 0
                docs_.append(doc)
                sizes.append(int(b - a))
                parts.append(ids[a:b])
                held += int(b - a)
        if docs_:
            yield close()

    dealt.select("bucket", "doc_id", "text").mapInArrow(work, BLOCKS).write.parquet(out)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, bucket, block, at) of every document in the file.

    ``start``: ids of all documents before it; ``at``: its first id's place in its block.
    """
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    sizes = blocks.select("bucket", "block", "n_ids")
    before = totals_before(sizes, "n_ids")
    inside = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(before, "bucket")
    starts = starts.select("bucket", "block", (F.col("before") + F.col("inside")).alias("first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["n_ids"], row["width"]).astype("<u4")
                count = np.array(row["n_tokens"], np.int64)
                at = np.cumsum(count) - count
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), count.tolist(), strict=True)]
                n = len(count)
                place = [pa.array(np.full(n, row[c], np.int32)) for c in ("bucket", "block")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(at), pa.array(count), pa.array(crc, pa.int64()), *place],
                    ["doc_id", "at", "n_tokens", "ids_crc32", "bucket", "block"],
                )

    found = blocks.mapInArrow(work, "doc_id long, at long, n_tokens long, ids_crc32 long, bucket int, block int")
    joined = found.join(starts, ["bucket", "block"])
    return joined.select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "bucket", "block", "at")


def document(spark: SparkSession, folder: str, bucket: int, block: int, at: int, n_tokens: int) -> np.ndarray:
    """The ids of one document by its place: random access, one block read and only its words unpacked."""
    row = spark.read.schema(BLOCKS).parquet(folder).where((F.col("bucket") == bucket) & (F.col("block") == block)).first()
    return unpack(bytes(row["payload"]), n_tokens, row["width"], at)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the file to the shared folder and read it back."""
    spark = docs.sparkSession
    out = scratch_path(spark, "token-ids")
    write(docs, out, path or vocabulary())
    return read(spark, out)
