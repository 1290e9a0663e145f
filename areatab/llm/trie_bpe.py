"""BPE encoding and decoding by a traversal of the trie of distinct words.

The distinct words of a slice of texts are parted as the vocabulary's rules say,
and the distinct parts are inserted into a trie of symbols; the last symbol of a
part carries the end-of-word mark, so a part and a longer one's beginning differ
there. A depth-first walk gives every prefix its state, the last token of its
encoding: the longest token that ends the prefix and stands beside the last
token of what is before it. Exactly one token does, since merges never cross
the border between two neighbours of an encoding, so each side is merged as if
alone. The encoding of a prefix that many words share is thus found once, and a
word's ids are read back along its states.

Two tokens may stand side by side if no rule joins a right end of the first with
a left start of the second before either is used up inside its own token; the
ends, the starts and the ranks that use them up are taken from each token's own
merges when the vocabulary is loaded.

Defined cases: a null or empty text, and one of white space only, has no ids and
an empty decoded text; special tokens written in a text are their ids, as the
library has it; equal rows stay apart; a null doc_id is kept as it is; an empty
table gives an empty result. Vocabularies that join tokens across white space,
or aren't BPE over bytes, are refused.
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from areatab.llm.common import slices, split_words

#: Words, and pairs of tokens, that a worker remembers at most.
REMEMBERED = 800_000
PAIRS = 1_000_000
#: Words that go through one trie at most.
TRIE_WORDS = 50_000
NEVER = 1 << 40
PROBE = "It's a  test,\tof 12 words' ends:\n<|endoftext|>x  Ünï-çødé's I'M don't 3.14 «so» … end"


class Merges:
    """The vocabulary's merge rules, and what each token's own merges say about its two ends."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.vocab, self.suffix = vocab, suffix
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {vocab[a] * self.size + vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.joined = [vocab[a + b] for a, b in pairs]
        self.longest = max(len(self.symbols(t)) for t in vocab)
        # of each token that its own merges make: (inner token at that end, rank that uses it up), outermost first
        self.ends: dict[int, list[tuple[int, int]]] = {}
        self.starts: dict[int, list[tuple[int, int]]] = {}
        for token, own in vocab.items():
            parts = self.merge(token)
            if len(parts) == 1 and parts[0][0] == own:
                self.ends[own], self.starts[own] = self.spine(parts[0], 1), self.spine(parts[0], 0)
        self.reachable = {t: i for t, i in vocab.items() if i in self.ends}
        self.beside: dict[int, bool] = {}

    def symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            stem = token[: -len(self.suffix)]
            return [*stem[:-1], stem[-1] + self.suffix]
        return list(token)

    def merge(self, token: str) -> list[tuple]:
        """The token's symbols joined by rule: nodes (id, left, right, rank)."""
        if any(s not in self.vocab for s in self.symbols(token)):
            return []
        parts: list[tuple] = [(self.vocab[s], None, None, -1) for s in self.symbols(token)]
        while len(parts) > 1:
            ranks = [self.rank.get(a[0] * self.size + b[0], NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            r = min(ranks)
            if r == NEVER:
                break
            k = ranks.index(r)
            parts[k : k + 2] = [(self.joined[r], parts[k], parts[k + 1], r)]
        return parts

    @staticmethod
    def spine(node: tuple, side: int) -> list[tuple[int, int]]:
        out, used = [], NEVER
        while node is not None:
            out.append((node[0], used))
            used, node = node[3], node[1 + side]
        return out

    def fits(self, first: int, second: int) -> bool:
        """Whether the two tokens stay apart where they stand side by side."""
        key = first * self.size + second
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) >= PAIRS:
                self.beside.clear()
            rank, size = self.rank, self.size
            known = True
            for x, x_used in self.ends[first]:
                for y, y_used in self.starts[second]:
                    r = rank.get(x * size + y)
                    # of equal ranks the pair further left goes first
                    if r is not None and r < x_used and r <= y_used:
                        known = False
            self.beside[key] = known
        return known


def shared_prefixes(parts: list[str], seen: int = 32) -> list[int]:
    """Of each of the sorted parts, how many symbols its branch of the trie shares with the one before."""
    shared = np.zeros(len(parts), np.int64)
    if len(parts) > 1:
        letters = np.array([p[:seen] for p in parts], f"<U{seen}").view(np.uint32).reshape(len(parts), seen)
        same = letters[1:] == letters[:-1]
        shared[1:] = np.where(same.all(axis=1), seen, same.argmin(axis=1))
    out = shared.tolist()
    for k in np.flatnonzero(shared == seen).tolist():
        a, b = parts[k - 1], parts[k]
        while out[k] < min(len(a), len(b)) and a[out[k]] == b[out[k]]:
            out[k] += 1
    # the last symbol carries the end of the word and is nobody else's
    return [min(n, len(a) - 1, len(b) - 1) for n, a, b in zip(out, ["", *parts], parts, strict=False)]


def encode_parts(parts: list[str], rules: Merges) -> dict[str, list[int]]:
    """The ids of distinct parts, by one walk over their trie, depth first.

    The trie is held as the sorted parts and the lengths of the prefixes that
    neighbours share: a branch leaves the one before it there, and the states
    down to that node are kept.
    """
    parts = sorted(parts)
    suffix, longest, fits, beside, size = rules.suffix, rules.longest, rules.fits, rules.beside, rules.size
    token_of = rules.reachable.get
    out: dict[str, list[int]] = {}
    last, begin = [-1], [0]  # of each prefix on the way down: its last token, and where that begins
    for part, shared in zip(parts, shared_prefixes(parts), strict=True):
        n = len(part)
        del last[max(shared, 0) + 1 :], begin[max(shared, 0) + 1 :]
        for end in range(max(shared, 0) + 1, n + 1):
            way = part[:end] if end < n else part + suffix
            for i in range(end - longest if end > longest else 0, end):
                token = token_of(way[i:])
                if token is not None:
                    if not i:
                        break
                    known = beside.get(last[i] * size + token)
                    if known or (known is None and fits(last[i], token)):
                        break
            else:
                raise ValueError(f"no token for {way[-1]!r}")
            last.append(token)
            begin.append(i)
        ids, at = [], n
        while at:
            ids.append(last[at])
            at = begin[at]
        ids.reverse()
        out[part] = ids
    return out


class Encoder:
    """Ids of texts; remembers the words it has met."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or spec.get("decoder"):
            raise ValueError(f"{path}: not a plain BPE vocabulary")
        self.rules = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        self.special = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        whole = self.tokenizer.encode(PROBE, add_special_tokens=False).ids
        if whole != [i for w in PROBE.split() for i in self.tokenizer.encode(w, add_special_tokens=False).ids]:
            raise ValueError(f"{path}: ids of a text aren't those of its words")
        # printable ASCII needs no rules but these; checked on words of all of it
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
        shown = "".join(map(chr, range(0x21, 0x7F)))
        probes = [shown, shown[::-1], *(f"Ab{c}'LL{c}{c}9{c}'re" for c in shown), "x" * 70]
        self.plain = all(self.ascii.findall(p.lower()) == self.by_rules(p) for p in probes)
        self.known: dict[str, list[int]] = {}
        strings = dict(zip(model["vocab"].values(), model["vocab"], strict=True)) | {i: t for t, i in added.items()}
        n = max(strings) + 1
        self.decimals = pa.array([f"{i} " for i in range(n)], pa.large_string())
        # without a decoder of its own the library sets one blank between tokens
        self.strings = pa.array([strings.get(i, "") + " " for i in range(n)], pa.large_string())

    def by_rules(self, piece: str) -> list[str]:
        """The parts of a text without special tokens, by the vocabulary's own rules."""
        t = self.tokenizer
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(piece) if t.normalizer else piece)]

    def parts(self, word: str) -> list[str | int]:
        """Parts of a word; a special token is its id."""
        if self.special is not None and "<" in word:
            pieces = self.special.split(word)
            if len(pieces) > 1:
                return [p for k, x in enumerate(pieces) if x for p in ([self.added[x]] if k % 2 else self.parts(x))]
        if self.plain and word.isascii() and word.isprintable():
            return self.ascii.findall(word.lower())
        return self.by_rules(word)

    def learn(self, words: list[str]) -> None:
        split = [self.parts(w) for w in words]
        ids = encode_parts(list({p for own in split for p in own if type(p) is str}), self.rules)
        for word, own in zip(words, split, strict=True):
            self.known[word] = ids[own[0]] if len(own) == 1 and type(own[0]) is str else [i for p in own for i in (ids[p] if type(p) is str else (p,))]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        ids, words, offsets = split_words(texts)
        names = words.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in names if w not in self.known]
        for k in range(0, len(new), TRIE_WORDS):
            self.learn(new[k : k + TRIE_WORDS])
        found = [self.known[w] for w in names]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))
        begin = np.cumsum(size) - size
        count = size[ids]
        after = np.r_[0, np.cumsum(count)]
        at = np.repeat(begin[ids] - after[:-1], count) + np.arange(after[-1])
        return flat[at], np.diff(after[offsets])


@cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker process: what it remembers depends on the words only."""
    return Encoder(path)


def joined(table: pa.Array, ids: np.ndarray, count: np.ndarray) -> list[memoryview]:
    """Of each text, the strings of its ids one after the other, without the blank at the end."""
    taken = table.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    ends = offsets[np.r_[0, np.cumsum(count)]].tolist()
    view = memoryview(taken.buffers()[2] or b"")
    return [view[a : max(a, b - 1)] for a, b in zip(ends, ends[1:], strict=False)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, "text"):
            ids, count = own(batch.column("text"))
            offsets = pa.array(np.r_[0, np.cumsum(count)].astype(np.int32))
            decoded = [bytes(x).decode() for x in joined(own.strings, ids, count)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return _texts(docs).mapInArrow(work, "doc_id long, ids array<int>, decoded string")


def decode(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """All rows and columns of ``rows``, and ``decoded``, the text of the ids in ``column`` (null: empty; nulls in it: skipped)."""
    other = [c for c in rows.columns if c != "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            lists = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            ids = batch.column(column).flatten().to_numpy(zero_copy_only=False)
            decoded = pa.array([bytes(x).decode() for x in joined(own.strings, ids, lists)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in other), decoded], [*other, "decoded"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in other)
    rows = rows.withColumn(column, F.filter(F.col(f"`{column}`"), lambda x: x.isNotNull()))
    return rows.select(*(F.col(f"`{c}`") for c in other)).mapInArrow(work, f"{kinds}, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; ids and texts stay in their task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, "text"):
            ids, count = own(batch.column("text"))
            sums = ([hashlib.sha256(x).hexdigest() for x in joined(table, ids, count)] for table in (own.decimals, own.strings))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count, pa.int64()), *(pa.array(s, pa.string()) for s in sums)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
