"""Toxicity by a linear-chain conditional random field over words.

``fit`` turns the labelled documents into labelled tokens: words and word
beginnings that stand out in toxic documents by a likelihood ratio and hardly
occur in the others mark toxic tokens there; weaker ones are left unlabelled,
and near copies are counted once. A two-label chain
(plain, toxic) with word, prefix, suffix and neighbour features is trained on
these by its exact forward-backward marginals. A document's score is a logistic
function of its tokens' marginals, fitted on labelled documents kept out of the
chain's training; runs of marginals from 0.5 on are the offending offsets.
Chains end at sentence ends, and after 512 words without one.

Training takes a bounded sample of the labelled rows (``toxic_docs``,
``clean_docs``, texts up to ``max_chars``); scoring reads every whole text in
its own task, with a model of fixed size.

Defined cases: a null or empty text has no tokens and gets the score of a
document without toxic tokens; a document labelled twice counts as toxic if any
of its labels is; null labels and labels without a document are left out of the
training; without labels of both kinds every score is 0. Repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areatab.llm.common import ranges_hash, slices, split_words

BITS = 18
CHAIN = 512
#: The features by which a word tells of its neighbours: itself and its first four bytes.
NEAR = [0, 2]
THRESHOLD = 0.3
#: Stripped from both ends of a word before it is looked at.
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…"
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


@dataclass
class Model:
    weights: np.ndarray  # (own, previous, next) x hashed features
    bias: float
    moves: np.ndarray  # 2 x 2 transition potentials, exponentiated
    scale: np.ndarray  # of the document's score: constant, peak, mass
    known: bool = True


def codes(words: pa.Array) -> np.ndarray:
    """What a cleaned word may be known by, as numbers: itself, its first 3 to 7 bytes, its last 3 bytes."""
    plain = words.cast(pa.large_binary())
    if isinstance(plain, pa.ChunkedArray):
        plain = plain.combine_chunks()
    ends = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    start, length = ends[:-1] - ends[0], np.diff(ends)
    wide = np.r_[data, np.zeros(8, np.uint8)]
    inside = np.arange(8) < length[:, None]
    begin = np.where(inside, wide[start[:, None] + np.arange(8)], 0).astype(np.uint8).view(np.uint64)[:, 0]
    last = np.minimum(length, 3)
    finish = np.zeros(len(length), np.uint64)
    for k in range(3):
        byte = wide[np.maximum(start + length - 1 - k, 0)].astype(np.uint64)
        finish |= np.where(last > k, byte << np.uint64(8 * k), np.uint64(0))
    whole = ranges_hash(data, start, start + length)
    found = [whole, *(begin & np.uint64((1 << 8 * k) - 1) for k in (3, 4, 5, 6, 7)), finish]
    return np.stack([(x + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15) for k, x in enumerate(found)], axis=1)


def features(words: pa.Array) -> np.ndarray:
    """The codes as places in a table of 2 ** BITS weights."""
    x = codes(words)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int64)


def clean(words: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(words), EDGES)


class Chains:
    """All tokens of some texts, laid out in chains of like length."""

    def __init__(self, ids: np.ndarray, words: pa.Array, offsets: np.ndarray):
        self.ids, n = ids, len(ids)
        stop = pc.match_substring_regex(words, r"[.!?][^\pL\pN]*$").to_numpy(zero_copy_only=False).astype(bool)
        start = np.zeros(n + 1, bool)
        start[offsets] = True
        if n:
            start[1:] |= stop[ids]
        first = np.flatnonzero(start[:n])
        length = np.diff(np.r_[first, n])
        # cut what is longer than CHAIN
        parts = -(-length // CHAIN)
        piece = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + piece * CHAIN
        self.first, self.length = first, np.diff(np.r_[first, n])
        self.has_prev = np.ones(n, bool)
        self.has_prev[first] = False
        self.has_next = np.r_[self.has_prev[1:], False] if n else np.zeros(0, bool)
        self.grids = []
        if n:
            rounded = np.where(self.length <= 8, self.length, -(-self.length // 8) * 8)
            for w in np.unique(rounded):
                rows = np.flatnonzero(rounded == w)
                grid = self.first[rows][:, None] + np.arange(w)[None, :]
                inside = np.arange(w)[None, :] < self.length[rows][:, None]
                self.grids.append((np.where(inside, grid, n), inside))  # n: a place beside the tokens

    def unary(self, own: np.ndarray, prev: np.ndarray, nxt: np.ndarray, bias: float) -> np.ndarray:
        s = own[self.ids] + bias
        s[1:] += np.where(self.has_prev[1:], prev[self.ids[:-1]], 0)
        s[:-1] += np.where(self.has_next[:-1], nxt[self.ids[1:]], 0)
        return s

    def marginals(self, unary: np.ndarray, moves: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Each token's probability to be toxic, and the expected transitions."""
        n = len(unary)
        odds = np.exp(np.clip(np.r_[unary, 0.0], -30, 30))
        p, counts = np.zeros(n + 1), np.zeros((2, 2))
        (m00, m01), (m10, m11) = moves
        for grid, inside in self.grids:
            e, width = odds[grid], grid.shape[1]
            ahead, back = np.empty_like(e), np.ones_like(e)
            ahead[:, 0] = e[:, 0]
            for t in range(1, width):
                r = ahead[:, t - 1]
                ahead[:, t] = e[:, t] * (m01 + r * m11) / (m00 + r * m10)
            for t in range(width - 2, -1, -1):
                x = e[:, t + 1] * back[:, t + 1]
                back[:, t] = np.where(inside[:, t + 1], (m10 + m11 * x) / (m00 + m01 * x), 1.0)
            both = ahead * back
            p[grid] = both / (1 + both)
            if pairs and width > 1:
                r, x = ahead[:, :-1], e[:, 1:] * back[:, 1:]
                joint = np.stack([np.full_like(r, m00), m01 * x, m10 * r, m11 * r * x])
                joint /= joint.sum(axis=0)
                counts += (joint * inside[:, 1:]).sum(axis=(1, 2)).reshape(2, 2)
        return p[:n], counts


def strength(known: np.ndarray, doc: np.ndarray, ids: np.ndarray, toxic: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words mark toxic tokens, and which may: by how far a code's share of toxic documents stands out.

    ``known`` has each word's codes; a word is as telling as its most telling
    code, measured by the log-likelihood ratio over the documents in ``use``.
    """
    n, m = int((toxic & use).sum()), int((~toxic & use).sum())
    sure, maybe = np.zeros(len(known), bool), np.zeros(len(known), bool)
    term = lambda x, e: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    for column in range(known.shape[1] - 1):
        _, code = np.unique(known[:, column], return_inverse=True)
        size = int(code.max()) + 1
        pairs = np.unique(doc * size + code[ids])
        pairs = pairs[use[pairs // size]]
        of, bad = pairs % size, toxic[pairs // size]
        a, b = np.bincount(of[bad], minlength=size).astype(float), np.bincount(of[~bad], minlength=size).astype(float)
        c, d, total = n - a, m - b, n + m
        ratio = 2 * (term(a, (a + b) * n / total) + term(b, (a + b) * m / total) + term(c, (c + d) * n / total) + term(d, (c + d) * m / total))
        ratio = np.where(a * m > b * n, ratio, 0.0)
        pure = a * m >= 19 * b * n  # as if both kinds were equally many: the sample's balance is arbitrary
        sure |= ((ratio >= 20) & pure)[code]
        maybe |= (ratio >= 4)[code]
    return sure, maybe


def near_copies(offsets: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which texts share one of three least hashed runs of five words with an earlier text."""
    seen: set[tuple[int, int]] = set()
    out = np.zeros(len(offsets) - 1, bool)
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
    for i in range(len(out)):
        w = words[offsets[i] : offsets[i + 1]].astype(np.uint64) + np.uint64(1)
        run = w.copy()
        for k in range(1, 5):
            run = run[:-1] * np.uint64(1_000_003) + w[k:] if len(w) > k else run
        for j, f in enumerate(odd):
            x = run * f
            x ^= x >> np.uint64(29)
            least = (j, int((x * f).min())) if len(run) else (j, 0)
            out[i] |= least in seen
            seen.add(least)
    return out


def sample(docs: DataFrame, labels: DataFrame, toxic_docs: int, clean_docs: int, max_chars: int) -> DataFrame:
    """(text, toxic) of at most ``toxic_docs`` and ``clean_docs`` learnable rows, by the order of their ids' hash."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(learnable() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(7))
    picked = [marks.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(n) for t, n in ((1, toxic_docs), (0, clean_docs))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most toxic_docs + clean_docs rows of two numbers
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = whole.where(F.length("text") <= max_chars).join(ids, "doc_id")
    return rows.orderBy(order, "doc_id", "text").limit(toxic_docs + clean_docs).select("text", "toxic")


def train(texts: list[str], toxic: np.ndarray, prior: float | None = None, epochs: int = 25, rate: float = 0.5, decay: float = 1e-6) -> Model:
    """Fit the chain on three quarters of the texts, the document's score on the rest and those.

    ``prior``: the share of toxic documents that the score is to reckon with
    (None: that of the texts given, which a sample by kind may have shifted).
    """
    blank = Model(np.zeros((3, 1 << BITS), np.float32), 0.0, np.ones((2, 2)), np.array([-20.0, 0, 0]), False)
    if not toxic.any() or toxic.all():
        return blank
    ids, raw, offsets = split_words(pa.array(texts))
    if not len(ids):
        return blank
    cleaned = clean(raw)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    held = np.arange(len(texts)) % 4 == 3
    first = ~held & ~near_copies(offsets, ids)  # a group of copies would pass its every word off as telling
    listed, unsure = strength(codes(cleaned), doc, ids, toxic, first)
    unsure &= ~listed
    y = (listed[ids] & toxic[doc]).astype(float)
    use = ~held[doc] & ~(unsure[ids] & toxic[doc])
    f = features(cleaned)
    near = f[:, NEAR]
    chains = Chains(ids, raw, offsets)
    size = 1 << BITS
    w, seen, w_bias, seen_bias = np.zeros((3, size)), np.full((3, size), 1e-8), -4.0, 1e-8
    logs, seen_moves = np.zeros((2, 2)), np.full((2, 2), 1e-8)
    link = chains.has_prev & use
    then, now = y[np.flatnonzero(link) - 1].astype(int), y[link].astype(int)
    gold = np.bincount(then * 2 + now, minlength=4).reshape(2, 2).astype(float)
    share = max(1.0, float(use.sum()))
    wide = use.mean()
    for _ in range(epochs):
        own, prev, nxt = w[0][f].sum(axis=1), w[1][near].sum(axis=1), w[2][near].sum(axis=1)
        p, expected = chains.marginals(chains.unary(own, prev, nxt, w_bias), np.exp(logs), True)
        g = np.where(use, y - p, 0.0)
        after, ahead = np.where(chains.has_prev, g, 0.0), np.where(chains.has_next, g, 0.0)
        of = np.bincount(ids, g, len(raw)), np.bincount(ids[:-1], after[1:], len(raw)), np.bincount(ids[1:], ahead[:-1], len(raw))
        for k, (table, x) in enumerate(((f, of[0]), (near, of[1]), (near, of[2]))):
            grad = np.bincount(table.ravel(), np.repeat(x, table.shape[1]), size) - decay * share * w[k]
            seen[k] += grad**2
            w[k] += rate * grad / np.sqrt(seen[k])
        grad = g.sum()
        seen_bias += grad**2
        w_bias += rate * grad / seen_bias**0.5
        grad = gold - expected * wide
        seen_moves += grad**2
        logs += 0.1 * grad / np.sqrt(seen_moves)
    model = Model(w.astype(np.float32), float(w_bias), np.exp(logs - logs[0, 0]), np.zeros(3))
    p, _ = chains.marginals(chains.unary(w[0][f].sum(axis=1), w[1][near].sum(axis=1), w[2][near].sum(axis=1), w_bias), model.moves)
    x = evidence(p, offsets)
    b = np.array([-3.0, 0.5, 0.5])
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    # the two kinds count alike in the held-out quarter and in what the chain has seen
    weight = np.where(held, 3.0, 1.0)
    if prior is not None:
        whole = weight.sum()
        for kind, share in ((toxic, prior), (~toxic, 1 - prior)):
            weight[kind] *= share * whole / weight[kind].sum()
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + ridge, x.T @ (weight * (toxic - q)) - ridge @ b)
        b = b + np.clip(step, -2, 2)
    model.scale = b
    return model


def evidence(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text: 1, its strongest token's log odds, the log of 1 plus the expected number of toxic tokens."""
    n = len(offsets) - 1
    top, mass = np.zeros(n), np.zeros(n)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    if len(filled):
        top[filled] = np.maximum.reduceat(p, offsets[filled])
        mass[filled] = np.add.reduceat(p, offsets[filled])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(n), np.log(top / (1 - top)), np.log1p(mass)], axis=1)


def judge(model: Model, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    """Score and offending offsets (code points, end excluded) of each text."""
    n = len(texts)
    if not model.known:
        return np.zeros(n), [[] for _ in range(n)]
    ids, raw, offsets = split_words(texts)
    if len(ids):
        chains = Chains(ids, raw, offsets)
        f, w = features(clean(raw)), model.weights
        parts = w[0][f].sum(axis=1), w[1][f[:, NEAR]].sum(axis=1), w[2][f[:, NEAR]].sum(axis=1)
        p, _ = chains.marginals(chains.unary(*parts, model.bias), model.moves)
    else:
        p = np.zeros(0)
    score = np.round(1 / (1 + np.exp(-np.clip(evidence(p, offsets) @ model.scale, -30, 30))), 6)
    spans: list[list[dict]] = [[] for _ in range(n)]
    hot = p >= 0.5
    for i in np.unique(np.searchsorted(offsets, np.flatnonzero(hot), "right") - 1):
        places = [m.span() for m in WORD.finditer(texts[i].as_py())]
        for t in range(offsets[i], offsets[i + 1]):
            if hot[t]:
                a, b = places[t - offsets[i]]
                if t > offsets[i] and hot[t - 1]:
                    spans[i][-1]["end"] = b
                else:
                    spans[i].append({"start": a, "end": b})
    return score, spans


def learnable() -> F.Column:
    """Rows that labels may be learnt from; the others are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 != 2


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = 1500, clean_docs: int = 2500, max_chars: int = 20_000) -> Model:
    """Train on a bounded sample of the labelled rows that are not held out, in one task; the model comes back."""

    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(learnable() & F.col("toxic").isNotNull())
    prior = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0]  # one number over all learnable labels

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        unique = list(dict.fromkeys((r["text"], r["toxic"]) for r in rows))  # copies teach nothing new
        model = train([t for t, _ in unique], np.array([y for _, y in unique], bool), prior)
        yield pa.record_batch({"model": pa.array([pickle.dumps(model)], pa.binary())})

    rows = sample(docs, labels, toxic_docs, clean_docs, max_chars).coalesce(1)
    found = rows.mapInArrow(work, "model binary").first()
    return pickle.loads(found[0]) if found else train([], np.zeros(0, bool))


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 3 MB, whatever the input

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, spans = judge(shared.value, batch.column("text"))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(found), "spans": pa.array(spans, SPANS)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(work, "doc_id long, score double, spans array<struct<start:int,end:int>>")
    held = F.coalesce(~learnable(), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; every column stays as it is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, _ = judge(shared.value, batch.column("text"))
            yield batch.filter(pa.array(found < THRESHOLD))

    return docs.mapInArrow(work, docs.schema)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
