"""Vector codes by product quantisation, trained with a dual-tree Lloyd iteration in integers.

Vectors become integers, floor(4096 x), and are cut into 8 equal parts; each
part position has a codebook of 16 entries. Vectors stand in blocks, and every
block has a tree over the parts of each position: halves of equal size along the
widest side, down to small leaves, with each node's box, the sum of its parts
and their number. A round puts a tree over the entries of a codebook beside it
and walks both together: of a node of parts and a node of entries the least and
the largest distance of their boxes are known, and a combination goes whose
least distance is above the least largest one. A node of parts with one entry
left goes to it whole, by its cached sum; in leaves that stay uncertain integer
distances decide. Bounds are integers too and a combination goes only if it is
strictly farther, so ties keep both sides and the lower index wins in the leaf.

Only sums and counts for each entry leave the tasks, and only they and the
codebooks (parts x entries x components integers) come to the driver.

Defined cases: vectors that are null, or hold a null or non-finite component,
are dropped, and so are those whose length isn't that of the smallest kept
vec_id's vector or no positive multiple of 8, and those with a component so
large (over about 32,000 for 64 components) that an error may not fit a long. Of equal
vec_ids the order is that of their vectors; null vec_ids come last and are kept;
repeated rows each count. With fewer than 16 kept vectors the codebooks have so
many entries. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import meet, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors in a block, and parts in a leaf at least.
BLOCK = 4096
LEAF = 16


@dataclass
class Tree:
    """A binary tree over rows of integers: nodes of each level one after the other, all leaves on the last level."""

    order: np.ndarray  # rows as the leaves have them
    depth: int
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @property
    def n(self) -> int:
        return len(self.order)


def cuts(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin among n rows, and the end."""
    at = np.array([0, n])
    for _ in range(level):
        at = np.sort(np.r_[at, (at[1:] + at[:-1]) // 2])
    return at


def build(rows: np.ndarray, leaf: int = LEAF) -> Tree:
    """Halves along each node's widest side, down to leaves of ``leaf`` to 2 * ``leaf`` rows."""
    n = len(rows)
    depth = max(0, int(math.log2(max(1, n) / leaf))) if n else 0
    order = np.arange(n)
    low, high, sums = [], [], []
    for level in range(depth + 1):
        at = cuts(n, level)
        x = rows[order]
        low.append(np.minimum.reduceat(x, at[:-1]))
        high.append(np.maximum.reduceat(x, at[:-1]))
        sums.append(np.add.reduceat(x, at[:-1]))
        if level < depth:
            node = np.repeat(np.arange(len(at) - 1), np.diff(at))
            side = (high[-1] - low[-1]).argmax(axis=1)[node]
            order = order[np.lexsort((x[np.arange(n), side], node))]
    return Tree(order, depth, *(np.concatenate(v) for v in (low, high, sums)))


@dataclass
class EntryTree:
    """A tree over a codebook's distinct entries; a leaf holds one of them."""

    low: np.ndarray
    high: np.ndarray
    below: np.ndarray  # two children of each node, -1 for leaves
    entry: np.ndarray


def entry_tree(entries: np.ndarray) -> EntryTree:
    """Equal entries: the one of least index stands for all, it wins every tie."""
    _, first = np.unique(entries, axis=0, return_index=True)
    low, high, below, entry = [], [], [], []

    def add(own: np.ndarray) -> int:
        me = len(low)
        x = entries[own]
        low.append(x.min(axis=0))
        high.append(x.max(axis=0))
        below.append([-1, -1])
        entry.append(own[0] if len(own) == 1 else -1)
        if len(own) > 1:
            own = own[np.argsort(x[:, (high[me] - low[me]).argmax()], kind="stable")]
            below[me] = [add(own[: len(own) // 2]), add(own[len(own) // 2 :])]
        return me

    add(np.sort(first))
    return EntryTree(np.array(low), np.array(high), np.array(below), np.array(entry))


def walk(tree: Tree, entries: EntryTree) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """Both trees from their roots on: nodes of parts that one entry takes whole, by level (level, nodes, entries),
    and what stays uncertain (leaves, entries)."""
    settled = []
    part, mate, level = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    while True:
        own = part + (1 << level) - 1
        apart = np.maximum(np.maximum(entries.low[mate] - tree.high[own], tree.low[own] - entries.high[mate]), 0)
        far = np.maximum(np.abs(tree.high[own] - entries.low[mate]), np.abs(entries.high[mate] - tree.low[own]))
        least, most = (apart * apart).sum(axis=1), (far * far).sum(axis=1)
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        size = np.diff(np.r_[first, len(part)])
        near = np.repeat(np.minimum.reduceat(most, first), size)
        keep = least <= near
        part, mate = part[keep], mate[keep]
        alone = np.bincount(part, minlength=1 << level)[part] == 1
        leaf = entries.entry[mate] >= 0
        done = alone & leaf
        if done.any():
            settled.append((level, part[done], entries.entry[mate[done]]))
            part, mate, leaf = part[~done], mate[~done], leaf[~done]
        if not len(part) or (level == tree.depth and leaf.all()):
            return settled, (part, entries.entry[mate])
        # both go down a level where they can
        times = np.where(leaf, 1, 2)
        at = np.repeat(np.arange(len(part)), times)
        second = np.r_[False, at[1:] == at[:-1]].astype(np.int64)
        part, mate = part[at], np.where(leaf[at], mate[at], entries.below[mate[at], second])
        if level < tree.depth:
            part, mate = np.r_[2 * part, 2 * part + 1], np.r_[mate, mate]
            by = np.argsort(part, kind="stable")
            part, mate, level = part[by], mate[by], level + 1


def nearest(tree: Tree, rows: np.ndarray, codebook: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """(settled nodes, rows of uncertain leaves, their entries)."""
    settled, (leaves, mates) = walk(tree, entry_tree(codebook))
    if not len(leaves):
        return settled, np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = cuts(tree.n, tree.depth)
    by = np.lexsort((mates, leaves))
    leaves, mates = leaves[by], mates[by]
    size = at[leaves + 1] - at[leaves]
    place = np.repeat(at[leaves] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    mates = np.repeat(mates, size)
    gap = rows[tree.order[place]] - codebook[mates]
    distance = (gap * gap).sum(axis=1)
    by = np.lexsort((mates, distance, place))  # of equal distances the lower index
    first = by[np.r_[True, np.diff(place[by]) > 0]]
    return settled, tree.order[place[first]], mates[first]


def gathered(tree: Tree, rows: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum) of the rows that each entry is nearest to."""
    count, total = np.zeros(len(codebook), np.int64), np.zeros(codebook.shape, np.int64)
    settled, own, entry = nearest(tree, rows, codebook)
    for level, nodes, entries in settled:
        np.add.at(count, entries, np.diff(cuts(tree.n, level))[nodes])
        np.add.at(total, entries, tree.sums[nodes + (1 << level) - 1])
    np.add.at(count, entry, 1)
    np.add.at(total, entry, rows[own])
    return count, total


def codes(tree: Tree, rows: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row."""
    out = np.empty(len(rows), np.int64)
    settled, own, entry = nearest(tree, rows, codebook)
    for level, nodes, entries in settled:
        at = cuts(tree.n, level)
        for node, e in zip(nodes.tolist(), entries.tolist(), strict=True):
            out[tree.order[at[node] : at[node + 1]]] = e
    out[own] = entry
    gap = rows - codebook[out]
    return out, (gap * gap).sum(axis=1)


# --- over tables


def limit(size: int) -> int:
    """Integers up to which the squared distances of two vectors of ``size`` components fit a long."""
    return math.isqrt(((1 << 63) - 1) // (4 * max(1, size)))


def whole_numbers(x: Column) -> Column:
    return F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))


def _kept(vectors: DataFrame, column: str) -> DataFrame:
    """(vec_id, label, v): vectors without null and non-finite components, as they are."""
    rows = vectors.select("vec_id", "label", F.col(column).alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def first_codebooks(kept: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray:
    """(part, entry, component): the parts of the smallest kept vec_ids' vectors."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    fitting = kept.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    head = fitting.orderBy(*order).limit(1).collect()
    if not head:
        return np.zeros((parts, 0, 0), np.int64)
    size = len(head[0]["v"])
    rows = usable(kept, size).orderBy(*order).limit(entries).select(whole_numbers(F.col("v")).alias("v")).collect()
    x = np.array([r["v"] for r in rows], np.int64).reshape(len(rows), parts, size // parts)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def usable(kept: DataFrame, size: int) -> DataFrame:
    most = limit(size) / SCALE
    return kept.where((F.size("v") == size) & F.forall("v", lambda x: F.abs(x) < most))


def blocks_of(rows: DataFrame, label_type: str, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """Blocks of vectors with a tree over each part position; ``rows`` have (vec_id, label, v) with whole numbers."""
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, block):
                own = batch.slice(k, block)
                v = own.column("v")
                x = v.flatten().to_numpy().reshape(len(own), parts, -1)
                trees = [build(x[:, p]) for p in range(parts)]
                binary = {"x": x.astype("<i8")} | {c: np.concatenate([getattr(t, c).ravel() for t in trees]).astype("<i8") for c in ("order", "low", "high", "sums")}
                columns = [pa.array([own.column(c)[i].as_py() for i in range(len(own))], own.column(c).type) for c in ("vec_id", "label")]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), c) for c in columns]
                yield pa.RecordBatch.from_arrays([*lists, *(pa.array([b.tobytes()], pa.binary()) for b in binary.values())], ["vec_id", "label", *binary])

    fields = f"vec_id array<{id_type}>, label array<{label_type}>, x binary, `order` binary, low binary, high binary, sums binary"
    return rows.select("vec_id", "label", "v").mapInArrow(work, fields)


TREES = ["x", "order", "low", "high", "sums"]


def trees_of(batch: pa.RecordBatch, i: int, parts: int, width: int) -> Iterator[tuple[Tree, np.ndarray]]:
    """(tree, rows) of each part position of a block."""
    raw = {c: np.frombuffer(batch.column(c)[i].as_buffer(), "<i8") for c in TREES}
    x = raw["x"].reshape(-1, parts, width)
    order = raw["order"].reshape(parts, -1)
    nodes = {c: raw[c].reshape(parts, -1, width) for c in ("low", "high", "sums")}
    depth = nodes["low"].shape[1].bit_length() - 1
    for p in range(parts):
        yield Tree(order[p], depth, *(nodes[c][p] for c in ("low", "high", "sums"))), np.ascontiguousarray(x[:, p])


def better(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all blocks."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for p, (tree, rows) in enumerate(trees_of(batch, i, parts, width)):
                    n, s = gathered(tree, rows, books[p])
                    count[p] += n
                    total[p] += s
        used = np.flatnonzero(count.ravel())
        where = np.repeat(used, width)
        columns = [where, np.tile(np.arange(width), len(used)), np.repeat(count.ravel()[used], width), total.reshape(-1, width)[used].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["entry", "place", "n", "s"])

    sums = blocks.select(*TREES).mapInArrow(work, "entry long, place long, n long, s long").groupBy("entry", "place")
    out = books.copy().reshape(-1, width)
    for r in sums.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # parts x entries x width rows
        out[r.entry, r.place] = int(r.s) // r.n
    return out.reshape(books.shape)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def train(vectors: DataFrame, column: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS) -> tuple[np.ndarray, DataFrame]:
    """(codebooks, blocks): after ``rounds`` rounds over all kept vectors, and the written blocks."""
    kept = _kept(vectors, column)
    books = first_codebooks(kept, entries, parts)
    label_type = vectors.schema["label"].dataType.simpleString()
    rows = usable(kept, books.shape[0] * books.shape[2]).select("vec_id", "label", whole_numbers(F.col("v")).alias("v"))
    blocks = written(blocks_of(rows, label_type, parts), "codes-blocks")
    for _ in range(rounds if books.size else 0):
        books = better(blocks, books)
    return books, blocks


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector in the blocks."""
    parts, _, width = books.shape
    types = {c: blocks.schema[c].dataType.elementType.simpleString() for c in ("vec_id", "label")}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = [codes(tree, rows, books[p]) for p, (tree, rows) in enumerate(trees_of(batch, i, parts, width))]
                code = [bytes(c).hex() for c in np.column_stack([e for e, _ in found]).astype(np.uint8)]
                own = [batch.column(c).slice(i, 1).flatten() for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(code, pa.string()), pa.array(sum(d for _, d in found), pa.int64())], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(work, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def compress(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every kept vector."""
    books, blocks = train(vectors, column)
    found = written(encode(blocks, books), "codes-found")
    by_label = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = meet(found, by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(entries: int = ENTRIES, rounds: int = ROUNDS, parts: int = PARTS) -> str:
    """The same rows in DuckDB SQL: every part against every entry, round by round."""
    near = """near{k} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT r, x.p, e, sum((x.x - c) * (x.x - c)) AS d FROM x JOIN book{k} b ON x.p = b.p AND x.i = b.i GROUP BY r, x.p, e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""
    book = """book{n} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, CAST(coalesce((s - ((s % n + n) % n)) // n, c) AS BIGINT) AS c FROM book{k} b LEFT JOIN (
    SELECT x.p, e, i, sum(x) AS s, count(*) AS n FROM x JOIN near{k} a ON x.r = a.r AND x.p = a.p GROUP BY x.p, e, i) m
  ON b.p = m.p AND b.e = m.e AND b.i = m.i)"""
    steps = [s for k in range(rounds) for s in (near.format(k=k), book.format(k=k, n=k + 1))] + [near.format(k=rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding AS v, len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda y: coalesce(isfinite(y), false)), false)),
x AS MATERIALIZED (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS i, CAST(floor({SCALE} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, v, w, unnest(range(1, len(v) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, x AS c FROM x WHERE r <= {entries}),
{", ".join(steps)},
code AS (
  SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
hash AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN code ON kept.r = code.r, hash
"""
