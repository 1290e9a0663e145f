import hashlib
import math

import numpy as np
import pytest

from areatab.llm import dualtree


def brute(rows, rounds=6):
    """Every part against every entry, in Python integers. rows: (vec_id, embedding, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(next(r for r in kept if len(r[1]) and len(r[1]) % 8 == 0)[1])
    kept = [r for r in kept if len(r[1]) == size]
    w = size // 8
    ints = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    books = [[v[p * w : (p + 1) * w] for v in ints[:16]] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            own = {}
            for v in ints:
                own.setdefault(near(v[p * w : (p + 1) * w], books[p])[1], []).append(v[p * w : (p + 1) * w])
            books[p] = [[sum(x) // len(x) for x in zip(*own[e], strict=True)] if e in own else c for e, c in enumerate(books[p])]
    found = [[near(v[p * w : (p + 1) * w], books[p]) for p in range(8)] for v in ints]
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for r, e in zip(kept, errors, strict=True):
        by[r[2]] = by.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(r[0], "".join(f"{k:02x}" for _, k in f), e, by[r[2]], digest) for r, f, e in zip(kept, found, errors, strict=True)], key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, x double"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, "clash", 7, 0.5) for r in rows], schema)


def rows_of(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def vectors(rng, n, size=16, kinds=None):
    x = rng.normal(0, 0.2, (n, size)).astype(np.float32)
    if kinds:
        x = x[rng.integers(0, kinds, n)]
    return [(int(i), [float(v) for v in row], int(rng.integers(0, 3)) if rng.random() < 0.8 else None) for i, row in zip(rng.permutation(n), x, strict=True)]


@pytest.mark.parametrize(("n", "kinds"), [(3, None), (700, None), (700, 12), (300, 1)])
def test_codes_against_every_entry(spark, n, kinds):
    rows = vectors(np.random.default_rng(n), n, kinds=kinds)
    assert rows_of(dualtree.compress(table(spark, rows).repartition(3))) == brute(rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(8)
    rows = vectors(rng, 60, 8)
    rows += [(100, None, 1), (101, [0.1] * 7 + [None], 1), (102, [0.1] * 7 + [float("nan")], None), (103, [float("inf")] + [0.0] * 7, 2), (104, [], 1), (105, [0.5] * 16, 1)]
    rows += [rows[0], rows[0], (None, [0.25, -0.25] * 4, None), (rows[1][0], [-1.0] * 8, 1)]
    want = brute(rows)
    assert rows_of(dualtree.compress(table(spark, rows))) == want and len(want) == 64
    huge = [*rows, (200, [1e30] * 8, 1)]  # its error fits no long
    assert rows_of(dualtree.compress(table(spark, huge))) == want
    assert rows_of(dualtree.compress(table(spark, []))) == []
    assert rows_of(dualtree.compress(table(spark, [(1, None, 1), (2, [1.0], 1)]))) == []


def test_ties_go_to_the_lower_index():
    book = np.array([[4, 0], [0, 0], [0, 0], [2, 2], [4, 0]])
    rows = np.array([[2, 0], [0, 0], [4, 0], [2, 1], [1, 1]] * 40)
    entry, distance = dualtree.codes(dualtree.build(rows), rows, book)
    full = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
    assert entry.tolist() == full.argmin(axis=1).tolist() and distance.tolist() == full.min(axis=1).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_walk_settles_whole_nodes_and_gathers_the_same_sums(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-9000, 9000, (16, 4))
    rows = centres[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 4))
    tree = dualtree.build(rows)
    settled, (leaves, _) = dualtree.walk(tree, dualtree.entry_tree(centres))
    whole = sum(int(np.diff(dualtree.cuts(3000, level))[nodes].sum()) for level, nodes, _ in settled)
    assert whole + np.diff(dualtree.cuts(3000, tree.depth))[np.unique(leaves)].sum() == 3000 and whole > 1500
    n, s = dualtree.gathered(tree, rows, centres)
    near = ((rows[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert n.tolist() == np.bincount(near, minlength=16).tolist()
    assert s.tolist() == [rows[near == e].sum(axis=0).tolist() for e in range(16)]


def test_query_over_the_whole_table(spark):
    from areatab.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows_of(QUERIES["op11_dual_tree_codes"](spark, sf)) == brute(rows)


def test_sql_gives_the_same(spark):
    import duckdb

    from areatab.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{sf}/embeddings.parquet'")
    found = con.execute(ORACLE_SQL["op11_dual_tree_codes"])
    names = [c[0] for c in found.description]
    want = QUERIES["op11_dual_tree_codes"](spark, sf)
    assert sorted(names) == sorted(want.columns)
    assert sorted(found.fetchall(), key=repr) == sorted(map(tuple, want.select(*names).collect()), key=repr)
