import random
from collections import defaultdict

import pytest

from areatab.llm import packing as P


def brute_best_fit(pieces, capacity):
    """Every open bin is looked at for every piece."""
    bins, out = [], [None] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda i: -pieces[i][0]):
        length, source, cluster = pieces[i]
        fits = [
            b for b in bins
            if b["room"] >= length and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])
        ]
        if fits:
            best = min(b["room"] for b in fits)
            # of equally tight bins the one that has had this residual longest
            chosen = min((b for b in fits if b["room"] == best), key=lambda b: b["since"])
        else:
            chosen = {"room": capacity, "sources": set(), "clusters": set(), "n": 0, "id": len(bins)}
            bins.append(chosen)
        out[i] = (chosen["id"], chosen["n"])
        chosen["n"] += 1
        chosen["room"] -= length
        chosen["sources"].add(source)
        chosen["clusters"].add(cluster)
        chosen["since"] = sum(b["n"] for b in bins)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_equals_a_search_of_all_bins(seed):
    rng = random.Random(seed)
    pieces = [
        (rng.randint(1, 50), rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice([None, *range(15)])) for _ in range(rng.randint(0, 150))
    ]
    assert P.best_fit(pieces, 50) == brute_best_fit(pieces, 50)


def check(rows, items, capacity):
    bins, whole = defaultdict(list), defaultdict(list)
    for r in rows:
        whole[r.doc_id, r.source].append((r.start, r.n_words))
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
        else:
            assert r.n_words == 0
    for part in bins.values():
        assert sum(r.n_words for r in part) <= capacity
        assert sorted(r.place for r in part) == list(range(len(part)))
        for column in ("source", "cluster"):
            held = [getattr(r, column) for r in part if getattr(r, column) is not None]
            assert len(held) == len(set(held))
    for i, n, s, _ in items:
        assert sum(k for _, k in whole[i, s]) == n * sum(1 for x in items if x[0] == i and x[2] == s)


def test_nothing_is_lost_and_nothing_conflicts(spark):
    rng = random.Random(1)
    items = [(i, rng.choice([0, 1, 40, 100, 101, 250, rng.randint(1, 99)]), "hot" if i % 3 == 0 else f"s{i % 7}", rng.choice([None, i % 11])) for i in range(400)]
    items += [(5000, 12_345, None, 3), (None, 30, None, None), (5001, 64, "s1", 1)]
    frame = spark.createDataFrame(items, "doc_id long, n_words long, source string, cluster long")
    for shard_rows in (10_000, 50):
        check(P.pack(frame, 100, shard_rows).collect(), items, 100)
    one = spark.createDataFrame([(7, 64, "s1", 1), (7, 64, "s1", 1)], frame.schema)
    assert len({r.bin_id for r in P.pack(one, 200).collect()}) == 2  # copies stay apart
    assert P.pack(frame.limit(0), 100).count() == 0
    with pytest.raises(ValueError):
        P.pack(frame, 0)


def test_measures_whole_texts(odd, odd_rows):
    found = P.measured(odd).collect()
    want = sorted((str(i), len((t or "").encode().split())) for i, t, _ in odd_rows)
    assert sorted((str(r.doc_id), r.n_words) for r in found) == want
    copies = {r.cluster for r in found if r.doc_id == 4}
    assert len(copies) == 1 and None not in copies
    assert all(r.cluster is None for r in found if r.n_words == 0)
