import random

import numpy as np
import pytest
import xxhash

from areatab.llm import simhash as S
from areatab.llm.common import components


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius=3):
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def planted(rng, n=250):
    """Values in clusters and chains around the radius, the sign bit included."""
    out = set()
    while len(out) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            out.add(v)
            for _ in range(rng.randint(1, 5)):
                v ^= 1 << rng.randrange(64)
    return sorted(out)


def test_fingerprint_is_the_majority_of_shingle_hashes():
    rng = random.Random(2)
    for _ in range(100):
        text = " ".join(rng.choice(["The", "a", "Ä", "fox,", "\tq", "\n"]) for _ in range(rng.randint(0, 12)))
        assert S.fingerprint(text.encode()) == brute_fingerprint(text)
    long = "word other third " * 40_000  # more shingles than are hashed at once
    assert S.fingerprint(long.encode()) == brute_fingerprint(long)


def test_any_two_values_within_the_radius_share_a_key():
    rng = random.Random(3)
    masks = S.key_masks()
    assert len(masks) == 20
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_sliced_links_equal_all_pairs():
    rng = random.Random(4)
    for radius in (0, 1, 2, 3):
        groups = [planted(rng, n) for n in (1, 3, 64, 65, 130)]
        values = np.array([v for g in groups for v in g], np.uint64)
        number = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        found = S.sliced_links(values, number, radius, chunk=200)
        at = 0
        for g in groups:
            assert (found[at : at + len(g)] - at).tolist() == brute_groups(g, radius)
            at += len(g)


def test_groups_equal_brute_force_also_when_keys_are_split(spark):
    values = planted(random.Random(5), 120)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    for rows in (S.BLOCK, 4):
        edges = S.link_forest(frame, 3, 6, rows)
        root = {r.node: r.root for r in components(edges, "a", "b").collect()}
        expected = brute_groups(values)
        mine = [root.get(v, v) for v in signed]
        pairs = {(mine[i], expected[i]) for i in range(len(values))}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 300)] + [(201, 200), (200, 201)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert len({found[i] for i in range(41)}) == len({found[i] for i in range(100, 160)}) == len({found[200], found[201]}) == 1
    assert len(set(found.values())) == 3 and 300 not in found


def test_odd_rows(odd, odd_rows, no_documents):
    found = S.near_duplicates(odd).select("doc_id", "fp", "component_id").collect()
    assert sorted(str((r.doc_id, r.fp % (1 << 64))) for r in found) == sorted(str((i, brute_fingerprint(t))) for i, t, _ in odd_rows)
    by_fp = {}
    for r in found:
        by_fp.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(x) == 1 for x in by_fp.values())
    assert {r.component_id for r in found if r.fp == 0} == {1}  # null, empty and blank texts
    assert S.near_duplicates(no_documents).count() == 0


def test_one_row_of_each_group_stays(odd, no_documents):
    kept = S.deduplicate(odd)
    assert kept.schema == odd.schema
    texts = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert [t[:2] for t in texts] == [(False, 0), (True, 1), (True, 4), (True, 5), (True, 6), (True, 7), (True, 7)]
    assert S.deduplicate(no_documents).count() == 0


def test_reused_ids_are_told_apart_by_row(documents):
    one, two = "the quick brown fox jumps over the lazy dog again", "something else that is not like it at all here"
    kept = S.deduplicate(documents([(1, one, "a"), (1, two, "b"), (0, two, "c")]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, two), (1, one)]


@pytest.mark.parametrize("seed", range(4))
def test_kept_rows_equal_brute_force_with_reused_and_null_ids(documents, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(rng.randint(0, 30))) for _ in range(12)]
    rows = [(rng.choice([None, 0, 1, 2, 3, *range(10, 40)]), rng.choice(texts), "s") for _ in range(60)]
    groups = {}
    for i, t, _ in rows:  # the texts are far apart or equal: a group is a fingerprint
        groups.setdefault(brute_fingerprint(t), set()).add(i)
    marks = sorted(groups)
    label = brute_groups(marks)
    of = dict(zip(marks, label, strict=True))
    least = {}
    for fp, ids in groups.items():
        known = {i for i in ids if i is not None}
        mine = min(known) if known else None
        old = least.get(of[fp], "none")
        least[of[fp]] = mine if old == "none" or old is None else old if mine is None else min(old, mine)
    kept = [(r.doc_id, r.text) for r in S.deduplicate(documents(rows)).collect()]
    assert len(kept) == len(least)
    assert {of[brute_fingerprint(t)]: i for i, t in kept} == least
    assert all((i, t) in {(a, b) for a, b, _ in rows} for i, t in kept)


def test_hex_digits(spark):
    found = spark.createDataFrame([(0,), (-1,), (255,)], "fp long").select(S.hex_digits("fp").alias("x")).collect()
    assert [r.x for r in found] == ["0" * 16, "f" * 16, "00000000000000ff"]
