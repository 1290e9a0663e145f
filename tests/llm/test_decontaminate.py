import random
from itertools import combinations

import numpy as np
import pytest

from areatab.llm import decontaminate as D


def hit(masks, n, differ):
    return any(all(p + k not in differ for k, c in enumerate(m) if c == "1") for m in masks for p in range(n - len(m) + 1))


def test_the_masks_miss_no_overlap_of_15_words_with_3_differences():
    for differ in combinations(range(15), 3):
        assert hit(D.MASKS, 15, differ), differ


def test_the_masks_miss_no_overlap_of_the_rule():
    # every placement: a fifth of the words may differ. Longer stretches fall into parts of 15 to 29 words, and what
    # spoils the stretch spoils each of its parts
    for n in range(15, 30):
        assert D.least_to_spoil(D.MASKS, n) * 5 > n, n


def test_least_to_spoil_against_every_placement():
    for masks, n in ((D.MASKS[:1], 12), (D.MASKS[1:3], 15), (D.MASKS[:3], 20), (D.MASKS, 18)):
        least = D.least_to_spoil(masks, n)
        assert not all(hit(masks, n, c) for c in combinations(range(n), least))
        assert all(hit(masks, n, c) for c in combinations(range(n), least - 1))


def test_twenty_words_with_four_differences(spark, documents):
    item = [f"w{k}" for k in range(20)]
    text = " ".join("x" if k in (6, 7, 9, 13) else w for k, w in enumerate(item))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = D.overlaps(documents([(1, text, None)]), bench).collect()
    assert [tuple(r) for r in found] == [(1, 1, 0, 0, 20, 16, 0.8)]


def test_repeated_items_are_rows_but_searched_once(spark, documents):
    item = "one, two; three (four)" * 30
    bench = spark.createDataFrame([(1, item)] * 5 + [(2, item)], "item_id long, text string")
    assert [t.value.rows for t in D.blocks(bench)] == [[5, 1]]
    assert len(list(D.blocks(bench, 30))) == 9  # punctuation parts words there too
    assert sorted(r.item_id for r in D.overlaps(documents([(1, item, None)]), bench).collect()) == [1] * 5 + [2]


@pytest.mark.parametrize("seed", range(40))
def test_longest_stretch(seed):
    rng = np.random.default_rng(seed)
    same = rng.random(rng.integers(0, 40)) < rng.choice([0.3, 0.6, 0.8, 0.95])
    best = max((b - a for a in range(len(same)) for b in range(a + 1, len(same) + 1) if same[a] and same[b - 1] and same[a:b].sum() * 10 >= 8 * (b - a)), default=0)
    start, size = D.longest(same, 0.8)
    assert size == best
    if size:
        assert same[start] and same[start + size - 1] and same[start : start + size].mean() >= 0.8


def words_of(text):
    return "".join(" " if c in D.string.punctuation else c for c in (text or "").lower()).encode().split()


def brute(rows, items):
    """Every item along every diagonal of every document."""
    found = set()
    for d, text in rows:
        w = words_of(text)
        for i, item in items:
            v = words_of(item)
            least, share = (15, 0.8) if len(v) >= 15 else (len(v), 1.0)
            for shift in range(-len(v) + 1, len(w)) if v else ():
                lo, hi = max(0, -shift), min(len(v), len(w) - shift)
                if hi - lo < least:
                    continue
                same = np.array([w[shift + k] == v[k] for k in range(lo, hi)])
                if same.sum() >= 0.8 * least and D.longest(same, share)[1] >= least:
                    found.add((d, i))
                    break
    return found


def tables(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of a in red fox dog runs over hill Ähre maß".split()) + rng.choice(["", "", str(rng.randint(0, 60))])
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([0, 1, 4, 14, 15, 16, 22, 30, 60])]
    items += [(100, items[7][1]), (101, None), (102, "...!")]
    rows = [(1, None), (2, ""), (None, items[6][1])]
    for d in range(3, 90):
        passage = rng.choice(items[3:9])[1].split()
        a = rng.randrange(max(1, len(passage) - 14))
        passage = passage[a : a + rng.randint(10, 40)]
        for _ in range(rng.randint(0, 6)):
            passage[rng.randrange(len(passage))] = "changed"
        rows.append((d, " ".join([word() for _ in range(rng.randint(0, 20))] + [w.upper() + rng.choice(["", ",", "!!"]) for w in passage] + [word() for _ in range(9)])))
    return rows, items


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_overlaps_equal_brute_force(spark, documents, block_words):
    rows, items = tables(3)
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    docs = documents([(d, t, None) for d, t in rows])
    found = D.overlaps(docs, bench, block_words)
    want = brute(rows, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    assert len(want) > 30
    kept = D.remove(docs, bench, block_words)
    assert kept.schema == docs.schema
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d) for d, _ in rows if d not in {x for x, _ in want})


def test_rows_of_an_overlap(spark, documents):
    item = " ".join(f"w{k}" for k in range(20))
    text = "a b c " + item.replace("w7", "other") + " d"
    docs = documents([(1, text, None), (1, text, None), (2, "clean text", None)])
    found = D.overlaps(docs, spark.createDataFrame([("x", item)], "item_id string, text string")).collect()
    assert [tuple(r) for r in found] == [(1, "x", 3, 0, 20, 19, 0.95)] * 2


def test_odd_and_empty_tables(spark, odd, odd_rows, no_documents):
    bench = spark.createDataFrame([(1, "some words that stand nowhere else " * 4)], "item_id long, text string")
    assert D.remove(odd, bench).count() == len(odd_rows)
    assert D.overlaps(odd, bench.limit(0)).count() == 0 and D.remove(odd, bench.limit(0)).count() == len(odd_rows)
    assert D.overlaps(no_documents, bench).count() == D.remove(no_documents, bench).count() == 0
    same = spark.createDataFrame([(1, "a b " * 10)], "item_id long, text string")
    assert {r.doc_id for r in D.overlaps(odd, same).collect()} == {6}
