import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from areatab.llm import toxicity as X
from areatab.llm.common import split_words


def test_marginals_equal_the_sum_over_all_taggings():
    rng = np.random.default_rng(1)
    texts = pa.array(["a b c d e", "f", "g h. i j k", "", "l m n o p q"])
    ids, words, offsets = split_words(texts)
    chains = X.Chains(ids, words, offsets)
    unary, moves = rng.normal(size=len(ids)), np.exp(rng.normal(size=(2, 2)))
    p, expected = chains.marginals(unary, moves, True)
    want, counts = np.zeros(len(ids)), np.zeros((2, 2))
    assert sorted(chains.length.tolist()) == [1, 2, 3, 5, 6]  # a sentence's end ends a chain
    for first, n in zip(chains.first, chains.length, strict=True):
        total = 0.0
        own, steps = np.zeros(n), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=int(n)):
            w = np.prod([np.exp(unary[first + k]) if t else 1.0 for k, t in enumerate(tags)])
            for a, b in itertools.pairwise(tags):
                w *= moves[a, b]
            total += w
            own += w * np.array(tags)
            for a, b in itertools.pairwise(tags):
                steps[a, b] += w
        want[first : first + n] = own / total
        counts += steps / total
    assert np.allclose(p, want) and np.allclose(expected, counts)


def test_long_chains_are_cut():
    ids, words, offsets = split_words(pa.array(["w " * 1300]))
    chains = X.Chains(ids, words, offsets)
    assert sorted(chains.length.tolist()) == [276, 512, 512]
    p, _ = chains.marginals(np.zeros(1300), np.ones((2, 2)))
    assert np.allclose(p, 0.5)


def corpus(n=700, seed=1):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("lo", "me", "ta", "ri", "so", "ne") for b in ("na", "pol", "ster", "vi", "chu", "tre", "mi")]
    bad = ["vilrot", "grubon", "vilrotter", "Grubons!"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "src"))
        if rng.random() < 0.8:
            labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int")
    return rows, dict(labels), X.fit(docs, marks)


def test_held_out_accuracy_and_offsets(spark, fitted):
    rows, labels, model = fitted
    found = X.score(spark.createDataFrame(rows, "doc_id long, text string, source string"), model).collect()
    assert len(found) == len(rows)
    texts = {i: t for i, t, _ in rows}
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert len(held) > 80
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.predicted:
            marked = [texts[r.doc_id][s.start : s.end] for s in r.spans]
            assert any("vilrot" in m or "rubon" in m for m in marked)


def test_held_out_labels_are_not_learnt_from(spark, fitted):
    rows, labels, _ = fitted
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels.items()]
    a, b = ([(r.text, r.toxic) for r in X.sample(docs, spark.createDataFrame(x, "doc_id long, toxic int"), 50, 100, 20_000).collect()] for x in (list(labels.items()), flipped))
    assert a == b and sum(t for _, t in a) == 50


def test_odd_rows(spark, fitted, odd, odd_rows, no_documents):
    _, _, model = fitted
    found = X.score(odd, model).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, *_ in odd_rows)
    assert all(0 <= r.score < 0.3 and r.predicted == 0 and r.held_out is not None for r in found)
    kept = X.reject(odd, model)
    assert kept.schema == odd.schema and kept.count() == len(odd_rows)
    assert X.score(no_documents, model).count() == X.reject(no_documents, model).count() == 0


def test_without_labels_nothing_is_toxic(spark, odd, odd_rows):
    for labels in ([], [(4, None), (None, 1), (99, 1)], [(4, 1), (5, 1)]):
        model = X.fit(odd, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r.score for r in X.score(odd, model).collect()} == {0.0}


def test_texts_are_not_judged_by_other_columns(spark, fitted):
    _, _, model = fitted
    frame = spark.createDataFrame([(i, "a vilrot grubon here", s) for i, s in ((1, "x"), (2, "y"), (1, "x"))], "doc_id long, text string, source string")
    assert len({r.score for r in X.score(frame, model).collect()}) == 1
