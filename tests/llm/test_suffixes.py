import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from areatab.llm import phrases as P
from areatab.llm import suffixes as S
from areatab.llm.contexts import contexts, sliding_min


def brute(rows, length=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@given(st.lists(st.integers(0, 3), max_size=60) | st.lists(st.integers(), max_size=30))
@settings(max_examples=300, deadline=None)
def test_suffix_array_is_the_sorted_order(text):
    assert S.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_long_runs():
    assert S.suffix_array([5] * 20_000) == list(range(19_999, -1, -1))
    text = [1, 2] * 500
    assert S.suffix_array(text) == sorted(range(1000), key=lambda i: text[i:])


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 50, 97)
    for width in (1, 2, 7, 96, 97):
        assert sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(97 - width + 1)]


@pytest.mark.parametrize("piece", [1 << 23, 700])
def test_contexts_hold_every_window_once(monkeypatch, piece):
    monkeypatch.setattr("areatab.llm.contexts.PIECE", piece)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 4, n, dtype=np.uint8) for n in (0, 3, 400, 399, 1900, 401, 900, 2)]
    offsets = np.cumsum([0, *map(len, texts)])
    c = contexts(np.concatenate(texts), offsets, 400, 16)
    windows = sorted((int(t), w) for t, a, b in zip(c.text, c.first, c.last, strict=True) for w in range(a, b + 1))
    assert windows == [(i, w) for i, t in enumerate(texts) for w in range(len(t) - 399)]
    assert ((c.place >= c.last) & (c.place + 16 <= c.first + 400)).all()


def passages(rng, n=60):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    words = lambda k: " ".join(word() for _ in range(rng.randint(0, k)))
    bases = [" ".join(word() for _ in range(300)) for _ in range(4)]
    out = []
    for i in range(n):
        base = rng.choice(bases)
        a = rng.randrange(len(base))
        part = base[a : a + rng.randint(380, 800)]
        if rng.random() < 0.4 and part:
            k = rng.randrange(len(part))
            part = part[:k] + "#" + part[k + 1 :]
        out.append((i, words(60) + part + words(60)))
    return [*out, out[3], (n, out[5][1] * 3)]


@pytest.mark.parametrize("part", [1024, 2])
def test_removed_bytes_equal_brute_force(documents, odd_rows, monkeypatch, part):
    monkeypatch.setattr(S, "PART", part)
    rows = passages(random.Random(7)) + [(i, t) for i, t, _ in odd_rows if len(t or "") < 10_000]
    rows += [(900, "x" * 399), (901, "y" * 400), (902, "z" * 401)]
    found = S.repeated_bytes(documents([(i, t, None) for i, t in rows]))
    assert sorted((tuple(r[:5]) for r in found.collect()), key=str) == brute(rows)


def test_no_array_grows_with_a_hot_passage(documents, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "PART", 8)
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    plain, log = S.windows_that_recur, tmp_path / "sizes"
    log.mkdir()

    def logged(pieces, anchors):
        (log / f"{len(pieces)}-{random.random()}").touch()
        return plain(pieces, anchors)

    monkeypatch.setattr(S, "windows_that_recur", logged)
    rng = random.Random(11)
    words = lambda k: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(k))
    passage = words(120)
    rows = [(i, words(rng.randint(1, 60)) + passage + words(rng.randint(1, 60)), None) for i in range(150)]
    # pairs that share what stands before the passage too, so that parts hold strings the others have once
    rows += [(200 + i, rows[i][1][:-40] + words(9), None) for i in range(30)]
    found = S.repeated_bytes(documents([*rows, rows[0], rows[0]]))
    assert sorted((tuple(r[:5]) for r in found.collect()), key=str) == brute([r[:2] for r in [*rows, rows[0], rows[0]]])
    # 180 texts share anchors at the passage's edges
    assert max([int(x.name.split("-")[0]) for x in log.iterdir()], default=0) < 90


def test_first_of_equal_windows_stands_for_them():
    passage, rng = bytes(range(256)) * 2, random.Random(4)
    pieces = [rng.randbytes(9) + passage + rng.randbytes(9) for _ in range(5)]
    found, later = S.windows_that_recur(pieces, [200] * 5)
    assert all(f.tolist() == list(range(9, 122)) for f in found)
    assert later[0].tolist() == [] and all(x.tolist() == list(range(9, 122)) for x in later[1:])


def test_stretches_hold_every_window_once():
    for at, first, last, step in ((300, 0, 272, 64), (130, 3, 130, 8), (5, 5, 5, 1), (77, 0, 76, 64)):
        cut = list(S.stretches(first, last, at, step))
        assert sorted(w for a, b, *_ in cut for w in range(a, b + 1)) == list(range(first, last + 1))
        assert all(low <= a <= b <= high and high - low + 1 == step and (at - high) % step == 0 for a, b, low, high in cut)


def test_kept_bytes_and_spans(documents, no_documents):
    text = "é" * 300 + "tail"
    found = S.repeated_bytes(documents([(1, text, None), (2, "head" + "é" * 300, None)])).collect()
    assert {r.doc_id: bytes(r.kept) for r in found} == {1: b"tail", 2: b"head"}
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in found} == {1: [(0, 600)], 2: [(4, 604)]}
    assert S.repeated_bytes(no_documents).count() == 0


def test_a_passage_of_over_50_words_goes_only_where_it_has_400_bytes(documents):
    rng = random.Random(13)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    short, long = words(59), words(90)
    rows = [(i, f"{words(80)} {p} {words(80)}") for i, p in enumerate([short, short, long, long, words(59)])]
    docs = documents([(*r, None) for r in rows])
    found = S.repeated_bytes(docs).collect()
    assert sorted(tuple(r[:5]) for r in found) == brute(rows)
    # 59 words of 5 letters are 353 bytes: op9's 35 words recur there, no 400 bytes do
    gone = {r.doc_id: r.n_removed for r in found}
    assert gone[0] == gone[1] == gone[4] == 0 and gone[2] == gone[3] >= len(long)
    assert {r.doc_id: r.n_removed > 0 for r in P.repeated_words(docs).collect()} == {0: True, 1: True, 2: True, 3: True, 4: False}
