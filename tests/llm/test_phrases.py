import hashlib
import random
from collections import Counter

from areatab.llm import phrases as P


def brute(rows, length=35):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(t[k : k + length]) for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[tuple(t[k : k + length])] > 1:
                gone[k : k + length] = b"\1" * length
        kept = b" ".join(w for w, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(rng, n=80):
    word = lambda: "".join(rng.choice("abé.,") for _ in range(rng.randint(1, 7)))
    bases = [[word() for _ in range(150)] for _ in range(4)]
    out = []
    for i in range(n):
        base = rng.choice(bases)
        a = rng.randrange(len(base))
        part = base[a : a + rng.randint(30, 80)]
        if rng.random() < 0.4 and part:
            part[rng.randrange(len(part))] = "#"
        own = [[word() for _ in range(rng.randint(0, 50))] for _ in range(2)]
        out.append((i, rng.choice([" ", "\n", " \t"]).join([*own[0], *part, *own[1]])))
    return [*out, out[3], (n, (out[5][1] + " ") * 3)]


def test_removed_words_equal_brute_force(documents, odd_rows):
    rows = passages(random.Random(8)) + [(i, t) for i, t, _ in odd_rows if len(t or "") < 10_000]
    rows += [(900, "q " * 34), (901, "r " * 35), (902, "s " * 36), (903, "no-break space " * 40)]
    found = P.repeated_words(documents([(i, t, None) for i, t in rows]))
    assert sorted((tuple(r[:4]) for r in found.collect()), key=str) == brute(rows)


def test_long_text_and_empty_table(documents, no_documents):
    found = P.repeated_words(documents([(1, "a b " * 30_000, None)])).collect()
    assert (found[0].n_words, found[0].n_removed, bytes(found[0].kept)) == (60_000, 60_000, b"")
    assert P.repeated_words(no_documents).count() == 0


def test_matches_are_whole_words():
    words = [b"w%d" % i for i in range(35)]
    inside = [b"x" + words[0], *words[1:]]  # the phrase's letters, but its first word is longer
    covered = P.stream([[b"y", *words, b"z"], inside, [*words[:-1], words[-1] + b"4"]], {b" ".join(words)})
    assert [int(c.sum()) for c in covered] == [35, 0, 0]
    assert covered[0].tolist() == [False, *[True] * 35, False]


def test_phrases_cover_passages():
    words = [b"%d" % i for i in range(200)]
    for a, b in ((0, 35), (3, 73), (10, 80), (5, 41)):
        found = {int(w) for p in P.phrases_of(words, [(a, b)]) for w in p.split()}
        assert found == set(range(a, b))
        assert all(len(p.split()) == 35 for p in P.phrases_of(words, [(a, b)]))
