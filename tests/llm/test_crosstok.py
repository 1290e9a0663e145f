import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from areatab.llm import crosstok
from areatab.llm.tokens import vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def paths():
    return vocabulary(A), vocabulary(B)


@pytest.fixture(scope="module")
def libraries(paths):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    shown = {c: b for c, b in zip(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]), [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)], strict=True)}
    rest = [b for b in range(256) if b not in shown.values()]
    shown |= {chr(256 + k): b for k, b in enumerate(rest)}
    return a, {i: bytes(shown[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if set(t) <= set(shown)}, sentencepiece.SentencePieceProcessor(model_file=paths[1])


def piece_bytes(model, i):
    p = model.id_to_piece(i)
    if len(p) == 6 and p.startswith("<0x"):
        return bytes([int(p[3:5], 16)])
    return p.replace("▁", " ").encode()


def brute(libraries, rows):
    """Every text's tokens side by side, in plain Python."""
    a_tok, a_bytes, b_tok = libraries
    found, counts = [], Counter()
    for i, text, *_ in rows:
        a, b, links, groups = [], [], [], []
        if text:
            a = a_tok.encode(" " + text, add_special_tokens=False).ids
            b = b_tok.encode(text)
            pa_, pb = [a_bytes[x] for x in a], [piece_bytes(b_tok, x) for x in b]
            want = (" " + text).encode()
            if b"".join(pa_) != want or b"".join(pb) != want:
                a, b = [], []
            else:
                # both token lists side by side: whichever token ends first goes on
                x = y = end_a = end_b = 0
                sizes = [len(p) for p in pa_], [len(p) for p in pb]
                group = ([], [])
                while x < len(a):
                    links.append((a[x], b[y]))
                    stop_a, stop_b = end_a + sizes[0][x], end_b + sizes[1][y]
                    if stop_a <= stop_b:
                        group[0].append(str(a[x]))
                        end_a, x = stop_a, x + 1
                    if stop_b <= stop_a:
                        group[1].append(str(b[y]))
                        end_b, y = stop_b, y + 1
                    if stop_a == stop_b:
                        groups.append(group)
                        group = ([], [])
        counts.update(links)
        text_ = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        found.append((i, len(a), len(b), len(groups), links, hashlib.sha256(text_.encode()).hexdigest() if a else ""))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return sorted([(i, n_a, n_b, n_g, len(ls), sum(counts[x] == top[x[1]] for x in ls), sum(counts[x] for x in ls), h) for i, n_a, n_b, n_g, ls, h in found], key=repr)


TEXTS = ["", None, " ", "  a  b ", "It's a\ttest\n\n of <|endoftext|> and <s> </s> <unk>", "Ünï – “çø” 中文字 👍🏽 ﬁ", "a▁b", "\x00 nul", "x" * 3000, "the cat sat on the mat " * 40, "é́ é", "​ zero", "don't DON'T 3.14159 1234567", "   x", "\r\n\r\n"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_links_groups_and_counts_against_every_pair(documents, libraries, paths):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "international", "Straße", "…", "42", "\n", "  "]
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)] + [(100 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), "s") for k in range(60)]
    rows += [rows[4], (None, "no id", None)]
    want = brute(libraries, rows)
    assert rows_of(crosstok.align(documents(rows), *paths)) == want
    assert any(r[1] == 0 for r in want) and sum(r[4] for r in want) > 3000
    # many shards and blocks give the same
    assert rows_of(crosstok.align(documents(rows).repartition(5), *paths, shard_pairs=20, block_pairs=100)) == want


def test_odd_rows_and_empty_table(odd, odd_rows, no_documents, libraries, paths):
    want = brute(libraries, [(i, t) if t is None or len(t) < 60_000 else (i, None) for i, t, _ in odd_rows])
    got = rows_of(crosstok.align(odd.where("length(text) < 60000 or text is null"), *paths))
    assert got == [r for r in want if r[0] != 6]
    assert crosstok.align(no_documents, *paths).collect() == []


def test_ids_are_the_librarys(libraries, paths):
    own = crosstok.pair(*paths)
    rng = random.Random(9)
    texts = ["".join(rng.choice("aab 中é\t\n's1.<|>  \x1c\x85") for _ in range(rng.randint(1, 50))) for _ in range(5000)]
    texts += [chr(c) + "a " + chr(c) for c in range(1, 0x3000)]
    assert own.a.encoding.n_vocab == 50256
    assert [own.a(t) for t in texts] == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_cutting_long_texts_changes_no_id(paths):
    own = crosstok.pair(*paths)
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeé'. \n") for _ in range(rng.randint(1, 12))) for _ in range(20_000))
    assert own.b.cuts
    parts = list(crosstok.chunks(text, 1000))
    assert len(parts) > 50 and " ".join(parts) == text
    for encode in (own.a, own.b):
        assert [i for p in parts for i in encode(p)] == encode(text)


@pytest.mark.parametrize("n", [0, 1, 2, 70, 5000])
def test_perfect_hash_numbers_every_key_once(n):
    rng = np.random.default_rng(n)
    keys = rng.choice(1 << 31, n, replace=False).astype(np.int64)
    shard = crosstok.shard_of(keys, 1000, 3)
    rows = []
    for s in (0, 2):  # shard 1 is in another block
        sizes, words, order = crosstok.perfect_hash(keys[shard == s])
        rows.append((s, sizes, words.tobytes(), order.astype("<u4").tobytes()))
    x = crosstok.Numbers(3, 1000, "<u4", rows)
    here = shard != 1
    at = x.find(keys)
    assert sorted(at[here]) == list(range(int(here.sum()))) and (at[~here] == -1).all()
    assert (x.keys[at[here]] == keys[here]).all()
    other = np.setdiff1d(rng.choice(1 << 31, 2000), keys)
    assert (x.find(other) == -1).all()  # verified, not just hashed


def test_blocks_hold_whole_shards():
    assert crosstok.blocks([(0, 5), (1, 5), (2, 3), (3, 20), (4, 1)], 10) == [[0, 1], [2], [3], [4]]
    assert crosstok.blocks([]) == []


def test_query_over_the_whole_table_against_every_pair(spark, libraries):
    from areatab.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = QUERIES["op13_cross_tokenizer"](spark, sf)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(df) == brute(libraries, rows)
