import hashlib
import random

import pyarrow as pa
import pytest

from areatab.llm import trie_bpe
from areatab.llm.tokens import vocabulary


@pytest.fixture(scope="module")
def path():
    return vocabulary("word_bpe_49k.json")


def own_ids(path, texts):
    ids, count = trie_bpe.encoder(path)(pa.array(texts, pa.string()))
    out, at = [], 0
    for n in count.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_ids_are_the_librarys_on_random_and_odd_texts(path):
    library = trie_bpe.encoder(path).tokenizer
    rng = random.Random(7)
    texts = ["".join(rng.choice("aabbce'é.́ßİΣ中👍<|ndotexs>\x00\x1c\x85　 \n") for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * n for n in range(1, 200)] + ["ab" * 90, "x" * 40_000, "thethethe" * 300]
    texts += ["<|endoftext|>" * 3, "x<|startoftext|>y <|endoftext|", "<<|endoftext|>>"]
    texts += [chr(c) + "a" + chr(c) for c in range(1, 0x3000)]
    assert own_ids(path, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_two_tokens_fit_if_merging_them_keeps_them_apart(path):
    rules = trie_bpe.encoder(path).rules
    rng = random.Random(3)
    plain = [t for t in rules.vocab if not t.endswith("</w>") and len(t) < 9 and rules.vocab[t] in rules.ends]
    every = [t for t in rules.vocab if len(t) < 14 and rules.vocab[t] in rules.ends and not t.startswith("<|")]
    fits = 0
    for _ in range(4000):
        a, b = rng.choice(plain), rng.choice(every)
        apart = [p[0] for p in rules.merge(a + b)] == [rules.vocab[a], rules.vocab[b]]
        assert rules.fits(rules.vocab[a], rules.vocab[b]) == apart, (a, b)
        fits += apart
    assert 0 < fits < 4000


def test_shared_prefixes_are_walked_once(path):
    rules = trie_bpe.encoder(path).rules
    words = ["inter", "international", "internationally", "internet", "int", "i"]
    got = trie_bpe.encode_parts(words, rules)
    assert got == {w: [p[0] for p in rules.merge(w + "</w>")] for w in words}


def expected(path, rows):
    library = trie_bpe.encoder(path).tokenizer
    out = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_digests_of_odd_rows(odd, odd_rows, path):
    assert sorted(map(tuple, trie_bpe.digests(odd, path).collect()), key=repr) == expected(path, odd_rows)


def test_empty_table(no_documents, path):
    assert trie_bpe.digests(no_documents, path).collect() == []
    assert trie_bpe.encode(no_documents, path).collect() == []


def test_decode_undoes_to_the_librarys_text(spark, odd, path):
    found = trie_bpe.encode(odd, path)
    again = trie_bpe.decode(found.withColumnRenamed("decoded", "want").withColumnRenamed("doc_id", "key"), path)
    assert again.where("want <> decoded").count() == 0 and again.count() == 10
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [3306, None, 86])], "decoded long, ids array<int>")
    assert [tuple(r) for r in trie_bpe.decode(nulls, path).collect()] == [(None, ""), ([], ""), ([3306, 86], "hello</w> w")]


def test_vocabulary_with_tokens_across_blanks_is_refused(path):
    with pytest.raises(ValueError):
        trie_bpe.Encoder(vocabulary("byte_bpe_50k.json"))


def test_query_over_the_whole_table_against_the_library(spark, path):
    from areatab.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_trie_bpe"](spark, sf).collect()), key=repr) == expected(path, rows)
