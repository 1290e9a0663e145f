import zlib

import numpy as np
import pyarrow as pa
import pytest

from areatab.llm import tokens as T
from areatab.session import scratch_path

TEXTS = ["", "It's a  test,\tof words' ends", "Ünï-çødé – “x” …, … don't DON'T ...!!! 3.14 a.b.c x'", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>!", "naïve! naïve, É́! ñ. ½. ²; x²!", "\n \x0b", "a b c ''s' 's", "İstanbul! ΟΔΟΣ. ẞ?"]


@pytest.mark.parametrize("width", [1, 2, 7, 16, 17, 31, 32])
def test_packing_round_trip(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        data = T.pack(ids, width)
        assert len(data) == -(-n * width // 8)
        assert T.unpack(data, n, width).tolist() == ids.tolist()
        for a in (0, 1, 62, 64, 700):
            if a < n:
                assert T.unpack(data, n - a, width, a).tolist() == ids[a:].tolist()
    assert T.unpack(T.pack(np.array([5 % (1 << width)], np.uint32), width), 1, width).tolist() == [5 % (1 << width)]


def test_ids_by_word_are_the_texts_ids():
    path = T.vocabulary()
    tokenizer, by_word, plain = T.loaded(path)
    assert by_word and plain and T.bits_for(path) == 16
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in TEXTS]
    encoder = T.Encoder(path)
    for _ in range(2):  # from scratch, and from memory
        ids, count = encoder(pa.array(TEXTS))
        assert count.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
        ids, count = encoder(pa.array([None, "x"]))
        assert (count.tolist(), ids[0]) == ([1, 2], 1)


def test_a_tokenizer_that_keeps_white_space_encodes_whole_texts():
    path = T.vocabulary("byte_bpe_50k.json")
    tokenizer, by_word, _ = T.loaded(path)
    assert not by_word
    ids, count = T.Encoder(path, 0)(pa.array(["a b", None]))
    assert ids.tolist() == [*tokenizer.encode("a b").ids, 0, 0] and count.tolist()[1] == 1


def brute(rows):
    tokenizer = T.loaded(T.vocabulary())[0]
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("per_bucket", [1024, 3])
def test_file_round_trip(documents, odd_rows, monkeypatch, per_bucket):
    buckets = T.range_buckets
    monkeypatch.setattr(T, "range_buckets", lambda df, key, rows, _: buckets(df, key, rows, per_bucket))
    rows = [(i, t) for i, t, _ in odd_rows] + [(100 - k, t) for k, t in enumerate(TEXTS)]
    found = T.round_trip(documents([(i, t, None) for i, t in rows])).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=str) == brute(rows)


def test_blocks_and_random_access(spark, documents):
    rows = [(k, f"word{k} " * (k % 50)) for k in range(300)]
    out = scratch_path(spark, "test-tokens")
    T.write(documents([(i, t, None) for i, t in rows]), out, T.vocabulary(), block_ids=500)
    found = {r.doc_id: r for r in T.read(spark, out).collect()}
    assert len({(r.bucket, r.block) for r in found.values()}) > 5
    tokenizer = T.loaded(T.vocabulary())[0]
    for k in (0, 49, 299):
        r = found[k]
        ids = T.document(spark, out, r.bucket, r.block, r.at, r.n_tokens)
        assert ids.tolist() == [*tokenizer.encode(rows[k][1], add_special_tokens=False).ids, 1]


def test_empty_table(no_documents):
    assert T.round_trip(no_documents).count() == 0
