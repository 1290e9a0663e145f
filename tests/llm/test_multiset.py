import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from areatab.llm import multiset as M


def test_equality_is_that_of_paragraph_multisets(spark):
    texts = {1: "a b\nc\nc", 2: "c\na b\nc", 3: "a b\nc", 4: "a\nb c\nc", 5: "a b c\nc", 6: "", 7: None, 8: "\n"}
    found = {r.doc_id: tuple(r.sums) for r in M.fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert found[1] == found[2] and found[6] == found[7]
    assert len({found[k] for k in (1, 3, 4, 5, 6, 8)}) == 6


def test_insertion_and_deletion(spark):
    frame = spark.createDataFrame([(1, "one two.\nthree"), (2, "four. five"), (3, "four. five\nthree\none two.")], "doc_id long, text string")
    wide = M.fingerprints(frame).groupBy().pivot("doc_id", [1, 2, 3]).agg(F.first("sums"))
    both = wide.select((M.combine(F.col("1"), F.col("2")) == F.col("3")).alias("sum"), (M.combine(F.col("3"), F.col("2"), -1) == F.col("1")).alias("difference"))
    assert tuple(both.first()) == (True, True)


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_likeness_estimates_the_shared_pieces(spark):
    rng = random.Random(4)
    rows, want = [], []
    for k in range(30):
        shared = {f"s{k} {i} common piece" for i in range(rng.choice([0, 50, 300]))}
        own = [{f"s{k} {i} own {side}" for i in range(rng.choice([0, 1, 100]))} for side in "ab"]
        a, b = (sorted(shared | x) for x in own)
        rows.append((k, "\n".join(a), "\n".join(b)))
        want.append(1.0 if a == b else jaccard(set(a) or {""}, set(b) or {""}))
    frame = spark.createDataFrame(rows, "k long, a string, b string")
    sums = [M.with_sums(frame, ["k"], c).withColumnRenamed("sums", c) for c in "ab"]
    found = {r.k: r.x for r in sums[0].join(sums[1], "k").select("k", M.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    for k, w in enumerate(want):
        assert abs(found[k] - w) < 0.2 and (found[k] == 1.0) == (w == 1.0)


def test_likeness_counts_repeated_pieces_one_by_one(spark):
    rng = random.Random(6)
    menu = [f"menu line {i} again." for i in range(7)]
    pairs = [
        (["ten equal words here."] * 10, ["ten equal words here."] * 5),  # in one paragraph
        ([f"row {i} of a table." for i in range(20)] * 30, [f"row {i} of a table." for i in range(20)] * 12),
        (menu * 40 + ["own text of a."], menu * 25 + ["own text of b."]),
        (menu * 40, [f"other line {i} again." for i in range(7)] * 40),
        ([f"s {rng.randrange(50)} common piece." for _ in range(900)], [f"s {rng.randrange(50)} common piece." for _ in range(900)]),
        (["x y z w."] * 200_000, ["x y z w."] * 60_000),  # past 16 bits
        ([f"long {i} text." for i in range(200_000)], [f"long {i} text." for i in range(100_000)]),
        (["x y z w."] * 90_000 + [f"long {i} text." for i in range(90_000)], ["x y z w."] * 90_000 + [f"more {i} text." for i in range(90_000)]),
    ]
    frame = spark.createDataFrame([(k, sep.join(a), sep.join(b)) for k, (a, b) in enumerate(pairs) for sep in [" " if k == 0 else "\n"]], "k long, a string, b string")
    sums = [M.with_sums(frame, ["k"], c).withColumnRenamed("sums", c) for c in "ab"]
    found = {r.k: r.x for r in sums[0].join(sums[1], "k").select("k", M.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    for k, (a, b) in enumerate(pairs):
        a, b = Counter(a), Counter(b)
        assert abs(found[k] - (a & b).total() / (a | b).total()) < 0.2, k


def test_shared_and_repeated_paragraphs_add_up(spark):
    frame = spark.createDataFrame([(1, "a b.\na b.\nc"), (2, "c\na b. d"), (3, "c\na b.\nc\na b. d\na b.")], "doc_id long, text string")
    wide = M.fingerprints(frame).groupBy().pivot("doc_id", [1, 2, 3]).agg(F.first("sums"))
    assert wide.select(M.combine(F.col("1"), F.col("2")) == F.col("3")).first()[0]


def brute_edited(rows):
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    out = []
    for k, (known, i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][2]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        out.append((str(i if known else None), len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out)


def test_edited_texts(documents, odd, odd_rows, no_documents, monkeypatch):
    found = M.edited(odd).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == brute_edited([(i, t) for i, t, _ in odd_rows])
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    # many ranges of ids
    buckets = M.range_buckets
    monkeypatch.setattr(M, "range_buckets", lambda df, key, rows, _: buckets(df, key, rows, 7))
    rng = random.Random(9)
    rows = [(rng.choice([3, 10**15 + k, -k, k * k]), " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(0, 60)))) for k in range(150)]
    many = M.edited(documents([(i, t, None) for i, t in rows])).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in many) == brute_edited(rows)
    alone = M.edited(documents([(1, "abcd", None)])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone[0].near_next == 1.0
    assert M.edited(no_documents).count() == 0


def test_no_python_in_the_plan(odd):
    plan = M.edited(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
