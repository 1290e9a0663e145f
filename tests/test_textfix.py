import random
import tracemalloc

import pyarrow as pa

from areatab.functions.textfix import RULE_SETS, RULES_1991, RULES_2001, count_damaged, java_pattern, repair, repair_text, repaired, repairer, sees_one_word

RC = "�"


def _fix(spark, texts, rules):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(repair("t", rules)).collect()]


def test_rule_counts():
    assert len(RULES_1991) == 22 and len(RULES_2001) == 104


def test_2001_rules_in_order_including_known_mistakes(spark):
    inp = [f"a{RC}os", f"Gonz{RC}lez", f"Tucum{RC}n", f"C{RC}rdoba", f"R{RC}o Negro", f"Neuqu{RC}n", "sin dano", None]
    out = _fix(spark, inp, "2001")
    assert out[0] == "años"
    assert out[1] == "Gonzálezez"  # rule 'Gonz?l' -> 'González' keeps the tail
    assert out[2] == "Tucumón"  # caught by the generic '?n\b' rule
    assert out[3] == f"C{RC}rdoba"  # no rule matches
    assert out[4] == "Río Negro"
    assert out[5] == "Neuquón"
    assert out[6] == "sin dano" and out[7] is None


def test_2001_anchor_rules(spark):
    out = _fix(spark, [f"{RC}o", f"fin{RC}", f"fin{RC}\n", f"x{RC}a y"], "2001")
    assert out[0] == "Ño"
    assert out[1] == "finó"
    assert out[2] == f"fin{RC}\n"  # '$' is the very end only, as in R
    assert out[3] == "xía y"


def test_1991_fallback(spark):
    out = _fix(spark, [f"Var{RC}n", f"C{RC}rdoba"], "1991")
    assert out == ["Varón", "Córdoba"]


def test_count_damaged(spark):
    df = spark.createDataFrame([(f"a{RC}b{RC}",), (None,)], "t string")
    assert [r[0] for r in df.select(count_damaged("t")).collect()] == [2, 0]


def test_java_pattern():
    assert java_pattern("x$") == "x\\z"
    # spelled out: what \b takes for a letter differs between Java versions
    assert java_pattern("a\\b") == r"a(?![\p{L}\p{M}\p{N}_])"


def test_rule_lists_are_unchanged():
    import hashlib

    from areatab.functions.textfix import RULES_1991, RULES_2001

    digest = lambda rules: hashlib.sha256("\n".join("|".join(r) for r in rules).encode()).hexdigest()[:16]
    assert (len(RULES_1991), len(RULES_2001)) == (22, 104)
    assert (digest(RULES_1991), digest(RULES_2001)) == ("271d7786012b9e8c", "58d79f4a5b28d12a")


def test_word_ends_do_not_depend_on_the_engine(spark):
    from areatab.functions.textfix import repair

    texts = ["gu�a", "gu�aé", "gu�as", "gu�a.", "gu�a_", "gu�a9", "a�o", "a�oñ"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(repair("t", "2001").alias("r")).collect()
    assert [r.r for r in rows][0] == "guía" and rows[3].r == "guía."
    assert "�" in rows[1].r and "�" in rows[2].r and "�" in rows[4].r and "�" in rows[5].r and rows[6].r == "año"


def test_corrected_rules_mend_what_the_published_ones_break(spark):
    from areatab.functions.textfix import CORRECT_WORDS, count_damaged, damage, repair

    rows = spark.createDataFrame([(damage(w), w) for w in CORRECT_WORDS], "t string, w string")
    found = rows.select("w", repair("t", "corrected").alias("r"), repair("t", "2001").alias("o"), count_damaged(repair("t", "corrected")).alias("n")).collect()
    assert all(r.r == r.w and r.n == 0 for r in found)
    assert any(r.o != r.w for r in found)


def _damaged_texts(n):
    """Random texts from what the rules look for, blanks, line breaks and stray '�'."""
    rng = random.Random(11)
    pieces = [p.strip("^$").removesuffix("\\b") for p, _, _ in RULE_SETS["corrected"]]
    pieces += [" ", " ", "  ", RC, RC + RC, "o", "a", "n", "1", "_", "s", "\n", "\t", "é", "́", "² ", "x", "Entre", "Negro"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_one_pass_equals_the_chain(spark):
    texts = [*_damaged_texts(4000), "", None, "sin dano", "x" * 5000 + RC, (f"a{RC}o " * 3000)]
    own = (("b c�", "b d", "literal"), ("�$", "z", "regex"), (" �a ", " q ", "literal"), ("c�.", "w", "regex"), ("n�", "ñ", "literal"))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for rules in ("1991", "2001", "corrected", own):
        out = df.select(repair("t", rules).alias("a"), repair_text("t", rules).alias("b")).collect()
        assert [r.b for r in out] == [r.a for r in out]


def test_which_rules_see_one_word():
    assert all(map(sees_one_word, RULES_2001)) and all(map(sees_one_word, RULES_1991))
    assert [r[0] for r in RULE_SETS["corrected"] if not sees_one_word(r)] == [f"Entre R{RC}os", f"R{RC}o Negro", f"R{RC}o Cuarto", f"Ciudad Aut{RC}noma"]
    for other in ((f" {RC} ", " x ", "literal"), (f" {RC}", "x", "literal"), (f"{RC}", "a b", "literal"), (f"a.{RC}", "x", "regex"), ("a", "b", "literal")):
        assert not sees_one_word(other)


def test_distinct_words_are_worked_out_once():
    fix = repairer((("a�", "aá", "literal"),))
    assert fix("a� b a� a�") == "aá b aá aá"


def test_remembered_words_stay_small_whatever_the_number_of_words():
    fix = repairer((*RULE_SETS["corrected"], ("own�rule", "ownórule", "literal")))  # rules of its own: nothing remembered yet
    tracemalloc.start()
    for k in range(60):
        fix(" ".join(f"{k}w{i}�" for i in range(1000)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 12e6  # all 60,000 remembered take about 30 MB


def test_a_batch_is_decoded_in_slices():
    texts = [None, "", *(f"a�o{i} ca�er " * 4000 for i in range(200)), None]  # about 15 MB
    batch = pa.array(texts, pa.string())
    fix = repairer(RULES_2001)
    expected = [None if t is None else fix(t) for t in texts]
    got, sizes = [], []
    for part in repaired(batch, RULES_2001):
        sizes.append(part.nbytes)
        got += part.to_pylist()
    assert got == expected and len(sizes) > 10 and max(sizes) < 3e6
    assert [p.to_pylist() for p in repaired(batch.slice(0, 0), RULES_2001)] == [[]]


def test_slices_keep_their_rows(spark):
    n = 300
    df = spark.range(n, numPartitions=2).selectExpr("id", "if(id % 7 = 0, null, concat(id, repeat(' a�os', if(id % 3 = 0, 8000, 1)))) t")
    rows = df.select("id", repair("t", "2001").alias("a"), repair_text("t", "2001").alias("b")).collect()
    assert len(rows) == n and all(r.a == r.b for r in rows) and all(r.b is None or r.b.startswith(f"{r.id} años") for r in rows)
