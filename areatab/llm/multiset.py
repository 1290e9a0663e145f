"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A text is a multiset of paragraphs (between line feeds). Each paragraph is
hashed to a wide vector; the fingerprint is the vectors' sum, every element
modulo 2 ** 32, so it doesn't depend on the paragraphs' order, and inserting or
deleting a paragraph adds or subtracts one vector. Two kinds of elements:

* 8 elements of the paragraph's own hashes: 256 bits that tell texts apart;
* 96 elements that each sum a number drawn by a hash of the paragraph's pieces,
  four words or the rest of a sentence each. The numbers have a Cauchy
  distribution, so the difference of two fingerprints' elements has one too, and
  its width is the number of pieces that only one text has, a piece that stands
  k times more in one counting k times. The width and the piece counts give the
  likeness (shared over all, as in Jaccard of multisets), 0 to 1, without the
  texts; its standard error is at most 0.08.

Two elements count paragraphs and pieces. Sums of 32-bit numbers in 64 bits
don't overflow below 2 ** 31 pieces. Differences of elements are read modulo
2 ** 32, where a twentieth of them wraps from about 10 million pieces that only
one text has.

Defined cases: a null text is an empty one, which has one empty paragraph; of
equal doc_ids the order is that of their texts; null doc_ids come first; a table
of one row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areatab.llm.common import meet, range_buckets, written

OWN = 8
DRAWS = 96
#: Width of one piece's numbers before they are rounded.
WIDTH = 16
#: A piece: up to four words that end with a sentence or the paragraph.
PIECE = r"(?:[^\s.!?]++\s++){0,3}\S++"
MOD = 1 << 32


def uniform(bits: Column) -> Column:
    """A number in (-1, 1) from 32 random bits."""
    return bits.cast("double") * F.lit(2.0**-31) + F.lit(2.0**-32 - 1.0)


def cauchy(x: Column) -> Column:
    """The Cauchy quantile tan(pi x / 2) for x in (-1, 1), by arithmetic that is equal on every machine.

    The first of the tangent's partial fractions, and the others' power series; off by less than 0.1 %.
    """
    q = x * x
    return F.lit(4 / math.pi) * x * (F.lit(1.0) / (F.lit(1.0) - q) + F.lit(math.pi**2 / 8 - 1) + q * F.lit(math.pi**4 / 96 - 1 + 0.0014))


def own_lanes(paragraph: Column, first: Column) -> list[Column]:
    """What a paragraph adds to its own elements, with its first piece."""
    out = []
    for k in range(OWN // 2):
        h = F.xxhash64(paragraph, F.lit(k))
        out += [F.when(first, h.bitwiseAND(F.lit(MOD - 1))).otherwise(F.lit(0)), F.when(first, F.shiftrightunsigned(h, 32)).otherwise(F.lit(0))]
    return out


def with_sums(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, sums): the fingerprint's elements as an array; one text for each combination of keys."""
    p = rows.select(*keys, F.explode(F.split(F.col(text), "\n")).alias("p"))
    s = p.select(*keys, "p", F.posexplode_outer(F.regexp_extract_all("p", F.lit(PIECE), 0)).alias("at", "s"))
    s = s.withColumns({"at": F.coalesce("at", F.lit(0)), "s": F.coalesce("s", F.lit(""))})
    # step by step, so that no expression is worked out twice
    first, half = F.col("at") == 0, DRAWS // 2
    own = [x.cast("long").alias(f"e{k}") for k, x in enumerate(own_lanes(F.col("p"), first))]
    made = s.select(*keys, *own, first.cast("long").alias("first"), F.xxhash64("s", F.lit(101)).alias("h"))
    ready = [*keys, *(f"e{k}" for k in range(OWN)), "first"]
    made = made.select(*ready, *(F.xxhash64("h", F.lit(k)).alias(f"h{k}") for k in range(half)))
    low = [uniform(F.col(f"h{k}").bitwiseAND(F.lit(MOD - 1))).alias(f"x{2 * k}") for k in range(half)]
    high = [uniform(F.shiftrightunsigned(f"h{k}", 32)).alias(f"x{2 * k + 1}") for k in range(half)]
    made = made.select(*ready, *low, *high)
    drawn = [F.rint(F.lit(float(WIDTH)) * cauchy(F.col(f"x{k}"))).cast("long").bitwiseAND(F.lit(MOD - 1)) for k in range(DRAWS)]
    made = made.select(*ready, *(x.alias(f"e{OWN + k}") for k, x in enumerate(drawn)))
    names = [*(f"e{k}" for k in range(OWN + DRAWS)), "first"]
    sums = made.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names], F.count("*").alias("pieces"))
    return sums.select(*keys, F.array(*[F.col(c) % F.lit(MOD) for c in [*names, "pieces"]]).alias("sums"))


def as_text(sums: Column) -> Column:
    """The fingerprint's string: eight lowercase hex digits an element."""
    return F.lower(F.array_join(F.transform(sums, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the paragraphs of both (``sign`` 1), or of the first without the second (-1)."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + F.lit(sign) * y, F.lit(MOD)))


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` worked out a single time."""
    return F.element_at(F.transform(F.array(value), then), 1)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of pieces that two fingerprints' texts have in common, 0 to 1."""
    size = OWN + DRAWS + 2
    n_a, n_b = F.element_at(a, size), F.element_at(b, size)
    balanced = lambda x: F.pmod(x + F.lit(MOD >> 1), F.lit(MOD)) - F.lit(MOD >> 1)
    apart = F.slice(F.zip_with(a, b, lambda x, y: F.abs(balanced(x - y)).cast("double")), OWN + 1, DRAWS)
    mean = lambda ds, f: F.aggregate(ds, F.lit(0.0), lambda total, d: total + f(d)) / F.lit(float(DRAWS))

    def width(ds: Column) -> Column:
        """That of the differences' distribution: the geometric mean, and from there a step towards the most likely width."""
        rough = F.exp(mean(ds, lambda d: F.log(F.greatest(d, F.lit(0.5)))))
        better = lambda r: r * F.exp(F.lit(2.0) * mean(ds, lambda d: (d * d - r * r) / (d * d + r * r)))
        # equal pieces leave no difference
        return F.when(F.array_max(ds) == 0, F.lit(0.0)).otherwise(once(rough, better))

    # at least the difference in number is in one text only
    only = F.greatest(once(apart, width) / F.lit(float(WIDTH)), F.abs(n_a - n_b).cast("double"))
    both = (n_a + n_b).cast("double")
    share = once(only, lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (both - x) / (both + x))))
    return F.when(a == b, F.lit(1.0)).otherwise(share)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, sums): the fingerprint of every row's text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return with_sums(rows, ["doc_id", "row"], "text").select("doc_id", "sums")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next). The edited text's last floor(n_chars / 2) code
    points are replaced by the first as many, or all, of the next document's.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = range_buckets(rows, "doc_id", rows.count(), 1024)
    # a range's first text goes to the range before it as well, as the end of that range's list
    heads = written(dealt.groupBy("bucket").agg(F.min(F.struct("doc_id", "text")).alias("head")), "multiset-heads")
    turn = Window.orderBy("bucket")  # the ranges' numbers only
    whole = turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = heads.select("bucket", F.coalesce(F.lag("bucket").over(turn), F.last("bucket").over(whole)).alias("before"))
    guests = meet(heads, before, "bucket").select(F.col("before").alias("bucket"), F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"), F.lit(1).alias("guest"))
    listed = dealt.select("bucket", "doc_id", "text", F.lit(0).alias("guest")).unionByName(guests)
    inside = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    listed = listed.withColumn("rn", F.row_number().over(inside)).withColumn("next", F.lead("text").over(inside))
    edit = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 2)))"), F.expr("substring(next, 1, int(floor(length(text) / 2)))"))
    keys = ["bucket", "rn", "guest", "doc_id", "n_chars", "edited_sha256"]
    keyed = listed.select("bucket", "rn", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", F.when(F.col("guest") == 0, edit).alias("edited"))
    own = F.struct(F.lit(0).alias("v"), F.col("text").alias("t"))
    versions = keyed.select(
        *keys[:-1], F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.explode(F.when(F.col("guest") == 1, F.array(own)).otherwise(F.array(own, F.struct(F.lit(1).alias("v"), F.col("edited").alias("t"))))).alias("x"),
    ).select(*keys, "x.v", "x.t")
    sums = with_sums(versions, [*keys, "v"], "t")
    sides = [F.max(F.when(F.col("v") == k, F.col("sums"))).alias(f"f{k}") for k in range(2)]
    found = sums.groupBy(*keys).agg(*sides)
    # the next document's fingerprint is the next row's; ranges are still together, so nothing is shuffled for it
    found = found.withColumn("f2", F.lead("f0").over(Window.partitionBy("bucket").orderBy("rn"))).where("guest = 0")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f0")).alias("fingerprint"), as_text(F.col("f1")).alias("edited_fingerprint"),
        likeness(F.col("f0"), F.col("f1")).alias("near_edited"), likeness(F.col("f0"), F.col("f2")).alias("near_next"),
    )
