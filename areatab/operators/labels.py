"""Category and variable labels.

Label lists are keyed by ``(codigo_variable, valor_categoria)``. A duplicate
key would fan out rows and inflate counts when joined, so labels are always
de-duplicated first, keeping the first row in source order. "First row per
key" is ``min_by(label, order)`` in a grouped aggregate. A string result has
no fixed-width buffer, so Spark plans a sort-based aggregate, but a partial
one: each map task sorts only its own rows and emits one row per key, and
only those partial rows are shuffled. A key repeated millions of times never
becomes one task's input (a row_number window would sort the whole key group
in a single task), and the label source itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areatab.operators.broadcast import bounded_broadcast

KEY = ("codigo_variable", "valor_categoria")

# English labels replaced with the published Spanish ones.
RECODES: Mapping[str, str] = {
    "NOTAPPLICABLE": "No aplica",
    "MISSING": "Sin dato",
}
SENTINEL = "Sin dato"


def recode_labels(label: Column | str, recodes: Mapping[str, str] = RECODES) -> Column:
    """Replace whole labels by exact match; anything else is kept."""
    c = F.col(label) if isinstance(label, str) else label
    out = None
    for src, dst in recodes.items():
        out = (F.when(c == F.lit(src), F.lit(dst)) if out is None else out.when(c == F.lit(src), F.lit(dst)))
    return c if out is None else out.otherwise(c)


def clean_labels(
    labels: DataFrame,
    order: str,
    junk: tuple[str, ...] = ("NA",),
    recode: bool = True,
    keep_order: bool = False,
) -> DataFrame:
    """Drop junk keys, keep the first label per key by ``order``, recode.

    ``keep_order`` adds ``_orden``, the kept label's place in the source.

    ``labels`` has ``codigo_variable, valor_categoria, etiqueta_categoria`` and
    an ``order`` column that is unique within a key (file + line).
    """
    v = F.col("valor_categoria")
    ok = v.isNotNull()
    for j in junk:
        ok = ok & (v != F.lit(j))
    place = [F.min(order).alias("_orden")] if keep_order else []
    first = labels.filter(ok).groupBy(*KEY).agg(F.min_by("etiqueta_categoria", order).alias("etiqueta_categoria"), *place)
    if recode:
        first = first.withColumn("etiqueta_categoria", recode_labels("etiqueta_categoria"))
    return first


def add_sentinel(labels: DataFrame, variables: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """Append one ``sentinel -> sentinel`` label per variable code.

    ``variables`` has ``codigo_variable``. Keys already present keep their
    own label.
    """
    extra = variables.select("codigo_variable").distinct().select(
        "codigo_variable", F.lit(sentinel).alias("valor_categoria"), F.lit(sentinel).alias("etiqueta_categoria")
    )
    extra = extra.join(labels.select(*KEY), list(KEY), "left_anti")
    return labels.select(*KEY, "etiqueta_categoria").unionByName(extra)


def strip_zeros(code: Column | str) -> Column:
    """Code without leading zeros (``'01'`` -> ``'1'``; ``'0'`` stays ``'0'``)."""
    c = F.col(code) if isinstance(code, str) else code
    return F.regexp_replace(c, r"^0+(?=.)", "")


def attach_labels(
    long: DataFrame,
    labels: DataFrame,
    fallback_to_value: bool = True,
    check_size: bool = False,
    strip_leading_zeros: bool = False,
) -> DataFrame:
    """Left join category labels on (variable, value); never changes row count.

    Labels must be unique per key (use :func:`clean_labels`). With
    ``fallback_to_value`` a missing label is the category value itself.
    Labels derived by an aggregate are left to AQE, which broadcasts them
    from their measured shuffle size; ``check_size`` instead proves the bound
    up front (cheap for label files read as-is).
    """
    if strip_leading_zeros:
        # a label file keyed '01' and data valued '1' (or the reverse) match;
        # the published value stays as it is in the data
        # of several spellings of a key the label that came first in the source
        # (labels cleaned with ``keep_order``), else that of the shortest spelling
        turn = F.col("_orden") if "_orden" in labels.columns else F.struct(F.length("valor_categoria"), F.col("valor_categoria"))
        lab = labels.select("codigo_variable", strip_zeros("valor_categoria").alias("_k"), "etiqueta_categoria", turn.alias("_turn"))
        lab = lab.groupBy("codigo_variable", "_k").agg(F.min_by("etiqueta_categoria", "_turn").alias("_label"))
        if check_size:
            lab = bounded_broadcast(lab)
        out = long.withColumn("_k", strip_zeros("valor_categoria")).join(lab, ["codigo_variable", "_k"], "left").drop("_k")
    else:
        lab = labels.select(*KEY, F.col("etiqueta_categoria").alias("_label"))
        if check_size:
            lab = bounded_broadcast(lab)
        out = long.join(lab, list(KEY), "left")
    label = F.coalesce(F.col("_label"), F.col("valor_categoria")) if fallback_to_value else F.col("_label")
    return out.withColumn("etiqueta_categoria", label).drop("_label")
