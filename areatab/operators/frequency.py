"""Area frequency tables: the one core computation.

For entity tables that already carry their area key, produce
``(area..., codigo_variable, valor_categoria, conteo)`` for every requested
variable in ONE pass: ``unpivot`` the variables into (variable, value) rows,
union the entities and run a single ``groupBy(...).count()``. Catalyst plans
this as Expand -> partial HashAggregate (map side) -> shuffle of the partial
counts -> final HashAggregate, so a hot area or a hot category is collapsed
before it is shuffled and never lands whole in one task.

Values are published as text. Mixed or text variables are cast before the
aggregate; when every variable is integer-coded the aggregate runs on the
native codes and each category is formatted once per group.

The reference runs one GROUP BY per variable (and re-joins the fact chain
each time); here the cost is one scan per entity and one shuffle of partial
counts for the whole run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areatab.functions.codes import code_entity

SENTINEL = "Sin dato"
NULL_POLICIES = ("keep", "drop", "drop_blank")

VarSpec = Mapping[str, "Column | str"] | Sequence[str]


def _var_columns(variables: VarSpec, as_text: bool = True) -> dict[str, Column]:
    if isinstance(variables, Mapping):
        items = variables.items()
    else:
        items = [(v, v) for v in variables]
    out: dict[str, Column] = {}
    for code, src in items:
        c = F.col(src) if isinstance(src, str) else src
        out[code] = c.cast("string") if as_text else c
    if not out:
        raise ValueError("no variables requested")
    return out


def _all_integral(df: DataFrame, variables: VarSpec) -> bool:
    """True if every variable expression resolves to an integer type."""
    specs = list(variables.values()) if isinstance(variables, Mapping) else list(variables)
    if all(isinstance(v, str) for v in specs):
        # plain column names: read the (cached) schema, no extra analysis
        by_name = {f.name.lower(): f.dataType for f in df.schema.fields}
        if all(v.lower() in by_name for v in specs):
            return all(isinstance(by_name[v.lower()], T.IntegralType) for v in specs)
    cols = _var_columns(variables, as_text=False)
    types = df.select(*[c.alias(code) for code, c in cols.items()]).schema
    return all(isinstance(f.dataType, T.IntegralType) for f in types.fields)


def _refuse_fractions(df: DataFrame, variables: VarSpec) -> None:
    """Category codes are text or integers; a floating-point code has no exact text (``1`` or ``1.0``)."""
    cols = _var_columns(variables, as_text=False)
    found = df.select(*[c.alias(code) for code, c in cols.items()]).schema
    bad = [f.name for f in found.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if bad:
        raise TypeError(f"category codes must be text or integers, not {bad}: cast them explicitly")


def apply_null_policy(value: Column, policy: str, sentinel: str = SENTINEL) -> tuple[Column, Column | None]:
    """Return (value expression, row filter) for a NULL policy.

    keep       -> NULL counted as ``sentinel`` (every variable sums to the entity total)
    drop       -> NULL rows removed
    drop_blank -> NULL and empty-string rows removed
    """
    if policy == "keep":
        return F.coalesce(value, F.lit(sentinel)), None
    if policy == "drop":
        return value, value.isNotNull()
    if policy == "drop_blank":
        return value, value.isNotNull() & (value != F.lit(""))
    raise ValueError(f"null_policy must be one of {NULL_POLICIES}, got {policy!r}")


def unpivot_variables(
    df: DataFrame,
    variables: VarSpec,
    ids: Sequence[str] = ("id_geo",),
    null_policy: str = "drop",
    sentinel: str = SENTINEL,
) -> DataFrame:
    """Long rows ``(ids..., codigo_variable, valor_categoria)``, one per entity row and variable."""
    cols = _var_columns(variables)
    wide = df.select(*[F.col(i) for i in ids], *[c.alias(code) for code, c in cols.items()])
    long = wide.unpivot(list(ids), list(cols), "codigo_variable", "valor_categoria")
    value, keep = apply_null_policy(F.col("valor_categoria"), null_policy, sentinel)
    if keep is not None:
        long = long.filter(keep)
    return long.withColumn("valor_categoria", value)


def frequencies(
    df: DataFrame,
    variables: VarSpec,
    area: Sequence[str] = ("id_geo",),
    null_policy: str = "drop",
    drop_missing_area: bool = True,
    sentinel: str = SENTINEL,
) -> DataFrame:
    """Sparse frequency table of every variable by area.

    ``variables`` maps the published variable code (``ENTITY_NAME``) to a
    column or expression, or lists column names used as codes. Only observed
    (area, category) pairs appear; there are no totals and no zero cells.
    """
    src = df
    if drop_missing_area:
        cond = None
        for a in area:
            c = F.col(a).isNotNull()
            cond = c if cond is None else cond & c
        src = src.filter(cond)
    return frequencies_multi([(src, variables)], area, null_policy, drop_missing_area=False, sentinel=sentinel)


def frequencies_multi(
    sources: Sequence[tuple[DataFrame, VarSpec]],
    area: Sequence[str] = ("id_geo",),
    null_policy: str = "drop",
    drop_missing_area: bool = True,
    sentinel: str = SENTINEL,
) -> DataFrame:
    """Frequency table of several entities in ONE aggregate.

    Each ``(entity rows, variables)`` source is unpivoted on its own; the
    narrow long rows are unioned and counted by a single ``groupBy``, so the
    whole run has one aggregation shuffle instead of one per entity. Variable
    codes carry the entity prefix, so groups of different entities never mix.
    """
    def present(df: DataFrame) -> DataFrame:
        if not drop_missing_area:
            return df
        cond = None
        for a in area:
            c = F.col(a).isNotNull()
            cond = c if cond is None else cond & c
        return df.filter(cond)

    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, got {null_policy!r}")
    if all(_all_integral(df, v) for df, v in sources):
        return _frequencies_integral([(present(df), v) for df, v in sources], area, null_policy, sentinel)
    for df, v in sources:
        _refuse_fractions(df, v)
    longs = [unpivot_variables(present(df), v, area, null_policy, sentinel) for df, v in sources]
    long = longs[0]
    for other in longs[1:]:
        long = long.unionByName(other)
    return long.groupBy(*area, "codigo_variable", "valor_categoria").agg(F.count(F.lit(1)).alias("conteo"))


def _frequencies_integral(sources, area, null_policy: str, sentinel: str) -> DataFrame:
    """All variables integer-coded: count on the native codes, format once per group.

    Integer keys hash and shuffle cheaper than text, and the code-to-text
    cast runs once per (area, variable, category) group instead of once per
    entity row and variable. The text is the same as casting first; a blank
    category cannot occur, and NULL is its own group until it is named.
    """
    longs = []
    for df, variables in sources:
        cols = {code: c.cast("long") for code, c in _var_columns(variables, as_text=False).items()}
        wide = df.select(*[F.col(a) for a in area], *[c.alias(code) for code, c in cols.items()])
        lg = wide.unpivot(list(area), list(cols), "codigo_variable", "_v")
        if null_policy != "keep":
            lg = lg.filter(F.col("_v").isNotNull())
        longs.append(lg)
    long = longs[0]
    for other in longs[1:]:
        long = long.unionByName(other)
    counted = long.groupBy(*area, "codigo_variable", "_v").agg(F.count(F.lit(1)).alias("conteo"))
    text = F.col("_v").cast("string")
    if null_policy == "keep":
        text = F.coalesce(text, F.lit(sentinel))
    return counted.select(*area, "codigo_variable", text.alias("valor_categoria"), "conteo")


def frequencies_by_levels(
    df: DataFrame,
    variable: Column | str,
    by: Sequence[Column | str],
    null_policy: str = "drop",
    sentinel: str = SENTINEL,
) -> DataFrame:
    """One variable crossed by named area levels (``freq V by L1 by L2 ...``)."""
    v = (F.col(variable) if isinstance(variable, str) else variable).cast("string")
    value, keep = apply_null_policy(v, null_policy, sentinel)
    src = df if keep is None else df.filter(keep)
    by_cols = [F.col(b) if isinstance(b, str) else b for b in by]
    return src.groupBy(*by_cols, value.alias("valor_categoria")).agg(F.count(F.lit(1)).alias("conteo"))


def totals_check(df: DataFrame, entity: str, variables: VarSpec, sentinel: str = SENTINEL) -> DataFrame:
    """Totals invariant of one entity in one pass: ``(codigo_variable, total, expected, ok)``.

    The rows with an area are counted as one more variable of the same
    aggregate, so the entity is read and joined once.
    """
    marker = f"{entity}\0"
    specs = dict(variables) if isinstance(variables, Mapping) else {v: v for v in variables}
    long = unpivot_variables(df.filter(F.col("id_geo").isNotNull()), {**specs, marker: F.lit("")}, ("id_geo",), "keep", sentinel)
    totals = long.groupBy("codigo_variable").agg(F.count(F.lit(1)).alias("total"))
    # one row a variable from here on
    expected = F.max(F.when(F.col("codigo_variable") == F.lit(marker), F.col("total"))).over(Window.partitionBy(F.lit(entity)))
    out = totals.withColumn("expected", expected).filter(F.col("codigo_variable") != F.lit(marker))
    return out.select("codigo_variable", "total", "expected", (F.col("total") == F.col("expected")).alias("ok"))


def check_totals(freq: DataFrame, entity_counts: DataFrame) -> DataFrame:
    """Totals invariant: each variable of an entity sums to the entity count.

    ``entity_counts`` has ``(entidad, expected)``, one row per entity. The
    join is on the entity, so it is an equi-join against a table with one
    row per entity, never a cross product.
    """
    totals = freq.groupBy("codigo_variable").agg(F.sum("conteo").cast("long").alias("total"))
    totals = totals.withColumn("entidad", code_entity("codigo_variable"))
    out = totals.join(F.broadcast(entity_counts), "entidad", "left")
    return out.select(
        "codigo_variable",
        "total",
        F.col("expected").cast("long").alias("expected"),
        F.coalesce(F.col("total") == F.col("expected"), F.lit(False)).alias("ok"),
    )


def entity_count(df: DataFrame, entity: str, area: str | None = "id_geo") -> DataFrame:
    """``(entidad, expected)``: rows of an entity (with an area, if given)."""
    src = df if area is None else df.filter(F.col(area).isNotNull())
    return src.agg(F.count(F.lit(1)).alias("expected")).select(F.lit(entity).alias("entidad"), "expected")


def rollup_levels(freq: DataFrame, by: Sequence[str]) -> DataFrame:
    """Re-aggregate an area frequency table to coarser named levels, variable by variable."""
    return freq.groupBy(*by, "codigo_variable", "valor_categoria").agg(F.sum("conteo").cast("long").alias("conteo"))
