"""Area hierarchy: lookups, attaching areas to entities, coverage, crosswalks.

Shape of the work at scale: the geography dimensions (provinces,
departments, fractions, radios) are small and bounded, so they are joined
with a broadcast when the optimiser knows their size in bytes. The entity chain (dwelling -> household ->
person) is large on every level. We never widen the big tables: the area key
is rolled *down* the chain as a two-column map ``(key, id_geo)``, so each
fact table is shuffled once, with only the columns the tabulation needs, and
AQE's skew-join splitting handles a parent that owns a huge share of rows.

Entity joins are shuffled hash joins built on the parent map (``shuffle_hash``
hint on the map side). Parent keys are unique, so a build partition holds
parents / partitions rows no matter how skewed the children are; the children
stream through, and no sort is needed. Without table statistics Spark would
estimate the map as the product of its inputs and build on the wrong side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areatab.functions.codes import format_code, to_int
from areatab.operators.broadcast import bounded_broadcast
from areatab.operators.skew import salted_join


def join_chain(
    base: DataFrame,
    steps: Sequence[tuple[DataFrame, str | Sequence[str] | Column]],
    how: str = "inner",
    broadcast_dims: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``base`` to each dimension in turn (``how`` = inner or left).

    Each step is ``(dimension, on)``; ``on`` follows ``DataFrame.join``.
    Dimensions are broadcast only if the optimiser knows their size in bytes. SQL semantics
    never match NULL keys; ``null_safe=True`` (string keys only) matches NULL
    to NULL the way data-frame libraries do by default.
    """
    out = base
    for dim, on in steps:
        d = bounded_broadcast(dim) if broadcast_dims else dim
        if null_safe and isinstance(on, str):
            r = d.withColumnRenamed(on, "_rk")
            out = out.join(r, out[on].eqNullSafe(r["_rk"]), how).drop("_rk")
        else:
            out = out.join(d, on, how)
    return out


def roll_down(
    child: DataFrame,
    child_key: str,
    parent_fk: str,
    parent_area: DataFrame,
    parent_key: str,
    area_cols: Sequence[str] = ("id_geo",),
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """Area map of a child level: ``(child_key, area...)``.

    ``parent_area`` is ``(parent_key, area...)``. Only the key columns travel
    through the shuffle. ``hot_rows`` switches to a salted join for parents
    with more than that many children (see ``operators.skew``).
    """
    c = child.select(F.col(child_key), F.col(parent_fk).alias(parent_key))
    p = parent_area.select(parent_key, *area_cols).hint("shuffle_hash")
    joined = c.join(p, parent_key, how) if hot_rows is None else salted_join(c, p, parent_key, how, hot_rows, identity=[child_key])
    return joined.select(child_key, *area_cols)


def attach_area(
    facts: DataFrame,
    fk: str,
    area_map: DataFrame,
    key: str,
    area_cols: Sequence[str] = ("id_geo",),
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """Entity rows with their area columns (join on ``facts.fk = area_map.key``).

    ``hot_rows`` switches to a salted join for parents with more than that
    many rows in ``facts``.
    """
    if fk != key and key in facts.columns:
        m = area_map.select(F.col(key).alias(fk), *area_cols).hint("shuffle_hash")
        return facts.join(m, fk, how) if hot_rows is None else salted_join(facts, m, fk, how, hot_rows)
    # rename on the fact side: the map side stays the same plan wherever it
    # is used, so its shuffle can be reused across branches
    m = area_map.select(key, *area_cols).hint("shuffle_hash")
    f = facts.withColumnRenamed(fk, key)
    out = f.join(m, key, how) if hot_rows is None else salted_join(f, m, key, how, hot_rows)
    return out.withColumnRenamed(key, fk)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., n)``: key values of a dimension that stand on more than one row and would multiply counts."""
    found = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return found.where("n > 1")


def require_unique(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Raise if a dimension's key is not unique (one small aggregate a table; the first duplicates are named)."""
    for name, (df, keys) in tables.items():
        found = duplicate_keys(df, keys).limit(3).collect()
        if found:
            raise ValueError(f"{name}: duplicate keys {[tuple(r) for r in found]}")


def wide_codes(df: DataFrame, levels: Mapping[str, int]) -> DataFrame:
    """``(nivel, codigo, n)``: codes longer than their level's width, which the key holds whole."""
    both = [F.struct(F.lit(c).alias("nivel"), F.col(c).cast("string").alias("codigo"), F.lit(w).alias("ancho")) for c, w in levels.items()]
    out = df.select(F.explode(F.array(*both)).alias("x")).select("x.*").where(F.length("codigo") > F.col("ancho"))
    return out.groupBy("nivel", "codigo").agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, entity: str, area: str = "id_geo") -> DataFrame:
    """Share of entity rows that found an area: ``(entidad, pct, n)``."""
    return df.agg(
        F.round(F.avg(F.when(F.col(area).isNotNull(), 1.0).otherwise(0.0)) * 100, 2).alias("pct"),
        F.count(F.lit(1)).alias("n"),
    ).select(F.lit(entity).alias("entidad"), "pct", "n")


def crosswalk(
    df: DataFrame,
    mapping: DataFrame,
    on: str,
    drop_misses: bool = True,
) -> DataFrame:
    """Translate codes through a crosswalk; rows without a match are dropped.

    A left join followed by a NULL filter is an inner join, so that is what
    is planned; ``drop_misses=False`` keeps them with NULL codes.
    """
    m = bounded_broadcast(mapping)
    return df.join(m, on, "inner" if drop_misses else "left")


def label_areas(
    long: DataFrame,
    provinces: DataFrame,
    departments: DataFrame,
    missing: str = "Sin dato",
    repair_rules=None,
) -> DataFrame:
    """Attach province and department codes and names after aggregation.

    ``long`` carries ``id_geo``; the level codes are cut from the key.
    ``provinces`` is ``(idprov:int, nomprov)``; ``departments`` is
    ``(idprov:int, iddpto:int, nomdpto)`` and is matched on both codes.
    ``repair_rules`` (a rule set of ``functions.textfix``) repairs damaged
    names on the small dimensions, before the join, never on the counts.
    """
    if repair_rules is not None:
        from areatab.functions.textfix import repair

        provinces = provinces.withColumn("nomprov", repair("nomprov", repair_rules))
        departments = departments.withColumn("nomdpto", repair("nomdpto", repair_rules))
    out = long.withColumns(
        {
            "_prov": to_int(F.substring("id_geo", 1, 2)),
            "_dpto": to_int(F.substring("id_geo", 3, 3)),
            "valor_fraccion": F.substring("id_geo", 6, 2),
            "valor_radio": F.substring("id_geo", 8, 2),
        }
    )
    p = bounded_broadcast(provinces.select(F.col("idprov").alias("_prov"), F.col("nomprov").alias("etiqueta_provincia")))
    d = bounded_broadcast(
        departments.select(
            F.col("idprov").alias("_prov"), F.col("iddpto").alias("_dpto"), F.col("nomdpto").alias("_nomdpto")
        )
    )
    out = out.join(p, "_prov", "left").join(d, ["_prov", "_dpto"], "left")
    return out.withColumns(
        {
            "valor_provincia": format_code("_prov", 2),
            "valor_departamento": format_code("_dpto", 3),
            "etiqueta_departamento": F.coalesce(F.col("_nomdpto"), F.lit(missing)),
        }
    ).drop("_prov", "_dpto", "_nomdpto")
