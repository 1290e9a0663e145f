"""Queries users run on the published long and metadata tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areatab.functions.codes import code_entity, code_name


def distinct_variables(metadata: DataFrame) -> DataFrame:
    """``SELECT DISTINCT codigo_variable, etiqueta_variable ORDER BY codigo_variable``."""
    return metadata.select("codigo_variable", "etiqueta_variable").distinct().orderBy("codigo_variable")


def categories_per_variable(metadata: DataFrame) -> DataFrame:
    """Categories per variable, most first (code breaks ties)."""
    return (
        metadata.groupBy("codigo_variable", "etiqueta_variable")
        .agg(F.count(F.lit(1)).alias("num_categories"))
        .orderBy(F.desc("num_categories"), "codigo_variable")
    )


def preview(long: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows by a total order (an unordered LIMIT is not reproducible)."""
    return long.orderBy("id_geo", "codigo_variable", "valor_categoria").limit(n)


def variable_slice(long: DataFrame, code: str) -> DataFrame:
    """Rows of one variable (prunes partitions on a per-variable layout)."""
    return long.filter(F.col("codigo_variable") == F.lit(code))


def join_geometry(long: DataFrame, tracts: DataFrame, key: str = "id_geo") -> DataFrame:
    """Counts joined to tract geometry on the area key (inner)."""
    return long.join(tracts, key, "inner")


BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


def in_window(window: tuple[float, float, float, float]) -> Column:
    """Whether a row's box meets ``window`` (west, south, east, north; borders count).

    A window whose west is greater than its east passes the antimeridian.
    """
    west, south, east, north = window
    along = (F.col("max_lon") >= west) & (F.col("min_lon") <= east)
    if west > east:
        along = (F.col("max_lon") >= west) | (F.col("min_lon") <= east)
    return along & (F.col("max_lat") >= south) & (F.col("min_lat") <= north)


def join_geometry_late(
    long: DataFrame, layer: DataFrame, key: str = "id_geo", geometry: str = "geometry", window: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Counts joined to an area layer whose geometry is fetched last, for the areas that are left.

    The layer has a row for each area: the key, its box (``min_lon`` ...
    ``max_lat``) and the geometry. Counts meet keys and boxes only, the
    ``window`` (see :func:`in_window`) drops areas by their boxes, and a second
    join fetches the geometry column of the keys that survive: geometry crosses
    one exchange, once for each such area, and not at all for the others. Counts
    without an area, areas without counts and NULL keys drop out (inner).
    """
    boxes = layer.select(key, *BOX)
    if window is not None:
        boxes = boxes.where(in_window(window))
    met = long.join(boxes, key)
    # the layer's keys stand once, so the semi-join's side is one row an area however many counts it has
    left = met.select(key).distinct()
    shapes = layer.select(key, geometry).where(F.col(key).isNotNull()).join(left, key, "left_semi")
    return met.join(shapes, key)


def variable_catalog(long: DataFrame) -> DataFrame:
    """``(entidad, nombre_variable, codigo_variable)`` of the variables present."""
    codes = long.select("codigo_variable").distinct()
    return codes.select(
        code_entity("codigo_variable").alias("entidad"),
        code_name("codigo_variable").alias("nombre_variable"),
        "codigo_variable",
    )


def duplicate_names(catalog: DataFrame) -> DataFrame:
    """Catalog rows whose name is used by more than one entity, by name, entity.

    Group size comes from an aggregate joined back on the name (both sides
    are one row per variable), not from a window over the name.
    """
    sizes = catalog.groupBy("nombre_variable").agg(F.count(F.lit(1)).alias("_n"))
    dup = catalog.join(sizes.filter(F.col("_n") > 1), "nombre_variable").drop("_n")
    return dup.select("nombre_variable", "entidad", "codigo_variable").orderBy("nombre_variable", "entidad")
