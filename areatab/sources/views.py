"""Registering frames as SQL views, and the published-data SQL recipes.

Users of the published tables mostly write SQL. Registering the long table,
the metadata table and the tract table as temporary views lets the same
recipes run on Spark SQL (planned by Catalyst like any DataFrame query).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register(tables: Mapping[str, DataFrame]) -> None:
    """``createOrReplaceTempView`` for each named frame."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# Recipes over views named ``largo``, ``metadatos`` and ``radios``.
RECIPES = {
    "variables": """
        SELECT DISTINCT codigo_variable, etiqueta_variable FROM metadatos ORDER BY codigo_variable""",
    "categories_per_variable": """
        SELECT codigo_variable, etiqueta_variable, count(*) AS num_categories
        FROM metadatos GROUP BY codigo_variable, etiqueta_variable
        ORDER BY num_categories DESC, codigo_variable""",
    "row_counts": """
        SELECT 'metadatos' AS file, count(*) AS row_count FROM metadatos
        UNION ALL SELECT 'largo', count(*) FROM largo
        UNION ALL SELECT 'radios', count(*) FROM radios""",
    "join_geometry": """
        SELECT g.id_geo, g.lon, g.lat, c.codigo_variable, c.valor_categoria, c.etiqueta_categoria, c.conteo
        FROM radios g JOIN largo c ON g.id_geo = c.id_geo
        WHERE c.codigo_variable = :code""",
}


def recipe(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run a named recipe with named parameters (no string interpolation)."""
    return spark.sql(RECIPES[name], args=params or None)
