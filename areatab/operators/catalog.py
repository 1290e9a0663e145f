"""Variable discovery from schemas (driver-side; a schema is metadata, not data).

The set of variables of an entity is its column list minus area and key
columns. Two exclusion styles exist: an exact name set, and a list of
unanchored regular expressions tested against the original names (optionally
lower-cased first). Spark resolves names case-insensitively, so the test runs
on the original strings and the selection uses the exact names (H15).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def variables_excluding_names(columns: Sequence[str], exclude: Iterable[str]) -> list[str]:
    """Columns not in ``exclude`` (exact, case-sensitive), in schema order."""
    ex = set(exclude)
    return [c for c in columns if c not in ex]


def variables_excluding_patterns(columns: Sequence[str], patterns: Sequence[str], lower: bool = False) -> list[str]:
    """Columns matching none of the unanchored ``patterns``.

    With ``lower=True`` names are lower-cased before testing (patterns are
    applied as given).
    """
    rx = re.compile("|".join(f"(?:{p})" for p in patterns)) if patterns else None
    out = []
    for c in columns:
        name = c.lower() if lower else c
        if rx is None or not rx.search(name):
            out.append(c)
    return out


def catalog(spark: SparkSession, entities: dict[str, Sequence[str]]) -> DataFrame:
    """``(entidad, nombre_variable, codigo_variable)`` for variable lists per entity."""
    rows = [(e.upper(), v, f"{e.upper()}_{v.upper()}") for e, vs in entities.items() for v in vs]
    return spark.createDataFrame(rows, "entidad string, nombre_variable string, codigo_variable string")


def variables_of(df: DataFrame, exclude_names: Iterable[str] = (), exclude_patterns: Sequence[str] = (),
                 lower: bool = False) -> list[str]:
    """Variables of an entity frame by both exclusion rules."""
    cols = variables_excluding_names(df.columns, exclude_names)
    return variables_excluding_patterns(cols, exclude_patterns, lower)
