"""Column functions for area codes and variable codes (all JVM-side).

Decisions from the survey: a composed key is NULL as soon as any part is
NULL (H2); codes are text and are always padded (H3); integer parsing never
raises, bad input gives NULL (F5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed widths of the published area key: province, department, fraction, radio.
AREA_WIDTHS = (2, 3, 2, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_text(c: Column | str) -> Column:
    """Category value as text. Integer and string inputs only (H7)."""
    return _col(c).cast("string")


def to_int(c: Column | str) -> Column:
    """Parse an integer; malformed input becomes NULL instead of failing."""
    return _try_int(_col(c))


def _try_int(c: Column) -> Column:
    return c.cast("string").try_cast("int")


def pad_code(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer inputs are cut to ``width``."""
    return F.lpad(to_text(c), width, "0")


def widen_code(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to at least ``width``; longer codes stay whole."""
    text = to_text(c)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def format_code(c: Column | str, width: int) -> Column:
    """Zero-pad an integer code without truncation; NULL stays NULL."""
    v = _try_int(_col(c))
    return F.when(v.isNotNull(), F.format_string(f"%0{width}d", v))


def area_key(*parts: Column | str, widths: tuple[int, ...] = AREA_WIDTHS, cut: bool = True) -> Column:
    """Compose the area key from its level codes, padding each level.

    ``cut=False`` keeps codes wider than their level whole, so areas of a level
    that outgrew its width never merge.
    ``concat`` yields NULL if any part is NULL, which is the chosen rule for
    broken hierarchies: a radio with a missing parent has no key.
    """
    if len(parts) != len(widths):
        raise ValueError(f"expected {len(widths)} parts, got {len(parts)}")
    pad = pad_code if cut else widen_code
    return F.concat(*[pad(p, w) for p, w in zip(parts, widths)])


def split_area_key(key: Column | str, widths: tuple[int, ...] = AREA_WIDTHS) -> list[Column]:
    """Inverse of :func:`area_key`: the level codes as substrings."""
    out, pos = [], 1
    for w in widths:
        out.append(F.substring(_col(key), pos, w))
        pos += w
    return out


def variable_code(entity: Column | str, name: Column | str) -> Column:
    """``ENTITY_NAME`` variable code, upper-cased. Strings are literals."""
    e = F.lit(entity) if isinstance(entity, str) else entity
    n = F.lit(name) if isinstance(name, str) else name
    return F.upper(F.concat_ws("_", e, n))


def code_entity(code: Column | str) -> Column:
    """Entity part of a variable code (text before the first ``_``)."""
    return F.split_part(_col(code), F.lit("_"), F.lit(1))


def code_name(code: Column | str) -> Column:
    """Second ``_``-separated part of a variable code.

    Mirrors the published metadata: names containing ``_`` are cut (H10).
    """
    return F.split_part(_col(code), F.lit("_"), F.lit(2))
