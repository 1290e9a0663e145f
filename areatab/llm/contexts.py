"""Windows of a fixed length that recur anywhere: anchors and contexts.

Every window of ``length`` units picks its anchor, the run of ``gram`` units of
least hash inside it (the leftmost of equals). Equal windows pick equal anchors,
so windows can only recur where an anchor recurs, and the few anchors, not the
windows, meet in a shuffle. The windows that share one anchor form a context:
the units from the first window's start to the last one's end. Contexts of equal
content are counted and go on as one row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import BASES, meet, ranges_hash, written

#: Positions dealt with at once; the place of a unit takes 24 bits beside its hash.
PIECE = 1 << 23


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """A well mixed 64-bit hash of each run of ``gram`` units."""
    n = len(units) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    start = np.arange(n)
    out = ranges_hash(units, start, start + gram)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values."""
    n = len(x) - width + 1
    pad = -len(x) % width
    rows = np.r_[x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)].reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Contexts:
    """Of each context: its text, its anchor's place, its first and last window, and two hashes."""

    text: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def contexts(units: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Contexts:
    """Contexts of all texts (``offsets``: where each begins, and the end); places count from the text's start."""
    found = []
    width = length - gram + 1
    n_windows = np.maximum(np.diff(offsets) - length + 1, 0)
    # whole texts together as long as they fit in a piece, longer ones in pieces that overlap by a window
    start = 0
    while start < len(n_windows):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PIECE, "right")) - 1)
        if stop == start + 1:
            for w0 in range(0, int(n_windows[start]), PIECE):
                lo = int(offsets[start]) + w0
                found.append(_piece(units, lo, min(lo + PIECE + length - 1, int(offsets[start + 1])), offsets, width, gram, length))
        else:
            found.append(_piece(units, int(offsets[start]), int(offsets[stop]), offsets, width, gram, length))
        start = stop
    parts = [np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
    place, first, last, anchor = parts
    text = np.searchsorted(offsets, first, "right") - 1
    content = ranges_hash(units, first, last + length, BASES[1])
    content = (content ^ (place - first).astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
    base = offsets[text]
    return Contexts(text, place - base, first - base, last - base, anchor.view(np.int64), content.view(np.int64))


def _piece(units: np.ndarray, lo: int, hi: int, offsets: np.ndarray, width: int, gram: int, length: int) -> tuple[np.ndarray, ...]:
    h = gram_hashes(units[lo:hi], gram)
    if len(h) < width:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    keyed = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    place = (sliding_min(keyed, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
    starts = np.arange(len(place))
    ends = offsets[np.searchsorted(offsets, starts + lo, "right")]
    inside = np.flatnonzero(starts + lo + length <= ends)  # windows that don't leave their text
    place = place[inside]
    if not len(place):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (np.diff(inside) != 1)])
    last = np.r_[new[1:], len(place)] - 1
    return place[new] + lo, inside[new] + lo, inside[last] + lo, h[place[new]]


CONTEXT_FIELDS = "key long, place int, first int, last int, anchor long, content long"


def recurring(found: DataFrame, name: str) -> DataFrame:
    """Contents whose anchor recurs: (anchor, content, n, kinds, key, place, first, last).

    ``n``: how often the content occurs; ``kinds``: contents of its anchor; the
    rest is one place where it stands, the only one if ``n`` is 1.
    """
    one = F.struct("key", "place", "first", "last")
    contents = written(found.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(one).alias("at")), f"{name}-contents")
    anchors = contents.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    return written(meet(contents, anchors, "anchor").select("anchor", "content", "n", "kinds", "at.*"), f"{name}-recurring")
