"""Spans in texts: code point ranges with a kind, their digest columns and their replacement."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spark type of a list of spans; ``kind`` is the place in a list of kinds.
SPANS = "array<struct<start:int,kind:int,end:int>>"


def named(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


class Taken:
    """Whether a range overlaps any of some ``(start, kind, end)`` spans, sorted by start."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]
        self.reach = list(accumulate((e for _, _, e in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.reach[at - 1] > start


def replaced(text: str, spans: list[tuple[int, int, int]], with_: Callable[[int, str], str]) -> str:
    """The text with ``(start, kind, end)`` spans replaced; of overlapping ones the union, as the first."""
    out, at, open_ = [], 0, None
    for start, kind, end in sorted(spans):
        if open_ and start < open_[2]:
            open_ = (open_[0], open_[1], max(open_[2], end))
            continue
        if open_:
            out += [text[at : open_[0]], with_(open_[1], text[open_[0] : open_[2]])]
            at = open_[2]
        open_ = (start, kind, end)
    if open_:
        out += [text[at : open_[0]], with_(open_[1], text[open_[0] : open_[2]])]
        at = open_[2]
    return "".join([*out, text[at:]])
