"""Packing into windows by minimum bin slack.

A document's ids (and its end id) are cut at multiples of the window.  Full
pieces fill windows of their own; the remaining lengths, at most
``window - 1`` different ones, form a histogram.  Minimum bin slack runs on that
histogram, whose size does not grow with the corpus: the longest length
left opens a window, a bitset subset-sum over the other lengths (their counts
in binary parts) finds the filling closest to the capacity, the counts are read
back through the layers, and the pattern is repeated as often as the counts allow.
Lengths that leave more than ``slack`` ids empty are laid end to end and
cut at the window, so every window but the last is full up to ``slack``.

Each remaining piece finds its place from its rank among pieces of equal
length: a task numbers its own pieces, and the tasks' counts, summed up, give the
offset.  No length, however common, is gathered in one task.

Nulls and edges: a null or empty text is the end id alone; repeated rows are
packed each; a null ``doc_id`` stays null; an empty table gives no windows.
Other columns are not read, whatever their names; a very long text is tokenised in one step and cut
into pieces as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.llm.common import batch, keyed, prepare, text_slices, written
from cardrisk.llm.pretokens import PieceCache, Split, load_tokenizer, tokenizer_path

WINDOW, END_ID, SLACK = 1024, 0, 8
#: Sequence numbers of full pieces: this, the task and the piece's number in it.
FULL_BASE, TASK_SHIFT = 1 << 62, 36

_LOADED: dict = {}


def _cache(path: str) -> tuple[PieceCache, tuple[str, ...]]:
    if path not in _LOADED:
        t = load_tokenizer(path)
        _LOADED[path] = (PieceCache(t), tuple(a.content for a in t.get_added_tokens_decoder().values()))
    return _LOADED[path]


def tokenized(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """Cut documents: ``full`` has the whole pieces' ids, ``tail`` the rest (little-endian 32-bit)."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("task", pa.int64()), ("full_first", pa.int64()),
        ("full", pa.list_(pa.binary())), ("tail", pa.binary()), ("tail_tokens", pa.int32()), ("tail_rank", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        cache, specials = _cache(path)
        ranks, fulls, step = [0] * window, 0, 4 * window
        for b in batches:
            for lo, hi, _, _ in text_slices(b.column(1)):
                texts = b.column(1)[lo:hi].to_pylist()
                split = Split(texts, specials)
                ids, count = cache.encode(split)
                ends = np.concatenate([[0], np.cumsum(count)])[split.first]
                out = [[] for _ in schema]
                for i, text in enumerate(texts):
                    own = np.array(cache.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32) if split.odd[i] else ids[ends[i] : ends[i + 1]]
                    raw = np.append(own, np.uint32(end_id)).astype("<u4").tobytes()
                    n = len(raw) // 4
                    whole, rest = divmod(n, window)
                    pieces = [raw[k * step : (k + 1) * step] for k in range(whole)]
                    for column, value in zip(out, (n, task, fulls, pieces, raw[whole * step :], rest, ranks[rest])):
                        column.append(value)
                    fulls += whole
                    ranks[rest] += 1
                yield batch(schema, b.column(0)[lo:hi], *out[:7])

    kind = "doc_id bigint, doc_tokens bigint, task bigint, full_first bigint, full array<binary>, tail binary, tail_tokens int, tail_rank bigint"
    return keyed(docs).select("doc_id", "text").mapInArrow(run, kind)


def _filling(counts: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The multiset of lengths closest to ``room`` from below: its sum and its counts."""
    reach, layers = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(part, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & ((1 << (room + 1)) - 1)
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    best = at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(layers):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return best, used


def plan_windows(histogram: dict[int, int], window: int = WINDOW, slack: int = SLACK) -> tuple[list[tuple[int, dict[int, int]]], dict[int, int]]:
    """Patterns ``(repeats, {length: pieces})`` and the lengths left to be laid end to end."""
    left = {x: n for x, n in histogram.items() if n > 0}
    patterns, rest = [], {}
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        if not others[longest]:
            del others[longest]
        filled, used = _filling(others, window - longest)
        if longest + filled < window - slack:
            rest[longest] = left.pop(longest)
            continue
        used[longest] = used.get(longest, 0) + 1
        repeats = min(left[x] // n for x, n in used.items())
        patterns.append((repeats, used))
        for x, n in used.items():
            left[x] -= n * repeats
            if not left[x]:
                del left[x]
    return patterns, rest


def _places(histogram: dict[int, int], window: int, slack: int) -> tuple[list[tuple], int, int]:
    """Rows ``(length, from rank, to rank, pieces, first sequence, offset)``; pieces 0: laid end to end."""
    patterns, rest = plan_windows(histogram, window, slack)
    rows, ranks, sequences = [], dict.fromkeys(histogram, 0), 0
    for repeats, used in patterns:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.append((length, ranks[length], ranks[length] + n * repeats, n, sequences, offset))
            ranks[length] += n * repeats
            offset += n * length
        sequences += repeats
    stream = 0
    for length in sorted(rest, reverse=True):
        rows.append((length, ranks[length], ranks[length] + rest[length], 0, sequences, stream))
        stream += length * rest[length]
    return rows, sequences, stream


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, slack: int = SLACK) -> DataFrame:
    """Pieces in windows: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit.  Windows of remaining pieces are
    numbered from 0, those of a full piece from ``2**62``.
    """
    spark = prepare(docs.sparkSession)
    cut = written(tokenized(docs, path or tokenizer_path(), window, end_id), "packing-ids")

    full = cut.select("doc_id", "doc_tokens", "task", "full_first", F.posexplode("full").alias("k", "ids")).select(
        "doc_id", (F.col("k").cast("bigint") * window).alias("start"), F.lit(window).cast("bigint").alias("length"), "ids", "doc_tokens",
        (F.lit(FULL_BASE) + F.shiftleft("task", TASK_SHIFT) + F.col("full_first") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )

    tails = cut.filter(F.col("tail_tokens") > 0).drop("full", "full_first")
    counts = written(tails.groupBy("tail_tokens", "task").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("tail_tokens").agg(F.sum("n")).collect()}  # under `window` rows
    rows, _, _ = _places(histogram, window, slack)
    # at most a few rows for each length, whatever the corpus: safe to broadcast
    places = spark.createDataFrame(rows, "tail_tokens int, lo bigint, hi bigint, pieces bigint, first bigint, at bigint")
    before = F.sum("n").over(Window.partitionBy("tail_tokens").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("tail_tokens", "task", F.coalesce(before, F.lit(0)).alias("before"))

    ranked = tails.join(offsets, ["tail_tokens", "task"]).withColumn("rank", F.col("tail_rank") + F.col("before"))
    placed = ranked.join(F.broadcast(places), "tail_tokens").filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth, length = F.col("rank") - F.col("lo"), F.col("tail_tokens").cast("bigint")
    base = (F.col("doc_tokens") - length).alias("start")

    packed = placed.filter("pieces > 0").select(
        "doc_id", base, length.alias("length"), F.col("tail").alias("ids"), "doc_tokens",
        (F.col("first") + F.expr("(rank - lo) div pieces")).alias("sequence_id"),
        (F.col("at") + (nth % F.when(F.col("pieces") > 0, F.col("pieces"))) * length).alias("offset"),
    )
    # end to end: the piece covers [g, g + length) of a stream that is cut at every window
    laid = placed.filter("pieces = 0").withColumn("g", F.col("at") + nth * length).withColumn("w", F.explode(F.expr(f"sequence(g div {window}, (g + tail_tokens - 1) div {window})")))
    lo, hi = F.greatest(F.col("g"), F.col("w") * window), F.least(F.col("g") + length, (F.col("w") + 1) * window)
    laid = laid.withColumn("lo_", lo).withColumn("n_", hi - lo).select(
        "doc_id", (F.col("doc_tokens") - length + F.col("lo_") - F.col("g")).alias("start"), F.col("n_").alias("length"),
        F.expr("substring(tail, cast((lo_ - g) * 4 + 1 as int), cast(n_ * 4 as int))").alias("ids"), "doc_tokens",
        (F.col("first") + F.col("w")).alias("sequence_id"), (F.col("lo_") - F.col("w") * window).alias("offset"),
    )
    return full.unionByName(packed).unionByName(laid)
