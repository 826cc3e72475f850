"""Time-range window features: per-customer spending, per-terminal delayed risk.

A rolling ``N``-day window is the left-open frame ``(t - N d, t]``; it is a
``RANGE`` frame over the transaction time in microseconds, so membership is
decided to the microsecond.  The delayed terminal window ``(t-(d+N), t-d]`` is
one frame as well.  No self-join.  By default a frame is computed as the
difference of two growing frames (rows up to ``t - upper`` minus rows up to
``t - lower``), which Spark evaluates incrementally in one sweep of the sorted
partition: linear cost, where a sliding frame costs rows x frame width.

Hot keys.  A window partitions by its key; a single key holding a large share
of all rows would be one task.  ``block_days='auto'`` probes the data for keys
above ``HOT_KEY_ROWS`` rows.  Every frame is a difference of sums up to the
points ``t - edge``, so a hot key's rows become events on its time axis: its
values at ``t`` and one query at ``t - edge`` for each frame edge.  The axis is cut
into cells of at most ``HOT_KEY_ROWS`` events (a cell above that is cut again by
its own density), each cell is one window, and the sum before it comes from the
running totals of the cells.  Rows are copied once for each edge whatever
the look-back, and no cell depends on it.  Keys that are not hot keep
the plain windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.schema import (
    CUSTOMER_ID,
    D,
    RISK_DELAY_DAYS,
    TERMINAL_ID,
    TRANSACTION_ID,
    TX_AMOUNT,
    TX_DATETIME,
    TX_FRAUD,
    US,
    WINDOWS_DAYS,
    customer_avg_col,
    customer_count_col,
    terminal_count_col,
    terminal_risk_col,
)
from cardrisk.session import cut_lineage

BLOCK = "_blk"


def with_us(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    """Add the microsecond order key if it is missing."""
    if US in df.columns:
        return df
    return df.withColumn(US, F.unix_micros(F.col(ts).cast("timestamp")))


def _floor_div(x: Column, n) -> Column:
    """Exact floor division for longs below 2**53 (also before 1970); ``n`` a number or a column."""
    nc = n if isinstance(n, Column) else F.lit(n)
    return ((x - F.pmod(x, nc)) / nc).cast("bigint")


BLEN = "_blen"  # length in microseconds of the row's first cell or block (NULL: key not split)

# Rows of one key that a single window task handles comfortably; a key with
# more rows is hot and its time axis is cut.
HOT_KEY_ROWS = 5_000_000


@dataclass(frozen=True)
class Blocks:
    """How the time axis of a key column is cut.

    ``uniform_us`` cuts every key into blocks of that length; ``hot`` is a table
    ``_val, _len`` of the hot keys (as text) with a block length for each, and every
    other key stays whole.  No block holds more than about ``max_rows``.
    """

    uniform_us: int | None = None
    hot: DataFrame | None = None
    max_rows: int = HOT_KEY_ROWS


def with_block_length(df: DataFrame, key: str, blocks: Blocks) -> DataFrame:
    """Add ``_blen``: a literal for uniform blocks, a lookup for hot keys."""
    if blocks.uniform_us is not None:
        return df.withColumn(BLEN, F.lit(blocks.uniform_us).cast("bigint"))
    table = blocks.hot.select(F.col("_val").cast(df.schema[key].dataType).alias(key), F.col("_len").alias(BLEN))
    return df.join(table, key, "left")


# Probe results per input plan.  A probe only chooses between exact
# strategies, so a stale entry (data changed under the same plan) costs
# speed, never correctness.
_PROBES: dict[tuple, dict[str, Blocks | None]] = {}
_PROBE_CACHE_SIZE = 64


def probe_hot_keys(df: DataFrame, lookbacks: dict[str, int], max_rows: int = HOT_KEY_ROWS) -> dict[str, Blocks | None]:
    """Blocks per key column (None: no hot key), memoized per input plan (see ``_probe``)."""
    try:
        ck = (df.semanticHash(), tuple(sorted(lookbacks.items())), max_rows)
    except Exception:  # noqa: BLE001  (plans without a semantic hash)
        return _probe(df, lookbacks, max_rows)
    if ck not in _PROBES:
        if len(_PROBES) >= _PROBE_CACHE_SIZE:
            _PROBES.pop(next(iter(_PROBES)))
        _PROBES[ck] = _probe(df, lookbacks, max_rows)
    return dict(_PROBES[ck])


def forget_probes() -> None:
    """Probe anew from now on (for timing a query as a first run)."""
    _PROBES.clear()


def _probe(df: DataFrame, lookbacks: dict[str, int], max_rows: int) -> dict[str, Blocks | None]:
    """Hot values per key column with their block lengths.

    One pass for all key columns: each row is expanded to (column, value)
    pairs, counted with partial aggregation before the shuffle.  The hot values (at
    most rows / max_rows for a column) stay a table; only whether there are any is asked.
    A block gets half of ``max_rows`` rows if they are spread evenly.
    """
    d = with_us(df)
    pairs = F.array(*[F.struct(F.lit(k).alias("col"), F.col(k).cast("string").alias("val")) for k in lookbacks])
    counts = (
        d.select(F.col(US), F.inline(pairs))
        .filter(F.col("val").isNotNull())
        .groupBy("col", "val")
        .agg(F.count(F.lit(1)).alias("n"), F.min(US).alias("lo"), F.max(US).alias("hi"))
        .filter(F.col("n") > max_rows)
    )
    # a double holds any span; the length only balances the cells
    length = F.greatest((F.col("hi") - F.col("lo") + 1).cast("double") * max_rows / (F.col("n") * 2), F.lit(1.0)).cast("bigint")
    hot = cut_lineage(counts.select("col", F.col("val").alias("_val"), length.alias("_len")))
    found = {r[0] for r in hot.select("col").distinct().collect()}  # at most one row for each key column
    return {k: Blocks(hot=hot.filter(F.col("col") == k).drop("col"), max_rows=max_rows) if k in found else None for k in lookbacks}


def probe_hot_key(df: DataFrame, key: str, lookback_us: int, max_rows: int = HOT_KEY_ROWS) -> Blocks | None:
    return probe_hot_keys(df, {key: lookback_us}, max_rows)[key]


def resolve_blocks(lookback_us: int, block_days, df: DataFrame | None = None, key: str | None = None) -> Blocks | None:
    """Resolve ``block_days``: None (key only), a number of days (uniform blocks),
    'auto' (probe the data for hot keys), 'always' (blocks of the look-back) or a ``Blocks``."""
    if block_days is None or isinstance(block_days, Blocks):
        return block_days
    if block_days == "always":
        return Blocks(uniform_us=max(lookback_us, D))
    if block_days == "auto":
        if df is None or df.isStreaming:
            return None
        return probe_hot_key(df, key, lookback_us)
    return Blocks(uniform_us=int(block_days) * D)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    # pandas groupby drops rows with a null key; a frame needs a time.
    return with_us(df).filter(F.col(key).isNotNull() & F.col(US).isNotNull())


def point_cells(points: DataFrame, key: str, values: Sequence[str], edges: Sequence[int], max_rows: int) -> DataFrame:
    """Events of a key's time axis in cells of at most ``max_rows``: ``key, _tau, _edge, _at, _cell, _len, values``.

    ``points`` has one row for each (key, time) with its values and first cell length.
    Event ``_edge`` -1 carries the values at their time; event ``k`` asks for the sum up to
    ``edges[k]`` before the time ``_at``.
    """
    own = [F.col(v) for v in values]
    none = [F.lit(None).cast(points.schema[v].dataType).alias(v) for v in values]
    event = [F.struct(F.col(US).alias("_tau"), F.lit(-1).alias("_edge"), *own)]
    event += [F.struct((F.col(US) - e).alias("_tau"), F.lit(k).alias("_edge"), *none) for k, e in enumerate(edges)]
    events = points.select(key, F.col(US).alias("_at"), F.col(BLEN).alias("_len"), F.inline(F.array(*event)))
    events = events.withColumn("_cell", _floor_div(F.col("_tau"), F.col("_len")) * F.col("_len"))
    while True:
        counts = events.groupBy(key, "_cell", "_len").agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > max_rows) & (F.col("_len") > 1))
        finer = F.greatest(F.floor(F.col("_len").cast("double") * max_rows / (F.col("_n") * 2)), F.lit(1)).cast("bigint")
        dense = cut_lineage(counts.select(key, "_cell", "_len", finer.alias("_finer")))
        if dense.isEmpty():
            return events
        split = events.join(dense, [key, "_cell", "_len"], "left")
        inside = F.col("_tau") - F.col("_cell")
        cell = F.col("_cell") + _floor_div(inside, F.col("_finer")) * F.col("_finer")
        events = cut_lineage(split.withColumn("_cell", F.coalesce(cell, F.col("_cell"))).withColumn("_len", F.coalesce("_finer", "_len")).drop("_finer"))


def point_sums(hot: DataFrame, key: str, aggs: dict[str, Column], edges: Sequence[int], max_rows: int) -> DataFrame:
    """``key, us`` and, for every value ``v`` and edge ``e``, ``v_e``: the sum of ``v`` up to the time ``us - e``."""
    names = list(aggs)
    points = hot.groupBy(key, US, BLEN).agg(*[c.alias(n) for n, c in aggs.items()])
    events = cut_lineage(point_cells(points, key, names, edges, max_rows))
    # one row for each cell: rows / max_rows of them for a key
    totals = events.groupBy(key, "_cell").agg(*[F.sum(n).alias(f"_t_{n}") for n in names])
    before = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(key, "_cell", *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in names])
    inside = Window.partitionBy(key, "_cell").orderBy("_tau", "_edge").rowsBetween(Window.unboundedPreceding, 0)
    asked = events.withColumns({f"_i_{n}": F.sum(n).over(inside) for n in names}).filter("_edge >= 0")
    asked = asked.join(totals, [key, "_cell"])
    total = {n: F.coalesce(F.col(f"_b_{n}"), F.lit(0)) + F.coalesce(F.col(f"_i_{n}"), F.lit(0)) for n in names}
    return asked.groupBy(key, F.col("_at").alias(US)).agg(
        *[F.max(F.when(F.col("_edge") == k, total[n])).alias(f"{n}_{e}") for n in names for k, e in enumerate(edges)]
    )


def _split_hot(base: DataFrame, key: str, blocks: Blocks) -> tuple[DataFrame | None, DataFrame]:
    """(rows of keys that stay whole, rows of keys that are cut), the input read once."""
    if blocks.uniform_us is not None:
        return None, with_block_length(base, key, blocks)
    marked = cut_lineage(with_block_length(base, key, blocks))
    return marked.filter(F.col(BLEN).isNull()).drop(BLEN), marked.filter(F.col(BLEN).isNotNull())


def money(col: str, amount_scale: int | None) -> Column:
    """Money column for exact sums: decimal(18, scale), or the plain column.

    A value with more digits than the scale is an error, not rounded.
    """
    c = F.col(col)
    if amount_scale is None:
        return c
    x = c.cast(f"decimal(18,{amount_scale})")
    said = F.concat(F.lit(f"{col} has more than {amount_scale} decimal digits: "), c.cast("string"))
    return F.when(c.isNull() | (x.cast("double") == c.cast("double")), x).otherwise(F.raise_error(said).cast(f"decimal(18,{amount_scale})"))


def _prefix_frame(w, upper_us: int):
    """Growing frame: every row with time <= t - upper_us (peers included when upper is 0)."""
    return w.rangeBetween(Window.unboundedPreceding, -upper_us if upper_us else Window.currentRow)


def frame_agg(agg, w, lower_us: int, upper_us: int, strategy: str, zero):
    """Aggregate over the time frame ``(t - lower_us, t - upper_us]``.

    ``strategy='prefix'`` takes the difference of two growing frames; Spark
    evaluates a growing frame incrementally, so the cost is linear in the
    partition whatever the frame width (exact for counts and decimal sums).
    ``strategy='sliding'`` is the direct frame, re-aggregated as it slides
    (cost rows x frame rows).
    """
    if strategy == "sliding":
        return agg.over(w.rangeBetween(-lower_us + 1, -upper_us if upper_us else Window.currentRow))
    hi = agg.over(_prefix_frame(w, upper_us))
    lo = agg.over(_prefix_frame(w, lower_us))
    return hi - F.coalesce(lo, zero)


def customer_spending(
    df: DataFrame,
    windows: Sequence[int] = WINDOWS_DAYS,
    key: str = CUSTOMER_ID,
    amount: str = TX_AMOUNT,
    amount_scale: int | None = 2,
    ties: str = "peer",
    block_days: int | str | None = "auto",
    strategy: str = "prefix",
) -> DataFrame:
    """Rolling count of non-null amounts and mean amount per key over ``N``-day windows.

    ``ties='peer'`` is the SQL rule: a frame ends at the last row with the same
    time.  ``ties='row'`` ends it at the current row in (time, TRANSACTION_ID)
    order, the rule of a row-wise rolling window: the later peers' values are
    subtracted, which keeps one shuffle (a (key, time) window is satisfied by
    the key's partitioning).  Plain sums (``amount_scale=None``) take sliding
    frames and leave every key whole: differences of double prefix sums cancel.
    """
    if ties not in ("peer", "row"):
        raise ValueError("ties must be 'peer' or 'row'")
    if amount_scale is None:
        strategy, block_days = "sliding", None
    base = _keyed(df, key)
    blocks = resolve_blocks(max(windows) * D, block_days, base, key)
    x = money(amount, amount_scale)
    zero = F.lit(0).cast(tot_type(amount_scale))
    later = Window.partitionBy(key, US).orderBy(TRANSACTION_ID).rowsBetween(1, Window.unboundedFollowing)

    def features(frame) -> dict[str, Column]:
        cols = {}
        for n in windows:
            cnt, tot = frame(n, F.count(amount), F.lit(0)), frame(n, F.sum(x), zero)
            if ties == "row":
                cnt = cnt - F.count(amount).over(later)
                tot = tot - F.coalesce(F.sum(x).over(later), zero)
            cols[customer_count_col(n)] = cnt
            cols[customer_avg_col(n)] = F.try_divide(tot.cast("double"), cnt)
        return cols

    def plain(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(US)
        return d.withColumns(features(lambda n, agg, nil: frame_agg(agg, w, n * D, 0, strategy, nil)))

    if blocks is None:
        return plain(base)
    whole, hot = _split_hot(base, key, blocks)
    sums = point_sums(hot, key, {"_n": F.count(amount), "_x": F.sum(x)}, [0, *[n * D for n in windows]], blocks.max_rows)
    out = hot.join(sums, [key, US])
    out = out.withColumns(features(lambda n, agg, nil: F.col("_x_0") - F.col(f"_x_{n * D}") if nil is zero else F.col("_n_0") - F.col(f"_n_{n * D}")))
    out = out.drop(BLEN, *[c for c in sums.columns if c.startswith(("_n_", "_x_"))])
    return out if whole is None else plain(whole).unionByName(out)


def tot_type(amount_scale: int | None) -> str:
    return "double" if amount_scale is None else f"decimal(28,{amount_scale})"


def terminal_risk(
    df: DataFrame,
    delay: int = RISK_DELAY_DAYS,
    windows: Sequence[int] = WINDOWS_DAYS,
    key: str = TERMINAL_ID,
    label: str = TX_FRAUD,
    block_days: int | str | None = "auto",
    strategy: str = "prefix",
) -> DataFrame:
    """Delayed fraud count and share per key over ``(t-(delay+N) d, t-delay d]``.

    The share is 0 when the frame holds no labelled row.  Ties cancel in a
    delayed frame, so no tie rule is needed.
    """
    base = _keyed(df, key)
    blocks = resolve_blocks((delay + max(windows)) * D, block_days, base, key)

    def features(count, frauds) -> dict[str, Column]:
        cols = {}
        for n in windows:
            cols[terminal_count_col(n)] = count(n)
            cols[terminal_risk_col(n)] = F.coalesce(F.try_divide(frauds(n).cast("double"), count(n)), F.lit(0.0))
        return cols

    def plain(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(US)
        return d.withColumns(features(
            lambda n: frame_agg(F.count(label), w, (delay + n) * D, delay * D, strategy, F.lit(0)),
            lambda n: frame_agg(F.sum(label), w, (delay + n) * D, delay * D, strategy, F.lit(0).cast("bigint")),
        ))

    if blocks is None:
        return plain(base)
    whole, hot = _split_hot(base, key, blocks)
    sums = point_sums(hot, key, {"_n": F.count(label), "_y": F.sum(label)}, [delay * D, *[(delay + n) * D for n in windows]], blocks.max_rows)
    out = hot.join(sums, [key, US]).withColumns(features(
        lambda n: F.col(f"_n_{delay * D}") - F.col(f"_n_{(delay + n) * D}"),
        lambda n: F.col(f"_y_{delay * D}") - F.col(f"_y_{(delay + n) * D}"),
    ))
    out = out.drop(BLEN, *[c for c in sums.columns if c.startswith(("_n_", "_y_"))])
    return out if whole is None else plain(whole).unionByName(out)
