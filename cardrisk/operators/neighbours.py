"""Exact k nearest neighbours of every row, as a distributed join (2.K K4).

Distances are Euclidean over double columns, summed column by column, ties by id.

Equal vectors are one: of their rows only the k + 1 of the smallest ids can be anyone's neighbours, so a large group of
equal rows costs no more than one vector, and its rows get their list back at the end.

1. A bounded sample of vectors are pivots (broadcast); every vector belongs to its nearest pivot's cell.  Some of the
   pivots stand for those around them, so a vector is compared with the pivots near its own alone.
2. Cells are cut by distance from the pivot, and by hash where that isn't enough, into blocks of ``block`` vectors at most,
   cut cells into blocks of about a ``RINGS_PER_BLOCK``-th.
   The list of blocks (pivot, least and greatest distance) has at most some ``MAX_BLOCKS`` entries and is broadcast.
3. Each block is searched by itself, which gives its vectors an upper bound of their k-th distance; a block
   of enough vectors bounds it as well, by the distance to its pivot and its greatest distance.
4. By the triangle inequality a vector needs another block only if the block's distances from its pivot overlap the
   vector's distance from that pivot give or take the bound.  The ball around ``STEP`` vectors rules most blocks out for
   all of them at once, and each of them looks at the rest.  Vectors are joined with the blocks left alone;
   blocks that many vectors need are copied for parts of them, so no task holds more than about ``block * PER_BLOCK`` of them.
5. The best of every vector's blocks are merged.

Nothing is approximate: pivots and bounds only decide what need not be looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.session import cut_lineage, passing_scratch, scratch_path, ship_package, shuffles_dropped, written

BLOCK, PIVOTS, MAX_BLOCKS = 1024, 4096, 1 << 18
#: Distance quantiles that a large cell is cut at, and vectors per block's copy as a multiple of the block size.
RINGS, PER_BLOCK = 32, 16
RINGS_PER_BLOCK = 4
#: Blocks that some vectors take their first bound from, and blocks that a task searches by themselves.
NEAR, PER_TASK = 16, 64
#: Queries that one numpy step compares with a block.
STEP = 256
#: Bounds are widened by this share against rounding.
SLACK = 1e-9
#: Vectors of over one row in so many are joined to their rows by broadcast (so under that many of them).
HOT = 1024
NO_ID = np.iinfo(np.int64).max


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``, summed column by column from the first."""
    out = np.zeros((len(a), len(b)))
    for f in range(a.shape[1]):
        d = a[:, f, None] - b[None, :, f]
        out += d * d
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _best(d: np.ndarray, first: np.ndarray, row: np.ndarray, k: int, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """For every query the positions of its ``k`` nearest by (distance, id, row), within its bound: ``query, position``."""
    n = d.shape[1]
    cut = np.partition(d, k - 1, axis=1)[:, k - 1] if k < n else np.full(len(d), np.inf)
    if bound is not None:
        cut = np.minimum(cut, bound)
    q, at = np.nonzero(d <= cut[:, None])
    order = np.lexsort((row[at], first[at], d[q, at], q))
    q, at = q[order], at[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return q[rank < k], at[rank < k]


_FOUND = "vid bigint, other bigint, d2 double, first bigint, row bigint"
_FOUND_ARROW = pa.schema([("vid", pa.int64()), ("other", pa.int64()), ("d2", pa.float64()), ("first", pa.int64()), ("row", pa.int64())])


def _search(q_vid, q, m_vid, m, m_first, m_row, k, bound=None) -> Iterator[list]:
    for lo in range(0, len(q), STEP):
        d = squared(q[lo : lo + STEP], m)
        who, at = _best(d, m_first, m_row, k, None if bound is None else bound[lo : lo + STEP])
        yield [q_vid[lo + who], m_vid[at], d[who, at], m_first[at], m_row[at]]


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``vid, v, members``: every different vector with the ``keep`` smallest of its rows as ``(first, row)``."""
    w = Window.partitionBy("v").orderBy("first", "row")
    few = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= keep)
    found = few.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("first", "row"))).alias("members"))
    return written(found.withColumn("vid", F.monotonically_increasing_id()), "knn-vectors")


def _nearest_pivots(v: np.ndarray, p: np.ndarray, tops: np.ndarray, order: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest pivot (the first of equals) and its squared distance.

    ``order`` and ``gaps``: for each of the ``tops``, which are pivots, all pivots by distance from it, and these distances.
    A pivot nearer than the nearest top is at most twice as far from that top as the vector is.
    """
    cell, d2 = np.zeros(len(v), "int64"), np.zeros(len(v))
    own, away = np.zeros(len(v), "int64"), np.zeros(len(v))
    for lo in range(0, len(v), STEP):
        d = squared(v[lo : lo + STEP], tops)
        own[lo : lo + STEP], away[lo : lo + STEP] = d.argmin(1), np.sqrt(d.min(1))
    by = np.lexsort((away, own))
    edges = np.searchsorted(own[by], np.arange(len(tops) + 1))
    for t in np.unique(own).tolist():
        for lo in range(edges[t], edges[t + 1], STEP // 4):
            rows = by[lo : min(lo + STEP // 4, edges[t + 1])]
            reach = 2 * away[rows[-1]] * (1 + SLACK) + SLACK * gaps[t, -1]
            near = np.sort(order[t, : np.searchsorted(gaps[t], reach, side="right")])
            d = squared(v[rows], p[near])
            cell[rows], d2[rows] = near[d.argmin(1)], d.min(1)
    return cell, d2


def cells(vectors: DataFrame, n: int, pivots: int, width: int) -> tuple[DataFrame, np.ndarray]:
    """Every vector's nearest pivot and its distance from it; the pivots."""
    chosen = vectors.filter(F.pmod(F.xxhash64("vid"), F.lit(n)) < pivots).select("v").collect() or vectors.select("v").limit(1).collect()
    points = np.array([r["v"] for r in chosen])
    tops = points[: -(-len(points) // max(1, round(len(points) ** 0.5)))]
    gaps = np.sqrt(squared(tops, points))
    order = np.argsort(gaps, axis=1, kind="stable")
    shared = vectors.sparkSession.sparkContext.broadcast((points, tops, order, np.take_along_axis(gaps, order, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, tops, order, gaps = shared.value
        for b in batches:
            cell, d2 = _nearest_pivots(_matrix(b.column(1), width), p, tops, order, gaps)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(np.sqrt(d2))], names=["vid", "v", "first", "row", "cell", "d"])

    source = vectors.select("vid", "v", F.col("members")[0]["first"].alias("first"), F.col("members")[0]["row"].alias("row"))
    found = source.mapInArrow(run, "vid bigint, v array<double>, first bigint, row bigint, cell bigint, d double")
    return written(found, "knn-cells"), points


def blocks(members: DataFrame, block: int, n: int = 0) -> DataFrame:
    """``block, cell, lo, hi, members``: cells cut by distance and by hash.  ``n`` vectors in all make the number of tasks."""
    size = members.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("d", [i / RINGS for i in range(1, RINGS)], 1000).alias("_cuts"))
    m = members.join(F.broadcast(size), "cell")  # a row a pivot
    over = F.size(F.filter("_cuts", lambda c: c < F.col("d")))
    rings = F.least(F.lit(RINGS), F.ceil(F.col("_n") * RINGS_PER_BLOCK / block))
    m = m.withColumn("_ring", F.when(F.col("_n") > block, F.floor(over * rings / RINGS)).otherwise(0)).drop("_n", "_cuts")
    parts = m.groupBy("cell", "_ring").agg(F.ceil(F.count(F.lit(1)) / block).alias("_parts"))
    m = m.join(parts, ["cell", "_ring"]).withColumn("_part", F.pmod(F.xxhash64("vid"), F.col("_parts")))
    if n:
        m = m.repartition(-(-n // (block * PER_TASK)), "cell", "_ring", "_part")
    found = m.groupBy("cell", "_ring", "_part").agg(
        F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("vid", "v", "first", "row")).alias("members")
    )
    return written(found.withColumn("block", F.monotonically_increasing_id()).drop("_ring", "_part"), "knn-blocks")


def _unpacked(members: pa.Array, width: int):
    x = members.values if isinstance(members, pa.ListScalar) else members.flatten()
    return x.field("vid").to_numpy(), _matrix(x.field("v"), width), x.field("first").to_numpy(), x.field("row").to_numpy()


def _needed(q, kth, pivots, cell, lo, hi, full, others) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks among ``others`` that each of some vectors needs (``query, block``), and every vector's reach.

    ``kth`` bounds the vectors' k-th distances by what is known, ``full`` a block's vectors' from its pivot.
    """
    centre = q.mean(0, keepdims=True)
    radius = np.sqrt(squared(q, centre).max()) * (1 + SLACK)
    apart = np.sqrt(squared(centre, pivots))[0, cell]
    near = np.argpartition(apart + full, NEAR)[:NEAR] if len(full) > NEAR else np.arange(len(full))
    bound = np.minimum(kth, (np.sqrt(squared(q, pivots[cell[near]])) + full[near]).min(1))
    reach = bound * (1 + SLACK) + SLACK * (apart.max() + radius)
    far = radius + reach.max()
    some = np.flatnonzero(~(apart - hi > far) & ~(lo - apart > far) & others)
    at_cells, at_cell = np.unique(cell[some], return_inverse=True)
    away = np.sqrt(squared(q, pivots[at_cells]))[:, at_cell]
    who, which = np.nonzero((away - hi[some] <= reach[:, None]) & (lo[some] - away <= reach[:, None]))
    return who, some[which], reach


def within_blocks(table: DataFrame, points: np.ndarray, k: int, width: int) -> DataFrame:
    """Each vector's best in its own block, and a row for every other block that it needs (``need``, with its bound and itself)."""
    meta = table.select("block", "cell", "lo", "hi", "n").toPandas()
    shared = table.sparkSession.sparkContext.broadcast((points, *[meta[c].to_numpy() for c in ("block", "cell", "lo", "hi", "n")]))
    schema = pa.schema([*_FOUND_ARROW, ("need", pa.int64()), ("bound", pa.float64()), ("v", pa.list_(pa.float64()))])

    def padded(found: list, extra: list, n: int) -> pa.RecordBatch:
        none = [pa.nulls(n, f.type) for f in schema]
        for at, x in zip(range(len(found)), found):
            none[at] = pa.array(x)
        for at, x in zip(range(5, 8), extra):
            none[at] = x if isinstance(x, pa.Array) else pa.array(x)
        return pa.RecordBatch.from_arrays(none, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, ids, cell, lo, hi, n = shared.value
        full = np.where(n >= k, hi, np.inf)
        for b in batches:
            for own, members in zip(b.column(0).to_pylist(), b.column(1)):
                vid, v, first, row = _unpacked(members, width)
                for at, found in zip(range(0, len(v), STEP), _search(vid, v, vid, v, first, row, k)):
                    yield padded(found, [], len(found[0]))
                    q, q_vid = v[at : at + STEP], vid[at : at + STEP]
                    own_kth = np.sqrt(found[2].reshape(len(q), k)[:, k - 1]) if len(v) >= k else np.full(len(q), np.inf)
                    who, which, reach = _needed(q, own_kth, pivots, cell, lo, hi, full, ids != own)
                    if len(who):
                        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(who) + 1) * width, pa.int32()), pa.array(q[who].reshape(-1)))
                        yield padded([q_vid[who]], [ids[which], (reach[who] * (1 + SLACK)) ** 2, flat], len(who))

    found = table.select("block", "members").mapInArrow(run, f"{_FOUND}, need bigint, bound double, v array<double>")
    return written(found, "knn-own")


def across_blocks(table: DataFrame, own: DataFrame, k: int, width: int, block: int) -> DataFrame:
    """The best of every vector in each other block that it needs."""
    needs = own.filter(F.col("need").isNotNull()).select(F.col("need").alias("block"), "vid", "v", "bound")
    copies = needs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / (block * PER_BLOCK)).alias("_copies"))
    many = F.coalesce("_copies", F.lit(1))
    needs = needs.join(F.broadcast(copies), "block").withColumn("_copy", F.pmod(F.xxhash64("vid"), many)).drop("_copies")  # a row a block at most
    rest = table.select("block", "members").join(F.broadcast(copies), "block").withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1))).drop("_copies")

    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        if not len(queries) or not len(members):
            return _FOUND_ARROW.empty_table()
        vid, v, first, row = _unpacked(members.column("members").combine_chunks(), width)
        q = _matrix(queries.column("v"), width)
        parts = list(_search(queries.column("vid").to_numpy(), q, vid, v, first, row, k, queries.column("bound").to_numpy()))
        return pa.table([np.concatenate(c) for c in zip(*parts)], schema=_FOUND_ARROW)

    return needs.groupBy("block", "_copy").cogroup(rest.groupBy("block", "_copy")).applyInArrow(run, _FOUND)


def best_of(vectors: DataFrame, n: int, keep: int, width: int, block: int, pivots: int) -> DataFrame:
    """``vid, other, d2``: the ``keep`` nearest vectors of each of the ``n``, itself among them; cells and blocks go when it is written."""
    spark = vectors.sparkSession
    path = scratch_path(spark, "knn-found")
    block = max(block, -(-n // MAX_BLOCKS))
    with passing_scratch(spark):
        placed, points = cells(vectors, n, min(pivots, -(-n // block)), width)
        table = blocks(placed, block, n)
        own = within_blocks(table, points, keep, width)
        # written, so that the copies of vectors are gone before the lists are made
        across = written(across_blocks(table, own, keep, width, block), "knn-across")
        found = own.filter(F.col("need").isNull()).select("vid", "other", "d2", "first", "row").unionByName(across)
        w = Window.partitionBy("vid").orderBy("d2", "first", "row")
        return written(found.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= keep).select("vid", "other", "d2"), "knn-found", path)


def nearest(rows: DataFrame, features: Sequence[str], k: int, id_col: str, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``rows`` with ``neighbours``: its ``k`` nearest other rows as ``(d2, id, v)`` by squared distance, then id.

    Fewer than ``k`` other rows make a shorter list.  Null features count as 0, null ids come last among equals;
    rows that share an id are rows of their own.
    """
    spark = rows.sparkSession
    ship_package(spark)
    width, keep = len(features), k + 1
    v = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) + F.lit(0.0) for c in features])
    path = scratch_path(spark, "knn-lists")
    with shuffles_dropped(spark):
        base = written(rows.withColumn("_row", F.monotonically_increasing_id()), "knn-rows")
        keyed = base.select(v.alias("v"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NO_ID))).alias("first"), F.col("_row").alias("row"))
        with passing_scratch(spark):  # only rows and lists stay
            vectors = distinct_vectors(keyed, keep)
            n = vectors.count()
            if not n:
                return base.drop("_row").withColumn("neighbours", F.array().cast(f"array<struct<d2:double,{id_col}:bigint,v:array<double>>>"))
            found = best_of(vectors, n, keep, width, block, pivots)
            members = vectors.select(F.col("vid").alias("other"), "members", F.col("v").alias("_v2"))
            each = found.join(members, "other").select("vid", F.transform("members", lambda m: F.struct(F.col("d2").alias("d2"), m["first"].alias("first"), m["row"].alias("row"), F.col("_v2").alias("v"))).alias("near"))
            kind = "array<struct<d2:double,first:bigint,row:bigint,v:array<double>>>"
            lists = each.groupBy("vid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, keep).cast(kind).alias("near"))  # keep * keep at most
            lists = written(lists.join(vectors.select("vid", F.col("v").alias("_v1")), "vid").select("_v1", "near"), "knn-lists", path)
        # a vector of very many rows is broadcast, the others join by vector
        total = base.count()
        hot = keyed.groupBy(F.col("v").alias("_v1")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * HOT > total).select("_v1")
        most = cut_lineage(lists.join(F.broadcast(hot), "_v1"))
    base = base.withColumn("_v", v)
    wide = base.join(F.broadcast(most), F.col("_v") == F.col("_v1"), "left")
    rest = wide.filter(F.col("near").isNull()).select(*base.columns).join(lists, F.col("_v") == F.col("_v1"))
    out = wide.filter(F.col("near").isNotNull()).unionByName(rest)
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("_row")), 1, k)
    shown = F.transform(others, lambda x: F.struct(x["d2"].alias("d2"), F.nullif(x["first"], F.lit(int(NO_ID))).alias(id_col), x["v"].alias("v")))
    return out.select(*rows.columns, shown.alias("neighbours"))
