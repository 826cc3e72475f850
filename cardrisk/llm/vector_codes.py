"""Product codes of vectors by Lloyd rounds over cover trees.

Each component ``x`` becomes ``floor(4096 * x)``; all distances, sums and means are exact integers.
A vector is cut into ``parts`` equal parts, each with a codebook of its own.

The vectors are cut into blocks of bounded size.  For every part of a block one cover tree is built,
once: a node's points lie within its radius of its first point, its children cover them with half that
radius, and a node of few points is a leaf.  Points stand in tree order, so a node is a range, and
cumulative sums give the sum of its points.  The trees are written, and each round reads them again.

A round walks each tree from the root.  An entry that is further from a node's first point than the
nearest entry by more than twice the radius is nearest to none of its points (triangle inequality); once
one entry is left the whole subtree goes to it by its count and sum.  Leaves that stay ambiguous
are compared point by point.  Rounding is on the safe side: roots of exact squares are compared with a margin,
so an entry that could tie is kept, and ties go to the lower index in the exact comparison.
A task sends one row an entry; the driver gets ``parts * entries`` rows a round.

Nulls and edges: vectors that are null or hold null or non-finite components are dropped.  The codebooks start
with the smallest ``vec_id``s, ties by the vector itself, null ids last; fewer kept vectors make fewer entries.
A vector of another length than the first of these, or with a component beyond +-2**15 (whose squares leave 64
bits), keeps its row with null code and error and takes no part in the rounds.  A length that ``parts`` doesn't
divide is an error of the call, unless no vector is kept.  Repeated rows and ids are rows of their own; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.llm.common import batch, prepare, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block, points of a leaf.
BLOCK, LEAF = 4096, 8
#: Largest component: squares of differences stay within 64 bits.
REACH = 1 << 15
#: Labels that may have their sum broadcast: those that hold over one row in so many.
HOT = 1024


def built(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A cover tree of ``points``: their order, its nodes (``lo, hi, first child, children``) and their radii."""
    n = len(points)
    order = np.arange(n)
    lo, hi = np.array([0]), np.array([n])
    radius = np.array([np.sqrt(_squares(points, points[:1]).max())])
    nodes, radii, base = [], [], 0
    while len(lo):
        split = np.flatnonzero((hi - lo > leaf) & (radius > 0))
        children = np.zeros(len(lo), np.int64)
        new_lo = new_hi = np.empty(0, np.int64)
        new_radius = np.empty(0)
        if len(split):
            size = (hi - lo)[split]
            at = np.repeat(lo[split] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            node = np.repeat(np.arange(len(split)), size)
            child, far = _covered(points[order[at]], node, (radius[split] / 2) ** 2)
            children[split] = np.maximum.reduceat(child, np.cumsum(size) - size) + 1
            moved = np.lexsort((child, node))
            order[at] = order[at[moved]]
            child, node, far = child[moved], node[moved], far[moved]
            edge = np.flatnonzero(np.concatenate([[True], (child[1:] != child[:-1]) | (node[1:] != node[:-1])]))
            new_lo, new_hi = at[edge], at[np.append(edge[1:], len(at)) - 1] + 1
            new_radius = np.sqrt(np.maximum.reduceat(far, edge))
        first = base + len(lo) + np.cumsum(children) - children
        nodes.append(np.stack([lo, hi, first, children], axis=1))
        radii.append(radius)
        base += len(lo)
        lo, hi, radius = new_lo, new_hi, new_radius
    return order, np.concatenate(nodes), np.concatenate(radii)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    d = points - centres
    return np.einsum("ij,ij->i", d, d)


def _covered(points: np.ndarray, node: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's child in its node and its squared distance to that child's first point.

    In every node at once: the first point that no child covers yet becomes one.
    """
    child, far = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    left, k = np.arange(len(points)), 0
    while len(left):
        own = node[left]
        head = np.concatenate([[True], own[1:] != own[:-1]])
        centre = left[np.flatnonzero(head)[np.cumsum(head) - 1]]
        d = _squares(points[left], points[centre])
        near = d <= reach[own]
        child[left[near]], far[left[near]] = k, d[near]
        left, k = left[~near], k + 1
    return child, far


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every point to every entry."""
    return (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)[None, :]


def walked(points: np.ndarray, nodes: np.ndarray, radii: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of points (in tree order) and the entry that each goes to: ``lo, hi, entry``."""
    out: list[tuple] = []
    at, open_ = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
    far = np.iinfo(np.int64).max
    while len(at):
        lo, hi, first, children = nodes[at].T
        d = np.where(open_, _distances(points[lo], entries), far)
        root = np.sqrt(d.astype(np.float64))
        least = root.min(1)
        r = radii[at]
        margin = 1e-9 * (least + r) + 1e-6
        keep = open_ & (root <= (least + 2 * r + margin)[:, None])
        done = (keep.sum(1) == 1) | (r == 0)
        out.append((lo[done], hi[done], d[done].argmin(1)))
        # leaves: point by point
        leaf = np.flatnonzero(~done & (children == 0))
        if len(leaf):
            size = (hi - lo)[leaf]
            each = np.repeat(lo[leaf] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            exact = np.where(np.repeat(keep[leaf], size, axis=0), _distances(points[each], entries), far)
            out.append((each, each + 1, exact.argmin(1)))
        inner = np.flatnonzero(~done & (children > 0))
        size = children[inner]
        at = np.repeat(first[inner] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        open_ = np.repeat(keep[inner], size, axis=0)
    lo, hi, entry = (np.concatenate(c) for c in zip(*out))
    return lo, hi, entry


def coded(points: np.ndarray, nodes: np.ndarray, radii: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entry of each point, in tree order."""
    lo, hi, entry = walked(points, nodes, radii, entries)
    code = np.empty(len(points), np.int64)
    size = hi - lo
    code[np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(len(points))] = np.repeat(entry, size)
    return code


def summed(points: np.ndarray, nodes: np.ndarray, radii: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points that go to each entry."""
    lo, hi, entry = walked(points, nodes, radii, entries)
    upto = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points, axis=0, out=upto[1:])
    n, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    np.add.at(n, entry, hi - lo)
    np.add.at(sums, entry, upto[hi] - upto[lo])
    return n, sums


# Spark -------------------------------------------------------------------------------------------


def _kept(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v`` of the kept vectors, as doubles."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col("embedding").isNotNull() & good)
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))


def _fits(length: int) -> Column:
    return (F.size("v") == length) & ~F.exists("v", lambda x: F.abs(x) > REACH)


def first_entries(kept: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids: the ids first, then their rows."""
    kept = kept.filter(~F.exists("v", lambda x: F.abs(x) > REACH))
    least = [r[0] for r in kept.select("vec_id").orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    if not least:
        return []
    rows = kept if least[-1] is None else kept.filter(F.col("vec_id") <= least[-1])
    rows = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    length = len(rows[0]["v"])
    return [np.floor(SCALE * np.array(r["v"])).astype(np.int64).tolist() for r in rows if len(r["v"]) == length]


_TREES = "vec_id array<bigint>, label array<{label}>, points array<binary>, order array<binary>, nodes array<binary>, radii array<binary>"


def trees(kept: DataFrame, length: int, parts: int, block: int = BLOCK) -> DataFrame:
    """A row a block: ids, labels, and for each part its points in tree order and its tree."""
    arrow = kept.sparkSession.createDataFrame([], kept.select("label").schema).toArrow().schema.field(0).type
    binary = pa.list_(pa.binary())
    schema = pa.schema([("vec_id", pa.list_(pa.int64())), ("label", pa.list_(arrow)), *[(c, binary) for c in ("points", "order", "nodes", "radii")]])
    width = length // parts

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        n = len(table)
        v = np.floor(SCALE * pa.concat_arrays(table.column(2).chunks).flatten().to_numpy()).astype(np.int64).reshape(n, length)
        columns: list[list[bytes]] = [[], [], [], []]
        for p in range(parts):
            own = np.ascontiguousarray(v[:, p * width : (p + 1) * width])
            order, nodes, radii = built(own)
            for column, x in zip(columns, (own[order].astype("<i4"), order.astype("<i4"), nodes.astype("<i4"), radii.astype("<f8"))):
                column.append(x.tobytes())
        whole = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(table.column(c).chunks)) for c in (0, 1)]
        return batch(schema, *whole, *[[c] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            while len(b):
                head = b[: block - rows]
                held.append(head)
                rows += len(head)
                b = b[len(head) :]
                if rows == block:
                    yield one(held)
                    held, rows = [], 0
        if held:
            yield one(held)

    label = kept.schema["label"].dataType.simpleString()
    return kept.filter(_fits(length)).select("vec_id", "label", "v").mapInArrow(run, _TREES.format(label=label))


def _loaded(b: pa.RecordBatch, row: int, part: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = {c: b.column(b.schema.get_field_index(c)) for c in ("points", "nodes", "radii")}
    raw = {c: x.value_lengths()[row].as_py() and x[row].values[part].as_py() for c, x in column.items()}
    points = np.frombuffer(raw["points"], "<i4").astype(np.int64).reshape(-1, width)
    return points, np.frombuffer(raw["nodes"], "<i4").astype(np.int64).reshape(-1, 4), np.frombuffer(raw["radii"], "<f8")


def round_sums(blocks: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """``(part, entry) -> (points, sum)`` over all blocks."""
    parts, entries, width = books.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            for row in range(len(b)):
                for p in range(parts):
                    more, total = summed(*_loaded(b, row, p, width), books[p])
                    n[p] += more
                    sums[p] += total
        used = np.argwhere(n)
        yield batch(schema, used[:, 0].tolist(), used[:, 1].tolist(), [int(n[p, e]) for p, e in used], [sums[p, e].tolist() for p, e in used])

    rows = blocks.select("points", "nodes", "radii").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    total = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    found = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect()
    return {(r["part"], r["entry"]): (r["n"], [int(r[f"s{k}"]) for k in range(width)]) for r in found}


def codebooks(blocks: DataFrame, first: list[list[int]], parts: int, rounds: int) -> np.ndarray:
    """The entries after all rounds: ``[part, entry, position]``."""
    books = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for (p, e), (n, sums) in round_sums(blocks, books).items():
            books[p, e] = [s // n for s in sums]
    return books


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every kept vector, and the codebooks."""
    prepare(vectors.sparkSession)
    kept = _kept(vectors)
    first = first_entries(kept, entries)
    kind = kept.schema["label"].dataType
    label = kind.simpleString()
    none = (F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    if not first:
        return kept.select("vec_id", "label", *none), np.zeros((parts, 0, 0), np.int64)
    length = len(first[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components do not cut into {parts} equal parts")
    width = length // parts
    blocks = written(trees(kept, length, parts, block), "cover-trees")
    books = codebooks(blocks, first, parts, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{e:02x}" for e in range(books.shape[1])])
        for b in batches:
            at = {c: b.schema.get_field_index(c) for c in ("vec_id", "label", "order")}
            for row in range(len(b)):
                ids, labels = b.column(at["vec_id"])[row].values, b.column(at["label"])[row].values
                error, code = np.zeros(len(ids), np.int64), np.empty((len(ids), parts), "U2")
                for p in range(parts):
                    points, nodes, radii = _loaded(b, row, p, width)
                    order = np.frombuffer(b.column(at["order"])[row].values[p].as_py(), "<i4")
                    own = coded(points, nodes, radii, books[p])
                    code[order, p] = digits[own]
                    error[order] += _squares(points, books[p][own])
                text = ["".join(c) for c in code.tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    codes = blocks.mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")
    return codes.unionByName(kept.filter(~_fits(length)).select("vec_id", "label", *none)), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors summed over equal labels (nulls together).

    Labels of over one row in ``HOT`` (so under ``HOT`` of them) are broadcast; the others join by label.
    """
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    sums = written(sums.withColumnRenamed("label", "_label"), "label-errors")
    total = sums.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") * HOT > total
    same = F.col("label").eqNullSafe(F.col("_label"))
    wide = codes.join(F.broadcast(sums.filter(hot)), same, "left")
    most = wide.filter(F.col("_n").isNotNull())
    rest = wide.filter(F.col("_n").isNull()).drop("_label", "_n", "label_error").join(sums.filter(~hot), same)
    return most.unionByName(rest).drop("_label", "_n")
