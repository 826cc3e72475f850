"""SimHash near-duplicates through BK-trees.

Fingerprints within ``radius`` bits of each other are linked, and documents get
the component of the link graph.  Of ``radius + 1`` blocks of bits two such
fingerprints share one, so every block (mask and value) is a shard, and each
fingerprint goes to ``radius + 1`` of them.  A shard is a BK-tree (children keyed by
their integer Hamming distance to the parent), searched along the edges within
the radius only.  A shard of over ``shard_rows`` fingerprints is not one
tree: its members agree on the shard's bits, so the other bits are cut into blocks
again, and so on.  That keeps every tree bounded and misses no link.

The trees travel by shuffle.  Together they hold the whole corpus several
times over, so they have no bound that would allow to broadcast them.

A tree reports a spanning forest of its links, not all pairs; components
over all shards come from alternating large-star and small-star steps, each
written to the shared folder.  Copies share one fingerprint and are one node.

Nulls and edges: a text without words has fingerprint 0 and is linked like any
other; one of fewer words than a shingle has one shingle; repeated rows keep their
rows; rows with a null ``doc_id`` take part, but the component's id is its
smallest id that is not null (null if it has none); an empty table gives an
empty result.  ``near_duplicates`` reads no other columns; ``keep_one`` keeps them, whatever their
names; a very long text's shingles are hashed in one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm import kernels as K
from cardrisk.llm.common import batch, free_name, keyed, prepare, signed, text_hash, text_slices, written

WORDS, SEED, RADIUS, BITS = 3, 42, 3, 64
#: Most fingerprints of one BK-tree.
SHARD_ROWS = 2048


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many of each document's hashes have each bit: (documents, 64)."""
    out = np.zeros((len(first) - 1, BITS), np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for lo in range(0, len(hashes), 1 << 16):
        part, rows = hashes[lo : lo + (1 << 16)], row[lo : lo + (1 << 16)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        out[rows[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    return out


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, text_key, fingerprint`` (64 bits as a long) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fingerprint", pa.int64())])
    fold = bytes(K.LOWER.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for b in batches:
            for lo, hi, buf, offs in text_slices(b.column(2)):
                raw, hashes, first = buf.tobytes().translate(fold), [], [0]
                for a, z in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    tokens = raw[a:z].split()  # bytes split at \x20 and \x09-\x0D
                    if len(tokens) > words:
                        line = b" ".join(tokens)
                        ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
                        begins = [0, *(ends[: len(tokens) - words] + 1).tolist()]
                        hashes += [xxh64_intdigest(line[i:j], seed) for i, j in zip(begins, ends[words - 1 :].tolist())]
                    elif tokens:
                        hashes.append(xxh64_intdigest(b" ".join(tokens), seed))
                    first.append(len(hashes))
                first = np.array(first)
                counts = _bit_counts(np.array(hashes, np.uint64), first)
                bits = (2 * counts > np.diff(first)[:, None]).astype(np.uint8)
                value = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
                yield batch(schema, b.column(0)[lo:hi], b.column(1)[lo:hi], signed(value.astype(np.uint64)))

    return keyed(docs).mapInArrow(run, "doc_id bigint, text_key bigint, fingerprint bigint")


def _finer(mask: int, radius: int) -> list[int]:
    """The mask with each of ``radius + 1`` blocks of its free bits added; none if they are too few."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    if len(free) < 2 * (radius + 1):
        return []
    blocks = np.array_split(free, radius + 1)
    return [mask | sum(1 << int(i) for i in block) for block in blocks]


def _long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bk_links(members: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs within ``radius`` bits, through one BK-tree."""
    root = members[0]
    children: dict[int, dict[int, int]] = {root: {}}
    group: dict[int, int] = {root: root}

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = x = group[group[x]]
        return x

    for x in members[1:]:
        group[x] = x
        stack = [root]
        while stack:
            y = stack.pop()
            d = (x ^ y).bit_count()
            if d <= radius and (a := find(x)) != (b := find(y)):
                group[max(a, b)] = min(a, b)
                yield x, y
            for edge, child in children[y].items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)
        y = root
        while (child := children[y].get(d := (x ^ y).bit_count())) is not None:
            y = child
        children[y][d] = x
        children[x] = {}


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``radius`` bits (column ``fingerprint``, distinct)."""
    spark = distinct.sparkSession
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, members = None, []
        found: list[tuple[int, int]] = []

        def out():
            pairs = np.array(found, np.uint64).reshape(-1, 2)
            found.clear()
            return batch(schema, signed(np.ascontiguousarray(pairs[:, 0])), signed(np.ascontiguousarray(pairs[:, 1])))

        for b in batches:
            prints = b.column(2).to_numpy().view(np.uint64).tolist()
            for key, x in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), prints):
                if key != shard:
                    if len(members) > 1:
                        found.extend(bk_links(members, radius))
                    shard, members = key, []
                members.append(x)
            if len(found) > 50_000:
                yield out()
        if len(members) > 1:
            found.extend(bk_links(members, radius))
        if found:
            yield out()

    def trees(rows: DataFrame) -> DataFrame:
        dealt = rows.select("mask", "value", "fingerprint").repartition("mask", "value").sortWithinPartitions("mask", "value", "fingerprint")
        return dealt.mapInArrow(search, "a bigint, b bigint")

    masks = _finer(0, radius)
    rows = distinct.select("fingerprint", F.explode(F.array(*[F.lit(_long(m)) for m in masks])).alias("mask"))
    rows = rows.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
    parts = []
    while True:
        finer = {m: _finer(m, radius) for m in masks}
        finer = {m: f for m, f in finer.items() if f}
        large = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows).select("mask", "value")
        large = written(large, "simhash-large") if finer else None
        if large is None or large.isEmpty():
            parts.append(trees(rows))
            break
        parts.append(trees(rows.join(large, ["mask", "value"], "left_anti")))
        # 4**level rows, some thousands at most
        table = spark.createDataFrame([(_long(m), [_long(x) for x in f]) for m, f in finer.items()], "mask bigint, finer array<bigint>")
        rows = rows.join(large, ["mask", "value"], "left_semi").join(F.broadcast(table), "mask").select("fingerprint", F.explode("finer").alias("mask"))
        rows = written(rows.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask"))), "simhash-finer")
        masks = sorted({x for f in finer.values() for x in f})
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each node's component (nodes without links are left out)."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "star")
    seen = None
    while True:
        state = tuple(edges.agg(F.count(F.lit(1)), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)")).first())
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        star = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").filter("u > v").distinct(), "star")


def near_duplicates(docs: DataFrame, words: int = WORDS, seed: int = SEED, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, text_key, fingerprint, component_id, label`` of every document; ``label`` is the component's smallest fingerprint."""
    prepare(docs.sparkSession)
    prints = written(fingerprints(docs, words, seed), "simhash")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    labels = components(links(classes.select("fingerprint"), radius, shard_rows))
    classes = classes.join(labels, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "first_id", F.coalesce("label", "fingerprint").alias("label"))
    classes = written(classes, "simhash-classes")
    ids = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(ids, "label").select("fingerprint", "component_id", "label")
    return prints.join(classes, "fingerprint").select("doc_id", "text_key", "fingerprint", "component_id", "label")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, that of the smallest id, with all its columns.

    Equal rows of that id count as one document; of several texts of that id in the group, and in a
    group without ids, the smallest text key stays.
    """
    found = near_duplicates(docs, **options)
    # the label, not the id: two groups may have the same smallest id
    kept = found.filter("doc_id <=> component_id").groupBy("label", "doc_id").agg(F.min("text_key").alias("text_key"))
    kept_id, kept_key = free_name("_kept_id", docs.columns), free_name("_kept_key", docs.columns)
    kept = written(kept, "simhash-kept").select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key))
    id_ = F.col("doc_id").cast("bigint")
    out = docs.join(kept, id_.eqNullSafe(F.col(kept_id)) & (text_hash() == F.col(kept_key)), "left_semi")
    return out.dropDuplicates(["doc_id", "text"])
