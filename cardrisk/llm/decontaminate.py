"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents are long, so Jaccard similarity between them
is tiny and an ordinary MinHash index misses them.  Both sides are therefore
partitioned by the size of their shingle set (powers of two), and every pair
of size classes has its own one-permutation MinHash: the hash range is cut
into bins, a set's signature is the minimum of each bin, and the number of
bins grows with the documents' size until an item that is contained at the
threshold shares no minimum with a probability of at most ``miss``.  Pairs
with an equal minimum are candidates; each is then verified by its exact
shingle containment ``|item & document| / |item|``.

Shingles are ``words`` consecutive words ``[^\\x20\\x09-\\x0D]+`` with A-Z in
lower case; a text of fewer words has one shingle, its whole sequence, so a
short item is found only in a document that is that sequence.

One pass reads the texts.  A bitmap of fixed size (``filter_bits``) of the
items' shingles drops the documents' other shingles before anything is
shuffled; it has no false negatives, so it changes cost only.

Nulls and edges: a null or empty text has no shingle and matches nothing; an
item without words matches nothing; items with equal shingle sets are one
class (``item_id`` is its smallest id, ``item_ids`` lists all, null ids left
out of the list); repeated document rows give repeated result rows; an empty
table gives an empty result.  ``contaminated`` reads no other columns; ``decontaminate`` keeps them,
whatever their names; a very long text is one numpy step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm import kernels as K
from cardrisk.llm.common import batch, free_name, keyed, lists, prepare, signed, text_hash, text_slices, written

WORDS, CONTAINMENT = 5, 0.8
#: Largest probability that a contained item shares no minimum with its document.
MISS = 1e-6
FILTER_BITS = 24


def text_shingles(buf: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[buf]
    starts, ends, first = K.word_spans(low, offs)
    return K.shingles(K.word_hashes(low, starts, ends), first, words)


def bins_log2(doc_class: int, item_class: int, threshold: float, miss: float) -> int:
    """log2 of the bins for documents of under ``2**doc_class`` shingles and items of at least ``2**(item_class-1)``."""
    shared = math.ceil(threshold * 2 ** (item_class - 1))
    for log2 in range(1, 63):
        load = 2.0**doc_class / 2.0**log2
        if (1 - (1 - math.exp(-load)) / load) ** shared <= miss:
            return log2
    return 63


def _items(benchmark: DataFrame, words: int) -> DataFrame:
    """Item classes: ``item_id, item_ids, hashes`` (sorted distinct shingle hashes)."""
    schema = pa.schema([("item_id", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in text_slices(b.column(1)):
                h, first = text_shingles(buf, offs, words)
                sets = [np.unique(h[first[i] : first[i + 1]]) for i in range(hi - lo)]
                ends = np.cumsum([0] + [len(s) for s in sets])
                yield batch(schema, b.column(0)[lo:hi], lists(signed(np.concatenate(sets)), ends, pa.int64()))

    source = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    sets = source.mapInArrow(run, "item_id bigint, hashes array<bigint>").filter(F.size("hashes") > 0)
    return sets.groupBy("hashes").agg(F.min("item_id").alias("item_id"), F.sort_array(F.collect_set("item_id")).alias("item_ids"))


def _bitmap(items: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``2**bits`` bits over the items' shingles: at most ``2**bits / 8`` bytes reach the driver."""
    mask = (1 << bits) - 1
    spots = F.array(F.col("h").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("h", bits).bitwiseAND(F.lit(mask)))
    rows = (
        items.select(F.explode("hashes").alias("h"))
        .select(F.explode(spots).alias("spot"))
        .groupBy(F.shiftright("spot", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _in_bitmap(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    hit = np.ones(len(h), bool)
    for spot in (h & mask, (h >> np.uint64(bits)) & mask):
        hit &= (bitmap[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return hit


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = WORDS,
    threshold: float = CONTAINMENT,
    miss: float = MISS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Pairs of a document and an item class it contains at ``threshold`` or more.

    Columns ``doc_id, text_key, item_id, item_ids, shared, item_shingles, doc_shingles, containment``.
    """
    spark = prepare(docs.sparkSession)
    items = written(_items(benchmark, words).withColumn("klass", F.monotonically_increasing_id()), "bench-items").withColumn("q", F.size("hashes"))
    classes = sorted(r[0] for r in items.select(F.length(F.bin("q"))).distinct().collect())  # at most 63 size classes
    plan = {c: sorted({bins_log2(c, q, threshold, miss) for q in classes}) for c in range(1, 63)}
    shared_map = spark.sparkContext.broadcast(_bitmap(items, filter_bits))  # 2**filter_bits bits, whatever the tables hold

    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("doc_shingles", pa.int64()), ("doc_class", pa.int32()), ("bins", pa.list_(pa.int32())), ("minima", pa.list_(pa.int64())), ("found", pa.list_(pa.int64()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared_map.value
        for b in batches:
            rows, sizes, levels, bins, minima, found = [], [], [], [], [], []
            for lo, _, buf, offs in text_slices(b.column(2)):
                h, first = text_shingles(buf, offs, words)
                hit = _in_bitmap(bitmap, h, filter_bits)
                held = np.add.reduceat(np.append(hit, False), first[:-1]) * (np.diff(first) > 0)
                for i in np.flatnonzero(held):
                    own = np.unique(h[first[i] : first[i + 1]])
                    known = np.flatnonzero(_in_bitmap(bitmap, own, filter_bits))
                    level = len(own).bit_length()
                    mine, at = [], []
                    for log2 in plan[level]:
                        part = own >> np.uint64(64 - log2)
                        least = known[(known == 0) | (part[known] != part[known - 1])]
                        mine.append(own[least])
                        at.append(np.full(len(least), log2, np.int32))
                    rows.append(lo + int(i))
                    sizes.append(len(own))
                    levels.append(level)
                    minima.append(signed(np.concatenate(mine)))
                    bins.append(np.concatenate(at))
                    found.append(signed(own[known]))
            if rows:
                at = pa.array(rows, pa.int64())
                yield batch(schema, b.column(0).take(at), b.column(1).take(at), sizes, levels, bins, minima, found)

    sketch = "doc_id bigint, text_key bigint, doc_shingles bigint, doc_class int, bins array<int>, minima array<bigint>, found array<bigint>"
    hits = keyed(docs).mapInArrow(search, sketch) if classes else spark.createDataFrame([], sketch)
    hits = written(hits, "bench-hits").withColumn("row", F.monotonically_increasing_id())
    hits = written(hits, "bench-rows")  # so that a row keeps its number

    # the items' minima for the bins that the documents' size classes ask for: the least of the hashes in each bin
    sizes = [r[0] for r in hits.select("doc_class").distinct().collect()]  # at most 62
    needed = {q: sorted({bins_log2(c, q, threshold, miss) for c in sizes}) for q in classes}
    levels = F.create_map(*[x for q in classes for x in (F.lit(q), F.array(*[F.lit(n) for n in needed[q]]).cast("array<int>"))]) if classes else F.lit(None).cast("map<int,array<int>>")
    signatures = items.select("klass", "hashes", F.explode(levels[F.length(F.bin("q"))]).alias("bin"))
    signatures = signatures.select("klass", "bin", F.explode("hashes").alias("h")).withColumn("cell", F.expr("shiftrightunsigned(h, 64 - bin)"))
    least = F.min(F.expr("h ^ (-9223372036854775807L - 1L)"))  # the flipped sign bit gives unsigned order
    signatures = signatures.groupBy("klass", "bin", "cell").agg(least.alias("h")).select("klass", "bin", F.expr("h ^ (-9223372036854775807L - 1L)").alias("minimum"))

    # a minimum that very many documents share is a skewed key of a plain join, which Spark splits
    probes = hits.select("row", F.explode(F.arrays_zip("bins", "minima")).alias("m"))
    probes = probes.select("row", F.col("m.bins").alias("bin"), F.col("m.minima").alias("minimum"))
    candidates = probes.join(signatures, ["bin", "minimum"]).select("row", "klass").distinct()

    verified = candidates.join(hits.select("row", "doc_id", "text_key", "doc_shingles", "found"), "row").join(items, "klass")
    verified = verified.withColumn("shared", F.size(F.array_intersect("found", "hashes")))
    return verified.filter(F.col("shared") >= F.lit(threshold) * F.col("q")).select(
        "doc_id", "text_key", "item_id", "item_ids", F.col("shared").cast("bigint").alias("shared"), F.col("q").cast("bigint").alias("item_shingles"),
        "doc_shingles", (F.col("shared") / F.col("q")).alias("containment"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no test item, with all their columns."""
    found = contaminated(docs, benchmark, **options).select("doc_id", "text_key").distinct()
    id_, key = free_name("_bad_id", docs.columns), free_name("_bad_key", docs.columns)
    bad = written(found, "bench-bad").select(F.col("doc_id").alias(id_), F.col("text_key").alias(key))
    return docs.join(bad, F.col("doc_id").cast("bigint").eqNullSafe(F.col(id_)) & (text_hash() == F.col(key)), "left_anti")
