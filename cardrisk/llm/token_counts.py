"""Token counts from pre-token frequencies, without materialising ids.

Every distinct pre-token of the corpus is encoded once, and only its number of
pieces is kept.  Documents become pre-token frequencies, which are joined to
those numbers and summed:

1. frequency of every pre-token over the corpus (partly summed in each task);
2. pieces of each distinct pre-token;
3. the frequencies of each document.  The ``common`` most frequent pre-tokens
   (a fixed number of hashes and counts, broadcast) are summed on the spot,
   so no hot key is shuffled; all others go through a shuffle join.

Documents that hold special token strings or code points on which Unicode
versions disagree are counted whole by the tokenizer.

Nulls and edges: a null text is empty and has no token; repeated rows each
keep their row; a null ``doc_id`` stays null; an empty table gives an empty result.
Other columns are not read, whatever their names; a very long text is split and counted in one numpy step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm.common import batch, frequent, keyed, prepare, signed, text_slices, written
from cardrisk.llm.pretokens import Split, load_tokenizer, tokenizer_path

#: Broadcast pre-tokens: 12 bytes each.
COMMON = 1 << 17
#: Distinct pre-tokens that a task holds before it hands them on.
HELD = 400_000

_LOADED: dict = {}


def _tokenizer(path: str):
    if path not in _LOADED:
        t = load_tokenizer(path)
        _LOADED[path] = (t, tuple(a.content for a in t.get_added_tokens_decoder().values()))
    return _LOADED[path]


def pretoken_frequencies(docs: DataFrame, path: str) -> DataFrame:
    """``hash, pretoken, n`` of every distinct pre-token of the corpus."""
    schema = pa.schema([("hash", pa.int64()), ("pretoken", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, specials = _tokenizer(path)
        held: dict[int, list] = {}

        def flush():
            rows = list(held.values())
            out = batch(schema, signed(np.fromiter(held, np.uint64, len(held))), [r[0] for r in rows], [r[1] for r in rows])
            held.clear()
            return out

        for b in batches:
            for lo, hi, _, _ in text_slices(b.column(0)):
                split = Split(b.column(0)[lo:hi].to_pylist(), specials)
                new, first, n = np.unique(split.hash, return_index=True, return_counts=True)
                for h, s, c in zip(new.tolist(), split.strings(first), n.tolist()):
                    row = held.get(h)
                    if row is None:
                        held[h] = [s, c]
                    else:
                        row[1] += c
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    parts = docs.select("text").mapInArrow(run, "hash bigint, pretoken string, n bigint")
    return parts.groupBy("hash").agg(F.min("pretoken").alias("pretoken"), F.sum("n").alias("n"))


def _pieces(frequencies: DataFrame, path: str) -> DataFrame:
    schema = pa.schema([("hash", pa.int64()), ("pieces", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = _tokenizer(path)
        for b in batches:
            encoded = tokenizer.encode_batch(b.column(1).to_pylist(), add_special_tokens=False)
            yield batch(schema, b.column(0), [len(e.ids) for e in encoded], b.column(2))

    return frequencies.select("hash", "pretoken", "n").mapInArrow(run, "hash bigint, pieces int, n bigint")


def token_counts(docs: DataFrame, path: str | None = None, common: int = COMMON) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every document."""
    spark = prepare(docs.sparkSession)
    path = path or tokenizer_path()
    source = keyed(docs)
    pieces = written(_pieces(pretoken_frequencies(source, path), path), "pieces")
    top = frequent(pieces, "n", common).select("hash", "pieces").toPandas()
    order = np.argsort(top["hash"].to_numpy(dtype=np.int64))
    table = spark.sparkContext.broadcast((top["hash"].to_numpy(dtype=np.int64)[order], top["pieces"].to_numpy(dtype=np.int32)[order]))

    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_bytes", pa.int64()), ("hash", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, specials = _tokenizer(path)
        known, sizes = table.value
        for b in batches:
            for lo, hi, _, offs in text_slices(b.column(2)):
                texts = b.column(2)[lo:hi].to_pylist()
                split = Split(texts, specials)
                h = signed(split.hash)
                spot = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                hit = known[spot] == h if len(known) else np.zeros(len(h), bool)
                here = np.append(np.where(hit, sizes[spot] if len(known) else 0, 0).astype(np.int64), 0)
                sums = np.add.reduceat(here, split.first[:-1]) * (np.diff(split.first) > 0)
                for i in np.flatnonzero(split.odd):
                    sums[i] = len(tokenizer.encode(texts[i], add_special_tokens=False).ids)
                # one row of a document's own sum (no hash), and one for each of its other pre-tokens
                row = np.repeat(np.arange(hi - lo), np.diff(split.first))[~hit]
                h = h[~hit]
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.empty(0, np.int64)
                n = np.diff(np.append(new, len(h)))
                at = np.concatenate([np.arange(hi - lo), row[new]])
                take = pa.array(at + lo)
                size = np.concatenate([np.diff(offs), np.zeros(len(new), np.int64)])
                gap = np.concatenate([np.ones(hi - lo, bool), np.zeros(len(new), bool)])
                yield batch(schema, b.column(0).take(take), b.column(1).take(take), size, pa.array(np.concatenate([np.zeros(hi - lo, np.int64), h[new]]), mask=gap), np.concatenate([sums, n]))

    rows = source.mapInArrow(run, "doc_id bigint, text_key bigint, n_bytes bigint, hash bigint, n bigint")
    rows = written(rows, "doc-pretokens")
    rare = rows.filter(F.col("hash").isNotNull()).join(pieces.select("hash", "pieces"), "hash")
    rare = rare.select("doc_id", "text_key", F.lit(0).cast("bigint").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n"), F.lit(0).cast("bigint").alias("copies"))
    own = rows.filter(F.col("hash").isNull()).select("doc_id", "text_key", "n_bytes", "n", F.lit(1).cast("bigint").alias("copies"))
    sums = own.unionByName(rare).groupBy("doc_id", "text_key").agg(F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n"), F.sum("copies").alias("copies"))
    # repeated rows were summed together; each gets its row back
    return sums.select("doc_id", "n_bytes", F.expr("n div copies").alias("n_tokens"), F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")).drop("_copy")
