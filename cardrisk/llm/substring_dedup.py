"""Substring dedup: seed with winnowed anchors, extend both ways, keep maximal repeats.

Anchors are winnowed ``seed_words``-grams: every run of ``length`` words has
one (its smallest gram hash, the rightmost of equals), chosen from the
run's words alone, so two equal runs have the same anchor at the same place.
Anchors that occur once are dropped; occurrences of the others are joined.

An occurrence is extended left and right over all runs that have chosen it: its
span.  Occurrences of an anchor with equal spans repeat each other in full
extent.  For anchors with several different spans, one occurrence of each span is
extended word by word: the anchor with ``i`` words to its left and the rest of
``length`` to its right, for every ``i``; equal extensions are repeats.  So
occurrences are compared class by class, never pair by pair, and an anchor
that half the corpus has costs one row for each occurrence.  Runs that repeat
and overlap merge to maximal repeats of at least ``length`` words.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Equality is that of an anchor's
64-bit hash, its place, and another 64-bit hash of the run.

Nulls and edges: a null or empty text has no words; a text of fewer than
``length`` words has no run and stays whole; repeated rows repeat each other
in full; a null ``doc_id`` stays null; an empty table gives an empty result.
Other columns are not read, whatever their names; a very long text is hashed in one numpy step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm import kernels as K
from cardrisk.llm.common import batch, join_docs, keyed, prepare, signed, text_slices, written

LENGTH, SEED_WORDS = 35, 12
U = np.uint64


class Anchors:
    """Anchor occurrences in some texts: document, first run, runs, place in it, and hashes."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, length: int, seed_words: int):
        self.starts, self.ends, self.first = K.word_spans(buf, offs)
        self.words = K.word_hashes(buf, self.starts, self.ends)
        self.pre = K.prefix(self.words, K.WORD_BASE)
        self.length = length
        counts = np.maximum(np.diff(self.first) - length + 1, 0)  # runs of each document
        run = np.arange(counts.sum()) + np.repeat(self.first[:-1] - (np.cumsum(counts) - counts), counts)
        if not len(run):
            self.doc = self.lo = self.runs = self.place = run
            self.anchor = self.span = run.astype(U)
            return
        at = np.arange(len(self.words) - seed_words + 1)
        grams = K.span_hash(self.pre, at, at + seed_words, K.WORD_BASE)
        chosen = K.rightmost_minimum(grams, length - seed_words + 1)[run]
        new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (run[1:] != run[:-1] + 1)]))
        lo, hi = run[new], run[np.append(new[1:], len(run)) - 1]
        self.doc = np.repeat(np.arange(len(counts)), counts)[new]
        self.lo, self.runs, self.place = lo, hi - lo + 1, chosen[new] - lo
        self.anchor = grams[chosen[new]]
        shape = (self.place * 4096 + self.runs).astype(U)
        self.span = K.mix(K.span_hash(self.pre, lo, hi + length, K.WORD_BASE) ^ K.mix(shape))

    def run_hashes(self, lo: np.ndarray) -> np.ndarray:
        return K.span_hash(self.pre, lo, lo + self.length, K.WORD_BASE)


def anchor_rows(source: DataFrame, length: int, seed_words: int) -> DataFrame:
    """``doc_id, text_key, lo, runs, place, anchor, span`` of every anchor; ``lo`` counts the document's words."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("lo", pa.int32()), ("runs", pa.int32()), ("place", pa.int32()), ("anchor", pa.int64()), ("span", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, buf, offs in text_slices(b.column(2)):
                a = Anchors(buf, offs, length, seed_words)
                if len(a.doc):
                    at = pa.array(a.doc + lo)
                    yield batch(schema, b.column(0).take(at), b.column(1).take(at), a.lo - a.first[a.doc], a.runs, a.place, signed(a.anchor), signed(a.span))

    return source.mapInArrow(run, "doc_id bigint, text_key bigint, lo int, runs int, place int, anchor bigint, span bigint")


def anchor_counts(source: DataFrame, length: int, seed_words: int) -> DataFrame:
    """``anchor, n``, already summed for each slice of text."""
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, buf, offs in text_slices(b.column(0)):
                a = Anchors(buf, offs, length, seed_words)
                if len(a.doc):
                    anchor, n = np.unique(a.anchor, return_counts=True)
                    yield batch(schema, signed(anchor), n)

    return source.select("text").mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))


def _extensions(wanted: DataFrame, source: DataFrame, length: int) -> DataFrame:
    """Every run of the wanted occurrences, extended from its anchor: ``anchor, span, left, run, i``."""
    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("at", pa.int32()), ("left", pa.int32()), ("run", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in text_slices(b.column(0)):
                starts, ends, first = K.word_spans(buf, offs)
                pre = K.prefix(K.word_hashes(buf, starts, ends), K.WORD_BASE)
                part = b.column(1)[lo:hi]
                rows, flat = np.repeat(np.arange(hi - lo), part.value_lengths().to_numpy()), part.flatten()
                at, runs, place = (flat.field(k).to_numpy().astype(np.int64) for k in ("lo", "runs", "place"))
                anchor, span = flat.field("anchor").to_numpy(), flat.field("span").to_numpy()
                which = np.repeat(np.arange(len(runs)), runs)
                i = np.arange(len(which)) - np.repeat(np.cumsum(runs) - runs, runs)
                begin = first[rows][which] + at[which] + i
                h = K.span_hash(pre, begin, begin + length, K.WORD_BASE)
                yield batch(schema, anchor[which], span[which], i, place[which] - i, signed(h))

    of = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("lo", "runs", "place", "anchor", "span")).alias("wanted"))
    texts = join_docs(source, of).select("text", "wanted")
    return texts.mapInArrow(run, "anchor bigint, span bigint, at int, left int, run bigint")


def repeats(docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS) -> DataFrame:
    """Maximal repeats: ``doc_id, text_key, spans`` with word ranges ``[lo, hi)``, sorted, not overlapping."""
    prepare(docs.sparkSession)
    source = keyed(docs)
    seeds = written(anchor_counts(source, length, seed_words).filter("n > 1").select("anchor"), "seeds")
    found = written(anchor_rows(source, length, seed_words).join(seeds, "anchor"), "anchors")

    key = F.struct("doc_id", "text_key", "lo", "runs", "place")
    spans = written(found.groupBy("anchor", "span").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("one")), "spans")
    whole = found.join(spans.filter("n > 1").select("anchor", "span"), ["anchor", "span"], "left_semi")
    whole = whole.select("doc_id", "text_key", "lo", (F.col("lo") + F.col("runs") + F.lit(length - 1)).alias("hi"))

    several = spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans")).filter("spans > 1").select("anchor")
    # written, so that the join deals its sides anew and Spark can split an anchor with very many spans
    differing = spans.join(written(several, "several"), "anchor")
    wanted = differing.select("anchor", "span", "one.*")
    # a repeated document row (same id and text) would list its occurrences twice; one is enough
    extended = written(_extensions(wanted, source, length).distinct(), "extensions")
    same = extended.groupBy("anchor", "left", "run").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor", "left", "run")
    lone = differing.filter("n = 1").select("anchor", "span", "one.doc_id", "one.text_key", "one.lo")
    partly = extended.join(same, ["anchor", "left", "run"], "left_semi").join(lone, ["anchor", "span"])
    partly = partly.select("doc_id", "text_key", (F.col("lo") + F.col("at")).alias("lo"), (F.col("lo") + F.col("at") + F.lit(length)).alias("hi"))
    ranges = F.sort_array(F.collect_list(F.struct("lo", "hi")))
    return whole.unionByName(partly).groupBy("doc_id", "text_key").agg(ranges.alias("spans"))


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ranges, those that touch or overlap made one."""
    top = np.maximum.accumulate(hi)
    new = np.flatnonzero(np.concatenate([[True], lo[1:] > top[:-1]]))
    return lo[new], top[np.append(new[1:], len(lo)) - 1]


def dedup(docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words, joined by a space), ``spans`` removed (words, ``[lo, hi)``)."""
    found = written(repeats(docs, length, seed_words), "repeats")
    source = keyed(docs)
    joined = join_docs(source, found, "left").select("doc_id", "text", "spans")
    kind = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, stop, buf, offs in text_slices(b.column(1)):
                part, raw = b.column(2)[at:stop], buf.tobytes()
                sizes = part.value_lengths().fill_null(0).to_numpy()
                flat = part.flatten()
                lo, hi = (flat.field(k).to_numpy().astype(np.int64) for k in ("lo", "hi"))
                ends = np.cumsum(sizes)
                words, removed, kept, spans = [], [], [], []
                for i, n in enumerate(sizes.tolist()):
                    tokens = raw[offs[i] : offs[i + 1]].split()
                    words.append(len(tokens))
                    gone, ranges = 0, []
                    if n:
                        a, z = _merged(lo[ends[i] - n : ends[i]], hi[ends[i] - n : ends[i]])
                        ranges = [{"lo": x, "hi": y} for x, y in zip(a.tolist(), z.tolist())]
                        gone = int((z - a).sum())
                        tokens = [t for x, y in zip([0, *z.tolist()], [*a.tolist(), len(tokens)]) for t in tokens[x:y]]
                    removed.append(gone)
                    kept.append(b" ".join(tokens).decode())
                    spans.append(ranges)
                yield batch(schema, b.column(0)[at:stop], words, removed, kept, spans)

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, spans array<struct<lo:int,hi:int>>")
