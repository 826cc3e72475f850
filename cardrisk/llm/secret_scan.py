"""Secrets: patterns, and zstandard novelty of strings in a sensitive context.

Assignments, access keys and long hexadecimal strings are found by pattern.
Other strings that stand after a sensitive word are candidates, and so are those that
follow a candidate on the same or the next line (blocks of base64).  Each is
measured: its marginal compressed bytes, ``|zstd(context + candidate)| - |zstd(context)|``,
with the code around it, other occurrences of the candidate left out, as context and a dictionary of the corpus' identifiers (its
most frequent words by different texts, of ``SPREAD`` texts at least) behind both.  What repeats the
context or common identifiers costs a few bytes; random strings cost nearly
their length.  Candidates at ``NOVELTY`` bytes a character or more are reported, those that
follow each other also if they are as dear together: random lines lie close above the bound.
Matches of the patterns are measured too, and stay whatever they cost.

Nulls and edges: a null or empty text has no spans; repeated rows have equal
spans each; a null ``doc_id`` stays null; a corpus without words has an empty
dictionary; an empty table gives an empty result.  Other columns are kept, whatever their
names; a very long text is searched as one string, near its sensitive words only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.llm import kernels as K
from cardrisk.llm.common import free_name, prepare, signed, text_hash, text_slices, top_rows, written
from cardrisk.llm.spans import Taken, replaced

KINDS = ("assign", "access", "hex", "novel")
ASSIGN, ACCESS, HEX, NOVEL = range(4)
#: Words of the dictionary and its bytes, at most.
IDENTIFIERS, DICTIONARY_BYTES = 4096, 1 << 16
#: Bits of the bitmap of repeated texts' hashes.
BITMAP_BITS = 24
#: Different texts that a word of the dictionary stands in, at least.
SPREAD = 10
NOVELTY, AROUND, REACH, LEAST = 0.7, 200, 48, 6

# The patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_SENSITIVE = re.compile(r"passw|passphrase|secret|token|api[_-]?key|credential|private|bearer|authori[sz]ation|signature", re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{%d,}={0,2}" % LEAST)  # a key and its value are two
_LOWER_LETTER, _UPPER_LETTER, _DIGIT = re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]")
#: Words written as such, with a capital or in capitals: they need a digit.
_PLAIN = re.compile(r"[+/_.=-]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[+/_.=-]+(?:[A-Z]?[a-z]+|[A-Z]+))*[+/_.=-]*")
#: What may stand between candidates of adjacent lines: quotes, marks and one line break.
_BETWEEN = re.compile(r"""["'`,;\x20\t]{0,16}(?:(?:\\r)?\\n|\r?\n)?["'`,;#*>|\x20\t]{0,16}""")


def patterns(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns, leftmost and not overlapping within a kind."""
    out = [(m.start(), ASSIGN, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Strings of mixed characters that begin within ``REACH`` of a sensitive word, or follow one that does, and are no match yet."""
    out, done, taken = [], 0, Taken(base)
    for s in _SENSITIVE.finditer(text):
        at, last = max(s.end(), done), s.end() + REACH
        # only what is near is searched; a candidate is then taken to its end
        while at <= last and (near := _CANDIDATE.search(text, at, last + LEAST)):
            m = _CANDIDATE.match(text, near.start())
            at = done = m.end()
            kinds = sum(bool(p.search(m.group())) for p in (_LOWER_LETTER, _UPPER_LETTER, _DIGIT))
            if kinds >= 2 and not _PLAIN.fullmatch(m.group()):
                at = done = _BETWEEN.match(text, m.end()).end()
                last = max(last, at)
                if not taken(m.start(), m.end()):
                    out.append((m.start(), NOVEL, m.end()))
    return out


class Novelty:
    """Marginal compressed bytes behind a dictionary."""

    def __init__(self, identifiers: bytes):
        import zstandard

        words = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(identifiers) >= 8 else None
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=words, write_content_size=False).compress

    def bytes(self, text: str, start: int, end: int) -> int:
        # what is written twice does not explain itself: other occurrences are blanked, also those that reach into the context
        same, wide = text[start:end].strip("+/_.=-") or text[start:end], AROUND + end - start
        before = text[max(0, start - wide) : start].replace(same, " " * len(same))[-AROUND:]
        context = (before + text[end : end + wide].replace(same, " " * len(same))[:AROUND]).encode()
        return len(self.compress(context + text[start:end].encode())) - len(self.compress(context))


def repeated_texts(docs: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap of ``2**bits`` bits with those of every text hash that occurs twice: at most ``2**bits / 8`` bytes reach the driver.

    A text whose bit is not set stands in one row alone.
    """
    twice = docs.groupBy(text_hash().alias("key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    spot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    words = twice.groupBy(F.shiftright(spot, 6).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(key & {63} as int))")).alias("bits"))
    rows = words.toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["word"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def identifiers(docs: DataFrame, words: int = IDENTIFIERS, size: int = DICTIONARY_BYTES) -> bytes:
    """The words in most different texts, those in most last, at most ``size`` bytes; copies count once."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    marked = spark.sparkContext.broadcast(repeated_texts(source))
    counted = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def kept(alone: bool):
        # rows of texts that stand alone, or of those that may not
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bitmap = marked.value
            for b in batches:
                key = b.column(1).to_numpy().view(np.uint64)
                spot = key & np.uint64((bitmap.size << 6) - 1)
                hit = (bitmap[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
                yield b.filter(pa.array(~hit if alone else hit))

        return run

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return count(kept(True)(batches))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [_once(*_slice_words(buf, offs)[2:]) for _, _, buf, offs in text_slices(b.column(0))]
            word, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), [])
            yield pa.RecordBatch.from_arrays([pa.array(signed(word)), pa.array(n, pa.int64())], schema=counted)

    keyed_texts = source.select("text", text_hash().alias("key"))
    # only texts that may have copies are shuffled, one of each
    copies = keyed_texts.mapInArrow(kept(False), "text string, key bigint").dropDuplicates(["key"])
    parts = keyed_texts.mapInArrow(once, "word bigint, n bigint").unionByName(copies.mapInArrow(count, "word bigint, n bigint"))
    totals = written(parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= SPREAD), "secret-words")
    top = [r["word"] for r in top_rows(totals, "n", "word", words)]
    shared = spark.sparkContext.broadcast(np.sort(np.array(top, np.int64)))
    spelled = pa.schema([("word", pa.int64()), ("spelling", pa.string())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = shared.value, {}
        for b in batches if len(wanted) else ():
            for _, _, buf, offs in text_slices(b.column(0)):
                starts, ends, h, _ = _slice_words(buf, offs)
                h = signed(h)
                hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h)
                new, first = np.unique(h[hit], return_index=True)
                for word, i in zip(new.tolist(), hit[first].tolist()):
                    if word not in seen:
                        seen[word] = buf[starts[i] : ends[i]].tobytes().decode()
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.string())], schema=spelled)

    rows = source.mapInArrow(spell, "word bigint, spelling string").groupBy("word").agg(F.min("spelling").alias("spelling"))
    spelling = {r[0]: r[1].encode() for r in rows.collect()}  # at most `words` rows
    out = b""
    for word in top:
        if len(out) + len(spelling[word]) < size:
            out = spelling[word] + b" " + out
    return out


def _slice_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = K.word_spans(buf, offs)
    short = ends - starts <= 40  # longer ones are no identifiers
    starts, ends, doc = starts[short], ends[short], K.row_of(first)[short]
    return starts, ends, K.word_hashes(buf, starts, ends), doc


def _once(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Each word once for each document that holds it."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    return h[np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])[: len(h)]]


def found_spans(text: str, measure: Callable[[str, int, int], int], novelty: float = NOVELTY) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, bytes)`` of the patterns and of the novel candidates, alone or with those next to them."""
    base = patterns(text)
    alone = candidates(text, base)
    blocks: list[list[tuple[int, int, int]]] = []
    for s in alone:
        if blocks and _BETWEEN.fullmatch(text, blocks[-1][-1][2], s[0]):
            blocks[-1].append(s)
        else:
            blocks.append([s])
    whole = {s for b in blocks if len(b) > 1 and measure(text, b[0][0], b[-1][2]) >= novelty * (b[-1][2] - b[0][0]) for s in b}
    out = [(a, k, z, measure(text, a, z)) for a, k, z in sorted(base + alone)]
    return [s for s in out if s[1] != NOVEL or s[3] >= novelty * (s[2] - s[0]) or s[:3] in whole]


SPAN = "struct<start:int,kind:int,end:int,bytes:int>"


def scanned(docs: DataFrame, column: str = "spans", novelty: float = NOVELTY, redact: bool = False) -> DataFrame:
    """``docs`` with all its columns and a list of spans, each with its marginal compressed bytes.

    With ``redact`` the spans are replaced in ``text`` by their kind, and ``n_chars``, if there, is counted anew.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(identifiers(docs))  # at most DICTIONARY_BYTES
    names, at = docs.columns, docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("bytes", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Novelty(shared.value).bytes
        for b in batches:
            spans, texts = [], []
            for text in b.column(at).to_pylist():
                found = [{"start": a, "kind": k, "end": z, "bytes": cost} for a, k, z, cost in found_spans(text, measure, novelty)] if text else []
                spans.append(found)
                if redact:
                    texts.append(replaced(text, [(s["start"], s["kind"], s["end"]) for s in found], lambda k, _: f"[{KINDS[k].upper()}]") if found else text)
            columns = list(b.columns)
            if redact:
                columns[at] = pa.array(texts, b.column(at).type)
                if "n_chars" in names and pa.types.is_integer(b.column(names.index("n_chars")).type):
                    old = b.column(names.index("n_chars"))
                    counts = [len(t) if s else n for t, s, n in zip(texts, spans, old.to_pylist())]
                    columns[names.index("n_chars")] = pa.array(counts, old.type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T._parse_datatype_string(f"array<{SPAN}>"))])
    return docs.mapInArrow(run, schema)


def redacted(docs: DataFrame) -> DataFrame:
    """All documents with their columns, the secrets in their texts replaced."""
    spans = free_name("_secret_spans", docs.columns)
    return scanned(docs, spans, redact=True).drop(spans)
