"""Personal data: entities by pattern, disclosing terms by information content.

Emails, IP addresses, card and phone numbers are found by pattern and are the
protected entities.  A term that stands near an entity may give it away without
naming it.  How strongly is estimated from the corpus: the pointwise
mutual information of term and entity against the entity's information content,

    disclosure = log(P(entity | term) / P(entity)) / -log P(entity),

which is 1 for a term that occurs only beside the entity and 0 for one that
is independent.  Counts are over all documents: ``P(entity)`` is the share that holds it,
``P(entity | term)`` the share of the term's documents in which it stands
within ``NEAR`` characters of the entity.

Most values stand in one text only, so counts of the value alone say little.  A
pair of under ``SUPPORT`` different texts is shrunk towards independence,
``P(entity | term)`` by ``texts / (texts + 1)``: a term found nowhere else counts from 1,024
documents on, and copies of a text add nothing.  As a back-off the same measure is taken
for wider groups of values (an email's domain, an address' first three numbers, a
card's first six digits, and the kind), from ``SUPPORT`` different texts on.  A
term's disclosure is the highest of these.
A term at ``GENERALISE`` or more is generalised to its class, at ``REMOVE`` or more removed.

Terms are runs of at least three letters (code points from U+0080 on
count as letters), A-Z in lower case.  Document frequencies are counted
for the terms that stand near entities only: a bitmap of fixed size lets them pass.

Nulls and edges: a null or empty text has no spans; repeated rows have equal
spans each and count as documents each, but as one text; a null ``doc_id``
stays null; an empty table gives an empty result.
Other columns are not read, whatever their names; a very long text is searched as one string, in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm import kernels as K
from cardrisk.llm.common import join_docs, keyed, prepare, signed, text_slices, written
from cardrisk.llm.spans import SPANS, Taken, replaced

KINDS = ("email", "ip", "card", "phone", "term")
EMAIL, IP, CARD, PHONE, TERM = range(5)
NEAR, SUPPORT, GENERALISE, REMOVE = 60, 3, 0.9, 0.99
BITMAP_BITS = 24
#: Term counts that a task holds before it merges them.
HELD = 1_000_000

# The patterns of the entities.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[A-Za-z\u0080-\U0010ffff]{3,}")
_UPPER = re.compile(r"[A-Z]")

LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = done = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = max(at + 1, done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = [], m.start()
        for part in m.group().split("."):
            parts = [*parts, (at, part)] if part else []
            at += len(part) + 1
            if len(parts) == 4:
                # longer than any number up to 255, leading zeros aside
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for _, p in parts):
                    yield parts[0][0], at - 1
                parts = []


def entities(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all entities, leftmost and not overlapping within a kind."""
    out = [(a, EMAIL, z) for a, z in _emails(text)]
    out += [(a, IP, z) for a, z in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(_DIGIT.findall(m.group()))
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def _lower(s: str) -> str:
    return _UPPER.sub(lambda m: m.group().lower(), s)


def _identity(kind: int, value: str) -> str:
    """What makes two spans the same entity."""
    return f"{kind}:" + (_lower(value) if kind == EMAIL else value if kind == IP else "".join(_DIGIT.findall(value)))


def _groups(kind: int, identity: str) -> list[str]:
    """The entity and the wider groups that it belongs to, the kind last."""
    value = identity[2:]
    wider = value[value.index("@") :] if kind == EMAIL else value[: value.rindex(".") + 1] if kind == IP else value[:6] if kind == CARD else ""
    return [identity, *([f"{identity[:2]}{wider}*"] if wider else []), f"{identity[:2]}*"]


def _hashes(strings: list[str]) -> np.ndarray:
    raw = [s.encode() for s in strings]
    ends = np.cumsum([len(r) for r in raw])
    return K.word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


def detect(source: DataFrame) -> DataFrame:
    """``doc_id, text_key, base, near`` of every document; ``near`` has a row for each term beside an entity."""
    near = pa.struct([("entity", pa.list_(pa.int64())), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("base", pa.list_(span)), ("near", pa.list_(near))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, beside = [], []
            for text in b.column(2).to_pylist():
                found = entities(text)
                base.append([{"start": a, "kind": k, "end": z} for a, k, z in found])
                rows, taken = [], Taken(found)
                for a, kind, z in found:
                    groups = _groups(kind, _identity(kind, text[a:z]))
                    lo, hi = max(0, a - NEAR), z + NEAR
                    # one character more on each side tells whether a term is cut
                    for m in _TERM.finditer(text, max(0, lo - 1), hi + 1):
                        s, e = m.span()
                        if s < lo or e > hi or taken(s, e):
                            continue
                        rows.append((groups, _lower(m.group()), s, e))
                names = list(dict.fromkeys(x for r in rows for x in (*r[0], r[1])))
                h = dict(zip(names, signed(_hashes(names)).tolist())) if names else {}
                beside.append([{"entity": [h[g] for g in r[0]], "term": h[r[1]], "start": r[2], "end": r[3]} for r in rows])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(base, pa.list_(span)), pa.array(beside, pa.list_(near))], schema=schema)

    return source.mapInArrow(run, f"doc_id bigint, text_key bigint, base {SPANS}, near array<struct<entity:array<bigint>,term:bigint,start:int,end:int>>")


def term_documents(source: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, documents`` of (at least) the given terms, over all documents."""
    mask = (1 << BITMAP_BITS) - 1
    words = terms.select(F.col("term").bitwiseAND(F.lit(mask)).alias("spot")).groupBy(F.shiftright("spot", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits")).toPandas()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)  # of fixed size, whatever the corpus
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    shared = source.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        if not bitmap.any():
            return
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            term, back = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
            return term, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)

        for b in batches:
            for _, _, buf, offs in text_slices(b.column(0)):
                starts, ends, first = K.word_spans(np.where(LETTERS[buf], K.LOWER[buf], np.uint8(32)), offs)
                doc, long = K.row_of(first), ends - starts >= 3
                doc, starts, ends = doc[long], starts[long], ends[long]
                h = K.word_hashes(K.LOWER[buf], starts, ends)
                spot = h & np.uint64(mask)
                hit = (bitmap[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
                doc, h = doc[hit], h[hit]
                order = np.lexsort((doc, h))
                doc, h = doc[order], h[order]
                once = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])[: len(h)]
                held.append(np.unique(h[once], return_counts=True))
            if sum(len(t) for t, _ in held) > HELD:
                held = [merged()]
                if len(held[0][0]) > HELD // 2:  # a task of very many terms hands them on
                    yield pa.RecordBatch.from_arrays([pa.array(signed(held[0][0])), pa.array(held[0][1])], schema=schema)
                    held = []
        if held:
            term, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(signed(term)), pa.array(n)], schema=schema)

    return source.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("documents"))


def _beside(found: DataFrame) -> DataFrame:
    """``doc_id, text_key, level, entity, term, start, end``: each term with its entity (level 0) and that one's groups."""
    rows = found.filter(F.size("near") > 0).select("doc_id", "text_key", F.explode("near").alias("n"))
    return rows.select("doc_id", "text_key", F.posexplode("n.entity").alias("level", "entity"), "n.term", "n.start", "n.end")


def disclosures(found: DataFrame, source: DataFrame) -> DataFrame:
    """``entity, term, disclosure`` of the entities, and of the groups with enough support."""
    rows = _beside(found)
    # one row for each document, entity and term before anything is counted
    pairs = rows.groupBy("level", "entity", "term", "text_key", "doc_id").agg(F.lit(1).alias("one"))
    pairs = pairs.groupBy("level", "entity", "term", "text_key").agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.groupBy("level", "entity", "term").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("both"))
    pairs = written(pairs.filter((F.col("level") == 0) | (F.col("texts") >= SUPPORT)), "pii-pairs")
    holders = written(rows.groupBy("entity", "text_key", "doc_id").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count(F.lit(1)).alias("holders")), "pii-holders")
    documents = term_documents(source, pairs.select("term").distinct())
    total = found.agg(F.count(F.lit(1)).cast("double")).first()[0]
    kinds = [int(h) for h in signed(_hashes([f"{k}:*" for k in range(TERM)]))]
    wide = F.col("entity").isin(kinds)  # beside very many terms, but four rows of holders
    joined = pairs.filter(~wide).join(holders.filter(~wide), "entity").unionByName(pairs.filter(wide).join(F.broadcast(holders.filter(wide)), "entity"))
    alone = F.col("holders") / F.lit(total or 1.0)
    seen = F.col("both") / F.col("documents")
    given = F.when(F.col("texts") >= SUPPORT, seen).otherwise((F.col("texts") * seen + alone) / (F.col("texts") + 1))
    scored = joined.join(documents, "term")
    # an entity in every document has no information to disclose
    return scored.select("entity", "term", F.when(alone < 1, F.least(F.log(given / alone) / -F.log(alone), F.lit(1.0))).otherwise(0.0).alias("disclosure"))


def personal_data(docs: DataFrame, threshold: float = GENERALISE) -> DataFrame:
    """``doc_id, text_key, base, terms`` of every document; ``terms`` have the disclosure of each."""
    prepare(docs.sparkSession)
    source = keyed(docs)
    found = written(detect(source), "pii-found")
    pairs = written(disclosures(found, source).filter(F.col("disclosure") >= threshold), "pii-disclosing")
    rows = _beside(found).join(pairs, ["entity", "term"]).groupBy("doc_id", "text_key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = rows.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", F.lit(TERM).alias("kind"), "end", "disclosure"))).alias("terms"))
    empty = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,disclosure:double>>)")
    return join_docs(found, terms, "left").select("doc_id", "text_key", "base", F.coalesce("terms", empty).alias("terms"))


def sanitised(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``doc_id, text, replaced``: entities stand as their kind, disclosing terms generalised or removed."""
    found = personal_data(docs, generalise)
    source = keyed(docs)
    spans = found.select("doc_id", "text_key", "base", "terms").dropDuplicates(["doc_id", "text_key"])
    joined = join_docs(source, spans).select("doc_id", "text", "base", "terms")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("replaced", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for text, base, terms in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                gone = {t["start"] for t in terms if t["disclosure"] >= remove}
                spans = [(s["start"], s["kind"], s["end"]) for s in base] + [(t["start"], -1 if t["start"] in gone else TERM, t["end"]) for t in terms]
                texts.append(replaced(text, spans, lambda kind, value: "" if kind < 0 else "[NAME]" if kind == TERM and value[:1].isupper() else f"[{KINDS[kind].upper()}]"))
                counts.append(len(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], schema=schema)

    return joined.mapInArrow(run, "doc_id bigint, text string, replaced bigint")
