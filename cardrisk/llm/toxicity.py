"""Toxicity scores after noisy-channel deobfuscation.

1. Character language model: trigram counts over the words of all documents
   (letters folded to a-z), summed in each task and then over tasks.
2. Channel: an obfuscated token is a lattice.  A symbol or digit may stand for
   letters (leetspeak) or for nothing (a separator), a repeated letter for one or two,
   and letters that stand apart may belong to one word or to several.  Viterbi
   finds the reading with the best channel and language model score.
3. Classifier: words and word beginnings of the texts, restored ones included, whose
   presence goes with the label beyond chance; a logistic regression weighs them.  It is
   fitted on at most ``SAMPLE`` labelled rows of each class, those of the smallest
   hash of the id; its intercept is set to the share of the label among all
   labelled rows that may be learned from.
4. Every whole text is scored.

Rows whose ``crc32(doc_id as text) mod 4`` is 2 are never learned from; labels,
lang, source and doc_id are no input of a score.

Nulls and edges: a null or empty text has the score of a text without any known
word; a null ``doc_id`` is not held out and has no label; contradicting labels
of one id all count; repeated rows are scored each; without labels the
score is 0; an empty table gives an empty result.
Other columns are kept, whatever their names (a column called as the score is the caller's to avoid in ``scored``);
a very long text is read token by token.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.llm.common import free_name, prepare, text_slices, written

#: Labelled rows of each class that the classifier is fitted on, at most.
SAMPLE = 6000
#: Words and beginnings in the model, at most, and the evidence (G-squared) that each needs.
FEATURES, EVIDENCE = 4096, 20.0
THRESHOLD = 0.3
BEGINNINGS = (3, 4, 5, 6)
#: Longer tokens are decoded in windows of this length, each half over the one before.
LONGEST = 64

# What a symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "#": "h",
    "*": "aeiou",
}
COST_LEET, COST_DROP, COST_REPEAT, COST_BREAK = -0.7, -1.0, -0.7, -1.5

A = 27  # symbols: 0 stands between words, 1 to 26 are a to z
_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Symbol of each code point of the basic plane: its base letter, or 0."""
    if not _FOLD:
        table = np.zeros(1 << 16, np.uint8)
        for p in range(0x250):
            base = unicodedata.normalize("NFD", chr(p))[0].lower()
            if "a" <= base <= "z":
                table[p] = ord(base) - 96
        _FOLD.append(table)
    return _FOLD[0]


def trigram_counts(texts: list[str]) -> np.ndarray:
    points = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
    s = fold_table()[np.minimum(points, 0xFFFF)].astype(np.int32)
    a, b, c = s[:-2].copy(), s[1:-1], s[2:]
    a[b == 0] = 0
    keep = (b > 0) | (c > 0)
    return np.bincount((a * A + b)[keep] * A + c[keep], minlength=A**3)


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities (27, 27, 27) of a symbol after two others, from all documents."""
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(A**3, np.int64)
        for b in batches:
            for lo, hi, _, _ in text_slices(b.column(0)):
                total += trigram_counts([t or "" for t in b.column(0)[lo:hi].to_pylist()])
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], schema=schema)

    sums = docs.select("text").mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()  # at most 27**3 rows
    counts = np.zeros(A**3)
    counts[sums["gram"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=np.float64)
    counts = counts.reshape(A, A, A)
    single = (counts.sum((0, 1)) + 1) / (counts.sum() + A)
    pairs = counts.sum(0)
    double = (pairs + 10 * single) / (pairs.sum(1, keepdims=True) + 10)
    return np.log((counts + 5 * double[None]) / (counts.sum(2, keepdims=True) + 5))


class Channel:
    """Decodes obfuscated tokens under a character language model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.fold = fold_table()

    def _symbol(self, ch: str) -> int:
        return int(self.fold[ord(ch)]) if ord(ch) < 0x10000 else 0

    def reads(self, ch: str) -> bool:
        """Whether a character may stand for a letter of a-z."""
        return ch in LEET or self._symbol(ch) > 0

    def lattice(self, token: str, spelled: bool = False) -> list[list[tuple[int | None, float]]]:
        """For each character its readings: a symbol or nothing, and the cost.

        If ``spelled``, a symbol that may stand for a letter does, and two of them stand for two.
        """
        out, i = [], 0
        while i < len(token):
            ch, run = token[i], 1
            while i + run < len(token) and token[i + run] == ch:
                run += 1
            i += run
            symbol = self._symbol(ch)
            if symbol:
                out.append([(symbol, 0.0)])
                if run > 1:
                    out.append([(symbol, 0.0 if run == 2 else COST_REPEAT), (None, COST_REPEAT if run > 2 else 3 * COST_REPEAT)])
            elif ch.isspace():
                out.append([(None, 0.0), (0, COST_BREAK)])
            elif ch in LEET:
                readings = LEET[ch]
                stands = [(ord(c) - 96, COST_LEET - math.log(len(readings))) for c in readings]
                if spelled:
                    out += [stands, *[stands if run == 2 else [*stands, (None, 0.0)]] * (run > 1)]
                else:
                    out += [[*stands, (None, COST_DROP)], *[[*stands, (None, 0.0)]] * (run > 1)]
            else:
                out.append([(None, COST_DROP), (0, COST_DROP + COST_BREAK)])
        return out

    def decode(self, token: str, spelled: bool = False) -> str:
        """The best reading: words of a-z, a space between."""
        model = self.model
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for readings in [*self.lattice(token, spelled), [(0, 0.0)]]:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in states.items():
                for symbol, cost in readings:
                    if symbol is None or (symbol == 0 and b == 0):
                        key, total, way = (a, b), score + cost, path
                    else:
                        key = (b, symbol) if b and symbol else (0, symbol)
                        total, way = score + cost + model[a][b][symbol], (symbol, path)
                    if key not in after or total > after[key][0]:
                        after[key] = (total, way)
            states = after
        _, path = max(states.values(), key=lambda s: s[0])
        out = []
        while path:
            out.append(chr(96 + path[0]) if path[0] else " ")
            path = path[1]
        return "".join(reversed(out)).strip()


# three or more single characters that stand apart
APART = re.compile(r"(?<!\S)(?:\S\s++){2,}\S(?!\S)")
_RUN = re.compile(r"(.)\1\1")
_LONG_RUN = re.compile(r"(.)\1{3,}")
_SAME = re.compile(r"(.)\1*")
#: What stands around words; a symbol of these may belong to the word.
_EDGE = "'\"()[]{}.,;:?!-_*$#%&~/\\|<>=+^`"


class Reader:
    """The words of a text, obfuscated ones also as restored, and their model features."""

    KEPT = 400_000

    def __init__(self, channel: Channel):
        self.channel = channel
        self.seen: dict[str, tuple[str, ...]] = {}

    def words(self, token: str) -> tuple[str, ...]:
        core = token.strip(_EDGE)
        after = token[len(token.rstrip(_EDGE)) :] if core else ""
        # symbols of the end that may be letters
        ends = [m for m in _SAME.finditer(after) if m.group(1) in LEET]
        if core.isalpha() and not _RUN.search(core) and not ends and (len(token) == len(core) or token[0] not in "$@!|+(<"):
            return (core,)
        if not any(self.channel.reads(c) for c in token):
            return (core,) if core else ()
        if len(token) > LONGEST:
            token = _LONG_RUN.sub(r"\1\1\1", token)  # a longer run reads the same
            if len(token) > LONGEST:
                half = LONGEST // 2
                parts = [token[i : i + LONGEST] for i in range(0, len(token) - half, half)]
                return tuple(dict.fromkeys([core, *(w for p in parts for w in self.words(p))]))
            return tuple(dict.fromkeys([core, *self.words(token)]))
        decode = self.channel.decode
        found = [core, *decode(core).split()]
        if token[0] in "$@!|+(<" and token[:2] != token[0] * 2:
            found += decode(token[0] + core).split()
        if not any(c.isalpha() for c in token):  # '455': as the letters that it stands for
            found += [w for t in {core, core + after, token} for w in decode(t, True).split()]
        elif ends:
            # the symbols of the end, or the first of them, as letters
            heads = {core, token[0] + core} if token[0] in "$@!|+(<" else {core}
            found += [w for h in heads for m in ends[:3] for s in (False, True) for w in decode(h + after[: m.end()], s).split()]
        return tuple(dict.fromkeys(w for w in found if w))

    def features(self, token: str) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f for w in self.words(token) for f in (w, *(w[:n] + "~" for n in BEGINNINGS if len(w) > n))))

    def text(self, text: str) -> set[str]:
        """All tokens of a text; characters that stand apart once more, as one token."""
        low = text.lower()
        tokens = set(low.split())
        for m in APART.finditer(low):
            tokens.add(" ".join(m.group().split()))
        return tokens

    def apart(self, token: str) -> tuple[str, ...]:
        words = self.channel.decode(token).split() if any(map(self.channel.reads, token)) else []
        if not all(c.isalpha() or c == " " or c not in LEET for c in token):
            words += self.channel.decode(token, True).split()
        return tuple(dict.fromkeys(f for w in words for f in (w, *(w[:n] + "~" for n in BEGINNINGS if len(w) > n))))

    def of(self, token: str) -> tuple[str, ...]:
        got = self.seen.get(token)
        if got is None:
            got = self.apart(token) if " " in token else self.features(token)
            if len(self.seen) > self.KEPT:
                self.seen.clear()
            self.seen[token] = got
        return got


def held_out(doc_id: Column) -> Column:
    """Rows that must not be learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _fit(rows: list[list[int]], y: np.ndarray, n: int, prior: float, ridge: float = 1e-4, steps: int = 2000) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features, classes weighed alike, by accelerated gradient steps.

    The intercept is moved to the given share of 1.
    """
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((c for r in rows for c in r), np.int64, len(at))
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    step = 4.0 / (1 + max((len(r) for r in rows), default=0))  # the gradient changes at most so fast
    w = v = np.zeros(n + 1)  # the last is the intercept
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(v[n] + np.bincount(at, v[col], len(rows)))))
        g = weight * (p - y)
        new = v - step * np.append(np.bincount(col, g[at], n) + ridge * v[:n], g.sum())
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        w, v = new, new + (before - 1) / t * (new - w)
    return w[:n], w[n] + math.log(prior / (1 - prior))


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, sample: int = SAMPLE) -> tuple[dict[str, float], float]:
    """Feature weights and intercept."""
    spark = docs.sparkSession
    learn = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).filter("_id is not null and _toxic in (0, 1)").filter(~held_out(F.col("_id")))
    share = {r[0]: r[1] for r in learn.groupBy("_toxic").agg(F.count(F.lit(1))).collect()}
    if not share.get(1):
        return {}, -math.inf
    prior = (share[1] + 0.5) / (sum(share.values()) + 1)
    picked = learn.filter("_toxic = 1").orderBy(F.xxhash64("_id"), "_id").limit(sample).unionByName(learn.filter("_toxic = 0").orderBy(F.xxhash64("_id"), "_id").limit(sample))
    # at most 2 * sample rows: bounded, so it may be broadcast; a copied text is learned once
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "_id").select("text", "_toxic")
    rows = written(rows.withColumn("_key", F.xxhash64("text")).dropDuplicates(["_key", "_toxic"]).select("text", "_toxic"), "toxic-sample")
    rows = rows.repartition(max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")) // 4), F.xxhash64("text"))
    lm = spark.sparkContext.broadcast(model)
    schema = pa.schema([("feature", pa.string()), ("n1", pa.int64()), ("n0", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = Reader(Channel(lm.value)), {}
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f in {f for t in reader.text(text) for f in reader.of(t)}:
                    held.setdefault(f, [0, 0])[1 - y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())], schema=schema)

    ones, zeros = (rows.filter(F.col("_toxic") == y).count() for y in (1, 0))
    sums = rows.mapInArrow(count, "feature string, n1 bigint, n0 bigint").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    n, everyone = F.col("n1") + F.col("n0"), ones + zeros

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    pairs = [(F.col("n1"), n * ones), (F.col("n0"), n * zeros), (ones - F.col("n1"), (everyone - n) * ones), (zeros - F.col("n0"), (everyone - n) * zeros)]
    evidence = 2 * sum((part(seen, total / everyone) for seen, total in pairs), F.lit(0.0))
    best = sums.withColumn("g2", evidence).filter((F.col("g2") >= EVIDENCE) & (F.col("n1") * F.lit(zeros) > F.col("n0") * F.lit(ones)))
    names = [r[0] for r in best.orderBy(F.desc("g2"), "feature").limit(FEATURES).select("feature").collect()]
    index = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})
    kind = pa.schema([("toxic", pa.int32()), ("found", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, known = Reader(Channel(lm.value)), index.value
        for b in batches:
            found = [sorted({known[f] for t in reader.text(text) for f in reader.of(t) if f in known}) for text in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.list_(pa.int32()))], schema=kind)

    data = rows.mapInArrow(encode, "toxic int, found array<int>").collect()  # the bounded sample, as feature numbers
    order = sorted((r["found"], r["toxic"]) for r in data)
    weights, intercept = _fit([r[0] for r in order], np.array([r[1] for r in order], float), len(names), prior)
    return dict(zip(names, weights.tolist())), intercept


def scored(docs: DataFrame, labels: DataFrame, column: str = "score", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with all its columns and a score between 0 and 1."""
    spark = prepare(docs.sparkSession)
    model = language_model(docs)
    weights, intercept = fit(docs, labels, model, sample)
    shared = spark.sparkContext.broadcast((model, weights, intercept))  # 27**3 numbers and at most FEATURES words
    body, names = free_name("_text_for_score", docs.columns), docs.columns
    source = docs.withColumn(body, F.coalesce(F.col("text"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights, intercept = shared.value
        reader = Reader(Channel(model))
        seen: dict[str, tuple[str, ...]] = {}
        for b in batches:
            out = []
            for text in b.column(len(names)).to_pylist():
                found: set[str] = set()
                for t in reader.text(text):
                    hit = seen.get(t)
                    if hit is None:
                        hit = tuple(f for f in (reader.apart(t) if " " in t else reader.features(t)) if f in weights)
                        if len(seen) > reader.KEPT:
                            seen.clear()
                        seen[t] = hit
                    if hit:
                        found.update(hit)
                z = intercept + sum(weights[f] for f in sorted(found))
                out.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.float64())], names=[*names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return source.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score under the threshold, with all their columns."""
    score = free_name("_toxic_score", docs.columns)
    return scored(docs, labels, score).filter(F.col(score) < threshold).drop(score)
