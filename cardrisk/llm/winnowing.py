"""Document fingerprints by winnowing, with DataFrame operations only.

The hashes of all ``gram`` consecutive words roll over the text; of every
``window`` consecutive hashes the smallest is chosen, the rightmost of
equals, and chosen hashes are kept with their positions.  So two texts that share
``window + gram - 1`` consecutive words share a chosen hash, whatever stands
around them.  A text of fewer words has one gram (its whole sequence), one with
fewer grams than a window has one choice, one without words has none.

A chosen entry is one long: 40 bits of hash above 24 bits that count the positions
down, so the smaller entry is the smaller hash or, of equals, the one further right.

``with_next`` pairs every document with the next by ``doc_id``, over the whole table:
ranges of ``doc_id`` and text hash become blocks, a window runs in each block, and a block's first
document is also sent to the block before.  The ranges' bounds come from a sample of bounded size and only say
where a row is worked on.  Rows equal in both, where they are many, are numbered in a written table and cut by their number.
No order over the table is built in one task.

Nulls and edges: a null text is empty; a null ``doc_id`` stands first; rows of one
``doc_id`` follow each other by text; the last document is followed by the first, a
single one by itself; an empty table gives an empty result.
Other columns are not read, whatever their names; a very long text is one array of words, and beyond
2**24 words positions begin again, so ties between words that far apart may go to the one further left.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardrisk.llm.common import prepare, written

GRAM, WINDOW = 3, 8
POSITION_BITS = 24
#: Blocks of ids for each shuffle partition, so that partitions come out even, and blocks
#: in all: their bounds are part of the plan.  Larger blocks sort on disk.
BLOCKS, MOST_BLOCKS = 4, 1 << 14
#: Rows drawn for each bound, and rows of equal id and text that may stand in one block.
SAMPLED, MOST_EQUAL = 16, 1000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body).getItem(0)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _rolled(words: Column, gram: int) -> Column:
    """Entries of all grams in order."""
    last = F.lit((1 << POSITION_BITS) - 1)

    def entry(first: Column, i: Column) -> Column:
        # beyond the end there are nulls, which the hash skips
        h = F.xxhash64(first, *[F.get(words, i + j) for j in range(1, gram)])
        return F.shiftleft(h, POSITION_BITS).bitwiseOR(last.cast("bigint") - F.pmod(i, last + 1).cast("bigint"))

    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (gram - 1), F.least(F.size(words), F.lit(1)))), entry)


def _least(entries: Column, window: int) -> Column:
    """The least of every ``window`` consecutive entries (of all, if they are fewer)."""
    if window == 1:
        return entries
    step = next(s for s in (4, 3, 2) if window % s == 0 or s == 2)
    if window % step:
        return _let(_least(entries, window - 1), lambda m: F.transform(F.slice(m, 1, F.greatest(F.size(m) - 1, F.least(F.size(m), F.lit(1)))), lambda x, i: F.least(x, F.get(m, i + 1))))
    stride = window // step

    def widen(m: Column) -> Column:
        kept = F.greatest(F.size(m) - (step - 1) * stride, F.least(F.size(m), F.lit(1)))
        return F.transform(F.slice(m, 1, kept), lambda x, i: F.least(x, *[F.get(m, i + j * stride) for j in range(1, step)]))

    return _let(_least(entries, stride), widen)


def chosen(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The chosen entries of a text, by position (an entry names its position, so equal ones are one choice)."""
    return _let(words_of(text), lambda w: _let(_rolled(w, gram), lambda e: F.array_distinct(F.when(F.size(e) < window, _shortest(e)).otherwise(_least(e, window)))))


def _shortest(entries: Column) -> Column:
    return F.filter(F.array(F.array_min(entries)), lambda x: x.isNotNull())


def hashes(entries: Column) -> Column:
    """The distinct hashes of some entries."""
    return F.array_distinct(F.transform(entries, lambda e: F.shiftright(e, POSITION_BITS)))


def positions(entries: Column) -> Column:
    """``hash, position`` (of the gram's first word) of every entry."""
    mask = (1 << POSITION_BITS) - 1
    return F.transform(entries, lambda e: F.struct(F.shiftright(e, POSITION_BITS).alias("hash"), (F.lit(mask) - e.bitwiseAND(F.lit(mask))).alias("position")))


def fingerprint(entries: Column) -> Column:
    """The chosen hashes in order, ten hexadecimal digits each."""
    return F.array_join(F.transform(entries, lambda e: F.lpad(F.lower(F.hex(F.shiftrightunsigned(e, POSITION_BITS))), 10, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike."""

    def share(both: Column) -> Column:
        either = F.size(a) + F.size(b) - both
        return F.when(either == 0, F.lit(1.0)).otherwise(both / either)

    return _let(F.size(F.array_intersect(a, b)), share)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_chars, marks`` (hash and position of every choice)."""
    prepare(docs.sparkSession, python=False)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.char_length(text).cast("bigint").alias("n_chars"), positions(chosen(text, gram, window)).alias("marks"))


def _places(places: list[tuple[int, int, int]]) -> Column:
    """Places in the order of documents as literals: id (null: least), text hash, number."""
    return F.array(*[F.struct(*[F.lit(x).cast("bigint").alias(n) for n, x in zip("abc", p)]) for p in places])


def _block(bounds: list[tuple[int, int, int]], value: Column) -> Column:
    """How many of the sorted bounds the value reaches, in two steps of about their square root."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    part = F.size(F.filter(_places([p[0] for p in parts]), lambda x: x <= value))
    inside = F.get(F.array(*[_places(p) for p in parts]), part - 1)
    return F.when(part > 0, (part - 1) * step + F.size(F.filter(inside, lambda x: x <= value))).otherwise(0)


def _placed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, place``; rows of equal id and text have equal places as long as they are few."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    source = source.withColumn("key", F.xxhash64("text")).withColumn("nr", F.lit(0).cast("bigint"))
    most = source.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if (most or 0) > MOST_EQUAL:
        source = written(source.withColumn("nr", F.monotonically_increasing_id()), "numbered-documents")
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("a"), F.col("key").alias("b"), F.col("nr").alias("c"))
    return source.select("doc_id", "text", place.alias("place"))


def _bounds(source: DataFrame, cuts: int) -> list[tuple[int, int, int]]:
    """At most ``cuts - 1`` places that cut the rows about evenly, from some ``SAMPLED`` rows a cut."""
    rows = source.count()
    if not rows:
        return []
    spread = F.pmod(F.xxhash64("place", F.monotonically_increasing_id()), F.lit(rows))  # equal rows are drawn each by itself
    drawn = sorted(tuple(r[0]) for r in source.select("place", spread.alias("x")).filter(F.col("x") < cuts * SAMPLED).select("place").collect())
    return sorted({drawn[len(drawn) * i // cuts] for i in range(1, cuts)}) if drawn else []


def with_next(docs: DataFrame, derived: dict[str, Column]) -> DataFrame:
    """``doc_id, text``, the ``derived`` columns (of ``text``), and ``next_text`` and ``next_*`` of the next document."""
    spark = prepare(docs.sparkSession, python=False)
    source = _placed(docs)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    block = _block(_bounds(source, min(partitions * BLOCKS, MOST_BLOCKS)), F.col("place"))
    # the least place of each block: as many rows as there are blocks
    heads = {r[0]: tuple(r[1]) for r in source.select(block.alias("block"), "place").groupBy("block").agg(F.min("place")).collect()}
    order = sorted(heads)
    if not order:
        order, heads = [0], {0: (0, 0, 0)}
    longs = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    at = F.array_position(longs(order), F.col("block")).cast("int")
    first = F.col("place") == F.element_at(_places([heads[b] for b in order]), at)
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(F.element_at(longs([order[i - 1] for i in range(len(order))]), at).alias("block"), F.lit(True).alias("guest"))
    rows = source.withColumn("block", block.cast("bigint"))
    rows = rows.select("doc_id", "text", "place", F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own))).alias("to"))
    rows = rows.select("doc_id", "text", "place", "to.block", "to.guest").repartition(partitions, "block").withColumns(derived)
    ordered = Window.partitionBy("block").orderBy("guest", "place", "text")
    names = ["text", *derived]
    return rows.withColumns({f"next_{n}": F.lead(n).over(ordered) for n in names}).filter(~F.col("guest")).select("doc_id", *names, *[f"next_{n}" for n in names])


def edited_pairs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every document, its edit (the last quarter replaced from the next document), and their choices.

    ``doc_id, n_chars, edited, marks, edited_marks, next_marks``.
    """
    pairs = with_next(docs, {"marks": chosen(F.col("text"), gram, window), "n_chars": F.char_length("text").cast("bigint")})
    cut = F.expr("cast(n_chars div 4 as int)")
    pairs = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut)))
    return pairs.select("doc_id", "n_chars", "edited", "marks", chosen(F.col("edited"), gram, window).alias("edited_marks"), "next_marks")
