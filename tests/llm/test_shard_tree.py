"""The k-d tree against a small recursive one, and tables of awkward ids and dimensions; helper names as extra columns."""

import collections
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from cardrisk.llm.sharding import BITS, kd_shards


def _tie(doc, text):
    seed = 42 if doc is None else xxhash.xxh64_intdigest(struct.pack("<q", doc), 42)
    h = xxhash.xxh64_intdigest((text or "").encode(), seed)
    return h % (1 << BITS)  # of the unsigned hash as of the signed one: 2**64 is a multiple


def tree_by_hand(rows, shards):
    """``rows``: (doc_id, text, values...); the shard of each row as a multiset of (shard, doc_id, text)."""
    dims = range(2, len(rows[0]))
    rank = {}
    for d in dims:
        given = [r[d] for r in rows if r[d] is not None]
        order = sorted({v.encode() if isinstance(v, str) else v for v in given})
        if all(isinstance(v, int) for v in given):
            rank[d] = lambda v, low=min(given, default=0): 0 if v is None else v - low + 1
        else:
            rank[d] = lambda v, order=order: 0 if v is None else order.index(v.encode() if isinstance(v, str) else v) + 1
    points = [(tuple(rank[d](r[d]) for d in dims), _tie(r[0], r[1]), k, len((r[1] or "").encode()) + 1) for k, r in enumerate(rows)]
    width = [max((p[0][i] for p in points), default=1) or 1 for i in range(len(dims))]
    out = collections.Counter()

    def split(own, first, k):
        if k == 1 or not own:
            for p in own:
                out[first, rows[p[2]][0], rows[p[2]][1]] += 1
            return
        span = [(max(p[0][i] for p in own) - min(p[0][i] for p in own)) / width[i] for i in range(len(dims))]
        wide = max(range(len(dims)), key=lambda i: (span[i], -i))
        own = sorted(own, key=lambda p: (p[0][wide], p[1], p[2]))
        want, upto, at = sum(p[3] for p in own) * (k // 2) / k, 0, 0
        while upto < want:
            upto, at = upto + own[at][3], at + 1
        split(own[:at], first, k // 2)
        split(own[at:], first + k // 2, k - k // 2)

    split(points, 0, shards)
    return out


def _placed(df, shards, dims):
    return collections.Counter((r["shard"], r["doc_id"], r["size"], r["text_crc32"]) for r in kd_shards(df, dims, shards).collect())


def _seen(tree):
    out = collections.Counter()
    for (s, i, t), n in tree.items():
        out[s, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())] += n
    return out


@pytest.mark.parametrize("shards", [2, 5, 8])
def test_tree_is_the_recursive_one(spark, shards):
    rows = []
    for k in range(200):
        text = None if k % 17 == 0 else "word " * (k * 7 % 23)
        rows.append((k * k % 101 if k % 9 else None, text, None if k % 11 == 0 else f"https://host.example/{k % 6}", float(k % 13) / 7, k % 29))
    rows += rows[:20] + [rows[5]] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double, n int").repartition(3)
    assert _placed(df, shards, ["source", "weight", "n", "doc_id"]) == _seen(tree_by_hand([(*r, r[0]) for r in rows], shards))


def _balanced(rows, shards, largest):
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 6 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("ids", ["hashed", "null", "one", "ends"])
def test_any_ids(spark, ids):
    """64-bit hashed ids, no ids, one id, the ends of the range: shards of equal bytes each time."""
    of = {"hashed": lambda k: xxhash.xxh64_intdigest(str(k)) - (1 << 63), "null": lambda k: None, "one": lambda k: 7, "ends": lambda k: (1 << 63) - 1 if k % 2 else -(1 << 63)}[ids]
    rows = [(of(k), "x" * (k * 31 % 97) if k % 3 else "same text", "en") for k in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    placed = kd_shards(df, ["lang", "doc_id"]).collect()
    assert len(placed) == 800
    _balanced(placed, 8, 98)


def test_equal_rows_are_split(spark):
    df = spark.createDataFrame([(3, "the very same", "en")] * 400, "doc_id long, text string, lang string").repartition(4)
    assert sorted(r["count"] for r in kd_shards(df).groupBy("shard").count().collect()) == [50] * 8


@pytest.mark.parametrize("kind, value", [("date", "date_add(date'2020-01-01', cast(id as int))"), ("decimal(9,4)", "cast(id / 4000.0 as decimal(9,4))"), ("timestamp", "timestamp_micros(id * 1000)"), ("boolean", "id % 2 = 0")])
def test_dimensions_of_any_kind(spark, kind, value):
    df = spark.range(400).selectExpr("id as doc_id", "repeat('t', 9) as text", f"cast({value} as {kind}) as lang")
    placed = kd_shards(df, ["lang"], 4).collect()
    _balanced(placed, 4, 10)
    if kind not in ("boolean",):  # shards are ranges of the dimension
        assert [max(r["doc_id"] for r in placed if r["shard"] == s) for s in range(4)] == [99, 199, 299, 399]


def test_strings_of_one_long_prefix_are_split_by_their_ends(spark):
    df = spark.range(400).selectExpr("400 - id as doc_id", "repeat('t', 9) as text", "concat('https://www.example.com/path/', lpad(id, 6, '0')) as source")
    placed = kd_shards(df, ["source"], 4).collect()
    assert [max(r["doc_id"] for r in placed if r["shard"] == s) for s in range(4)] == [400, 300, 200, 100]


def test_no_python_in_the_tree(docs):
    plan = kd_shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    from cardrisk.llm.sharding import _rows

    state = _rows(docs.sparkSession, ["node", "want", "cut"], [(0, 1.5, None), (4, 2.0, 1 << 60)])
    assert [tuple(r) for r in state.collect()] == [(0, 1.5, None), (4, 2.0, 1 << 60)]
    plan = state._jdf.queryExecution().toString()
    assert "Python" not in plan and "RDD" not in plan


CLASHES = ["_toxic_score", "_text_for_score", "_secret_spans", "_bad_id", "_bad_key", "_kept_id", "_kept_key", "_key", "_copy", "text_key", "score", "row", "hash", "pair", "node", "label"]


def test_stages_keep_columns_of_clashing_names(spark, make):
    from cardrisk.llm.decontaminate import decontaminate
    from cardrisk.llm.secret_scan import redacted
    from cardrisk.llm.simhash import keep_one
    from cardrisk.llm.toxicity import keep_clean

    plain = spark.createDataFrame([(k, f"some words of text number {k} that stand here") for k in range(20)], "doc_id long, text string")
    df = plain.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(20)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "some words of text number 3 that stand here")], "item_id long, text string")
    for out in (keep_clean(df, labels, 2.0), redacted(df), decontaminate(df, items), keep_one(df)):
        rows = out.collect()
        assert out.columns == df.columns and rows
        assert all(r[c] == f"own {c}" for r in rows for c in CLASHES)


@pytest.mark.parametrize("operator", ["pack", "near_duplicates", "token_counts", "dedup", "kd_shards", "personal_data", "fingerprints", "token_alignment"])
def test_operators_do_not_read_columns_of_clashing_names(spark, operator):
    import importlib

    home = {"pack": "packing", "near_duplicates": "simhash", "dedup": "substring_dedup", "kd_shards": "sharding", "personal_data": "pii", "fingerprints": "winnowing"}
    run = getattr(importlib.import_module(f"cardrisk.llm.{home.get(operator, operator)}"), operator)
    if operator == "kd_shards":
        run = lambda d, whole=run: whole(d, ["doc_id"], 3)
    plain = spark.createDataFrame([(k % 7, f"some words of text number {k % 9} that stand here") for k in range(20)], "doc_id long, text string").coalesce(1)
    names = [*CLASHES, "size", "tie", "d0", "ids", "task", "n", "block", "start", "hashes", "fingerprint", "component_id", "pairs", "links", "n_a"]
    clashing = plain.select("*", *[F.lit(f"own {c}").alias(c) for c in dict.fromkeys(names)])
    of = lambda df: sorted(map(str, run(df).collect()))
    assert of(clashing) == of(plain)


@pytest.mark.parametrize("ids", ["none", "one", "hashed"])
@pytest.mark.parametrize("most", [1000, 3])
def test_next_documents_of_any_ids(spark, monkeypatch, ids, most):
    """Null, equal and 64-bit ids: every row has the next one's text, and rows are spread over blocks."""
    from cardrisk.llm import winnowing as W

    monkeypatch.setattr(W, "MOST_EQUAL", most)
    of = {"none": lambda k: None, "one": lambda k: 7, "hashed": lambda k: xxhash.xxh64_intdigest(str(k)) - (1 << 63)}[ids]
    rows = [(of(k % 300), f"text {k % 300} of some words " + "x" * (k % 5)) for k in range(600)] + [(of(5), "the very same text")] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = W.with_next(df, {"n": F.length("text")}).select("doc_id", "text", "next_text", "next_n").collect()
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    expected = collections.Counter((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    assert collections.Counter((r["doc_id"], r["text"], r["next_text"]) for r in found) == expected
    assert all(r["next_n"] == len(r["next_text"]) for r in found)
    source = W._placed(df)
    bounds = W._bounds(source, 32)
    sizes = source.groupBy(W._block(bounds, F.col("place"))).count().collect()
    assert max(r["count"] for r in sizes) <= (130 if most == 1000 else 100) and len(sizes) > 16
