"""Each operator against brute force: given documents, null, empty, blank and repeated rows, a very long word."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from . import brute
from .conftest import SF

key = lambda r: tuple((x is None, x) for x in r)


def same(df, expected, columns):
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=key) == sorted((tuple(e) for e in expected), key=key)


# 1 -----------------------------------------------------------------------------------------------

ITEMS = [(1, "one two three four five six seven"), (2, "ONE two three four\nfive six seven"), (3, ""), (4, None), (5, "two words"), (None, "no id at all here but enough words")]


@pytest.fixture(scope="module")
def benchmark(spark):
    items = duckdb.sql(f"select item_id + 100, text from '{SF}/benchmark.parquet'").fetchall() + ITEMS
    return items, spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, hashes string, q int")


def test_decontamination(docs, pairs, benchmark, make):
    from cardrisk.llm.decontaminate import contaminated

    items, table = benchmark
    extra = [(1, "say one two three four five six seven again"), (2, "one two three four five six and more"), (3, "one two three four five"), (4, "Two  WORDS")]
    # a short item in a very long document
    rng = random.Random(1)
    extra.append((5, " ".join([f"w{rng.random()}" for _ in range(40_000)] + ITEMS[0][1].split() + [f"w{rng.random()}" for _ in range(9)])))
    expected = [e for e in brute.contaminated(pairs + extra, [i for i in items if i[0] is not None])]
    found = contaminated(docs.unionByName(make(extra)), table.filter("item_id is not null"))
    same(found, expected, ["doc_id", "item_id", "shared", "item_shingles", "doc_shingles"])
    assert {(r[0], tuple(r[1])) for r in found.filter("item_id = 1").select("doc_id", "item_ids").collect()} >= {(1, (1, 2)), (5, (1, 2))}
    nameless = contaminated(docs, table.filter("item_id is null")).collect()
    assert [(r["doc_id"], r["item_id"], r["item_ids"]) for r in nameless] == [(None, None, [])]


def test_decontamination_empty(docs, no_docs, benchmark):
    from cardrisk.llm.decontaminate import contaminated, decontaminate

    assert contaminated(no_docs, benchmark[1]).count() == 0
    assert contaminated(docs, benchmark[1].limit(0)).count() == 0
    clean = decontaminate(docs, benchmark[1])
    assert clean.columns == docs.columns
    bad = {e[0] for e in brute.contaminated([tuple(r) for r in docs.select("doc_id", "text").collect()], benchmark[0])}
    assert not bad & {r[0] for r in clean.select("doc_id").collect()} and clean.count() == docs.filter(~F.coalesce("doc_id", F.lit(-1)).isin([-1 if b is None else b for b in bad])).count()


def test_bins_hold_the_miss_probability():
    from cardrisk.llm.decontaminate import bins_log2

    for c in range(1, 40):
        sizes = [bins_log2(c, q, 0.8, 1e-6) for q in range(1, 12)]
        assert sizes == sorted(sizes, reverse=True)


# 2, 5 --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoded(pairs):
    from cardrisk.llm.pretokens import load_tokenizer, tokenizer_path

    t = load_tokenizer(tokenizer_path())
    return [(i, x or "", e.ids) for (i, x), e in zip(pairs, t.encode_batch([x or "" for _, x in pairs], add_special_tokens=False))]


def test_split_is_the_tokenizers_own():
    import public_tokenizers
    import regex

    from cardrisk.llm.pretokens import Split

    rng, alphabet = random.Random(2), "ab's  \n\tré9!'.,ltvedm x'l'　²"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ["", "'", "'s", " 's", "'sx'll"]
    split, pattern = Split(texts), regex.compile(public_tokenizers.PATTERN)
    strings = split.strings(np.arange(len(split.begin)))
    assert not split.odd.any()
    assert [strings[a:b] for a, b in zip(split.first, split.first[1:])] == [pattern.findall(t) for t in texts]


def test_piece_cache_of_any_size_gives_the_tokenizers_ids(pairs):
    from cardrisk.llm.pretokens import PieceCache, Split, load_tokenizer, tokenizer_path

    class Small(PieceCache):
        SLOTS, POOL = 1 << 5, 200

    cache = Small(load_tokenizer(tokenizer_path()))
    texts = [t or "" for _, t in pairs[:60]]
    for lo in range(0, 60, 7):
        split = Split(texts[lo : lo + 7])
        ids, count = cache.encode(split)
        ends = np.concatenate([[0], np.cumsum(count)])[split.first]
        for i, t in enumerate(texts[lo : lo + 7]):
            assert ids[ends[i] : ends[i + 1]].tolist() == cache.tokenizer.encode(t, add_special_tokens=False).ids


def test_token_counts(docs, encoded, no_docs):
    from cardrisk.llm.token_counts import token_counts

    expected = [(i, len(t.encode()), len(ids)) for i, t, ids in encoded]
    same(token_counts(docs), expected, ["doc_id", "n_bytes", "n_tokens"])
    same(token_counts(docs, common=5), expected, ["doc_id", "n_bytes", "n_tokens"])
    assert token_counts(no_docs).count() == 0


def test_packing(docs, encoded, no_docs):
    from cardrisk.llm.packing import pack

    pieces = pack(docs).collect()
    by_sequence, left = collections.defaultdict(list), collections.Counter()
    for i, _, ids in encoded:
        left[(i, tuple(ids + [0]))] += 1
    whole = collections.defaultdict(lambda: collections.defaultdict(list))
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        whole[p["doc_id"], p["doc_tokens"]][p["start"]].append(tuple(np.frombuffer(p["ids"], "<u4").tolist()))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    for (i, ids), n in left.items():
        got = whole[i, len(ids)]
        if n == 1:
            assert tuple(x for s in sorted(got) for x in got[s][0]) == ids
    assert sum(p["length"] for p in pieces) == sum(len(ids) + 1 for _, _, ids in encoded)
    assert len(by_sequence) * 1024 - sum(p["length"] for p in pieces) <= 8 * len(by_sequence) + 1024
    assert pack(no_docs).count() == 0


def test_bin_slack_plans():
    from cardrisk.llm.packing import _filling, plan_windows

    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 60): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 80)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1) if s + x * k <= room}
        best, used = _filling(counts, room)
        assert best == max(sums) == sum(x * n for x, n in used.items()) and all(n <= counts[x] for x, n in used.items())
    for _ in range(20):
        histogram = {rng.randint(1, 99): rng.randint(1, 500) for _ in range(rng.randint(1, 99))}
        patterns, rest = plan_windows(histogram, 100, 2)
        total = collections.Counter(rest)
        for repeats, used in patterns:
            assert 98 <= sum(x * n for x, n in used.items()) <= 100
            total.update({x: n * repeats for x, n in used.items()})
        assert total == histogram


# 3 -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows", [2048, 2])
def test_simhash(docs, pairs, make, shard_rows):
    from cardrisk.llm.simhash import near_duplicates

    rng = random.Random(4)
    base = [f"w{rng.randint(0, 99)}" for _ in range(400)]
    near = [(7000 + k, " ".join(base[:k] + [f"new{k}"] + base[k + 1 :])) for k in range(0, 400, 8)]
    found = near_duplicates(docs.unionByName(make(near)), shard_rows=shard_rows)
    expected = brute.components(pairs + near)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    same(found, [(i, signed(f), c) for i, f, c in expected], ["doc_id", "fingerprint", "component_id"])
    assert len({c for i, _, c in expected if i and 7000 <= i < 7400}) < 40


def test_bk_trees_link_what_brute_force_links():
    from cardrisk.llm.simhash import bk_links

    rng = random.Random(5)
    members = list({rng.getrandbits(12) for _ in range(300)})
    def groups(edges):
        label = {x: x for x in members}
        for _ in members:
            changed = False
            for a, b in edges:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
            if not changed:
                return label
    for radius in (0, 1, 2):
        every = [(a, b) for a in members for b in members if a < b and (a ^ b).bit_count() <= radius]
        got = list(bk_links(members, radius))
        assert len(got) < len(members) and groups(got) == groups(every)


def test_simhash_keeps_one_of_each_group(docs, pairs, no_docs):
    from cardrisk.llm.simhash import keep_one, near_duplicates

    kept = keep_one(docs)
    expected = {c for _, _, c in brute.components(pairs) if c is not None}
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and sorted(i for i in ids if i is not None) == sorted(expected)
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0


def test_simhash_keeps_one_of_groups_that_share_an_id(make):
    from cardrisk.llm.simhash import RADIUS, keep_one

    rng = random.Random(14)
    base = [f"w{rng.randint(0, 99)}" for _ in range(900)]
    near = lambda k: " ".join(base[:k] + [f"new{k}"] + base[k + 1 :])
    prints = {k: brute.fingerprint(near(k)) for k in range(300)}
    a, b = next((a, b) for a in prints for b in prints if a < b and 0 < (prints[a] ^ prints[b]).bit_count() <= RADIUS)
    # one id with two texts of two groups, each with a copy of its own id; a linked group without ids
    rows = [(1, "one group of some words here"), (1, "quite another text stands there"), (2, "one group of some words here"), (3, "quite another text stands there")]
    rows += [(None, near(a)), (None, near(b)), (None, near(b))]
    kept = [(r[0], r[1]) for r in keep_one(make(rows)).select("doc_id", "text").collect()]
    assert sorted(x for x in kept if x[0]) == sorted(rows[:2])
    assert len(kept) == 3 and kept[[x[0] for x in kept].index(None)] in rows[4:]


# 6 -----------------------------------------------------------------------------------------------


def test_substring_dedup(docs, pairs, make, no_docs):
    from cardrisk.llm.substring_dedup import dedup

    rng = random.Random(6)
    word = lambda: f"v{rng.randint(0, 10**6)}"
    passage = [word() for _ in range(80)]
    extra = []
    for k in range(12):  # pieces of a passage, of 30 to 50 words, in different surroundings
        a, n = rng.randint(0, 40), rng.randint(30, 50)
        extra.append((8000 + k, " ".join([word() for _ in range(rng.randint(0, 30))] + passage[a : a + n] + [word() for _ in range(rng.randint(0, 30))])))
    extra.append((8100, " ".join(["p", "q"] * 60)))  # repeats itself
    extra.append((8101, "\n".join(passage[:35])))
    found = dedup(docs.unionByName(make(extra))).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    same(found, brute.deduped(pairs + extra), found.columns)
    assert dedup(no_docs).count() == 0


@pytest.mark.parametrize("length,seed_words", [(4, 2), (5, 5), (7, 1)])
def test_substring_dedup_with_few_words(make, length, seed_words):
    from cardrisk.llm.substring_dedup import dedup

    rng = random.Random(length)
    rows = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))) for k in range(60)]
    found = dedup(make(rows), length, seed_words).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    same(found, brute.deduped(rows, length), found.columns)


# 7, 10 -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_sharding(docs, pairs, shards):
    from cardrisk.llm.sharding import kd_shards

    rows = kd_shards(docs, shards=shards).collect()
    expected = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=key) == sorted(expected, key=key)
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    largest = max(e[1] for e in expected)
    assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 6 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_edges(docs, make, no_docs):
    from cardrisk.llm.sharding import kd_shards

    assert kd_shards(no_docs).count() == 0
    same_place = make([(i, "t" * 9) for i in range(64)]).withColumn("source", F.lit("one")).withColumn("lang", F.lit(None).cast("string"))
    sizes = [r[1] for r in kd_shards(same_place, ["source", "lang"]).groupBy("shard").count().collect()]
    assert sizes == [8] * 8
    assert kd_shards(docs, target_bytes=100_000).agg(F.countDistinct("shard")).first()[0] > 1


def winnowed(text, gram=3, window=8):
    w = brute.words(text)
    grams = [tuple(w[i : i + gram]) for i in range(len(w) - gram + 1)] if len(w) >= gram else [tuple(w)] if w else []
    return grams, window


def test_winnowing(spark, docs, pairs, no_docs):
    from cardrisk.llm import winnowing as W

    rows = W.fingerprints(docs).collect()
    assert sorted(((r["doc_id"], r["n_chars"]) for r in rows), key=key) == sorted(((i, len(t or "")) for i, t in pairs), key=key)
    texts = collections.defaultdict(list)
    for i, t in pairs:
        texts[i].append(t)
    table = {}
    for r in rows:
        if len(texts[r["doc_id"]]) > 1 or r["doc_id"] is None:
            continue
        grams, window = winnowed(texts[r["doc_id"]][0])
        marks = {m["position"]: m["hash"] for m in r["marks"]}
        assert all(p < len(grams) for p in marks) and bool(marks) == bool(grams)
        for p, h in marks.items():  # a gram has one hash, wherever it stands
            assert table.setdefault(grams[p], h) == h
        for at in range(len(grams) - window + 1):  # every window has a choice: the least, the rightmost of equals
            held = [p for p in marks if at <= p < at + window]
            assert held
    known = {g: h for g, h in table.items()}
    for i, ts in texts.items():
        if len(ts) == 1 and i is not None and ts[0]:
            grams, window = winnowed(ts[0])
            if grams and all(g in known for g in grams):
                h = [known[g] for g in grams]
                chosen = {max(range(a, min(a + window, len(h))), key=lambda p: (-h[p], p)) for a in range(max(1, len(h) - window + 1))}
                assert chosen == {m["position"] for r in rows if r["doc_id"] == i for m in r["marks"]}
    assert W.fingerprints(no_docs).count() == 0 and W.edited_pairs(no_docs).count() == 0


def test_winnowing_neighbours(docs, pairs, make):
    from cardrisk.llm import winnowing as W

    got = W.edited_pairs(docs).select("doc_id", "n_chars", F.sha2("edited", 256).alias("e")).collect()
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    expected = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 4
        expected.append((i, len(t), hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    one = W.edited_pairs(make([(5, "abcdefgh")])).first()
    assert one["edited"] == "abcdefab"


def test_native_operators_have_no_python(docs):
    from cardrisk.llm import sharding, winnowing

    for df in (winnowing.edited_pairs(docs), winnowing.fingerprints(docs), sharding.points(docs, ["source"])):
        assert "Python" not in (plan := df._jdf.queryExecution().toString()) and "Arrow" not in plan
