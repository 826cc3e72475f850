"""Token alignment, HTML extraction and vector codes against brute force, with edge cases."""

import bisect
import collections
import hashlib
import html
import random
import re

import numpy as np
import pytest

from .conftest import SF
from .test_dealt import key, same

# 11 ----------------------------------------------------------------------------------------------


def _encodings(texts):
    """Ids of every text by both tokenizers, None where the joined bytes are not the text's."""
    import sentencepiece
    from tokenizers import Tokenizer

    from cardrisk.llm.pretokens import tokenizer_path

    tk = Tokenizer.from_file(tokenizer_path())
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    a_bytes = {i: bytes(letters[c] for c in p) for p, i in tk.get_vocab().items() if all(c in letters for c in p)}

    def b_bytes(i):
        p = sp.id_to_piece(i)
        m = re.fullmatch(r"<0x(..)>", p)
        return bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()

    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        own = (" " + t).encode()
        a = [(i, a_bytes[i]) for i in tk.encode(" " + t, add_special_tokens=False).ids]
        b = [(i, b_bytes(i)) for i in sp.encode(t)]
        out.append((a, b) if b"".join(x for _, x in a) == own == b"".join(x for _, x in b) else None)
    return out


def _spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def alignment_by_hand(pairs):
    rows = []
    for (doc, _), found in zip(pairs, _encodings([t for _, t in pairs])):
        if found is None:
            rows.append((doc, 0, 0, 0, [], ""))
            continue
        a, b = map(_spans, found)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            for i, _, e in tokens:
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        links, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        rows.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(text.encode()).hexdigest()))
    count = collections.Counter(x for r in rows for x in set(r[4]))
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(d, na, nb, ng, len(ls), sum(count[x] == most[x[0]] for x in ls), sum(count[x] for x in ls), h) for d, na, nb, ng, ls, h in rows]


MORE = [(9101, "▁ mark"), (9102, "  two  spaces\n\n\nlines\t"), (9103, "naïve façade 東京 नमस्ते"), (9104, "<s>x</s> <unk> <|endoftext|>"), (9105, "x" * 4000 + " " * 500), (9106, "\0\x01"), (9107, " ")]
ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("common", [1 << 17, 200, 0])
def test_alignment(spark, make, pairs, common):
    from cardrisk.llm.token_alignment import token_alignment

    given = pairs + MORE
    table = make(given).withColumnsRenamed({"score": "pairs", "mask": "row"}).repartition(3)
    same(token_alignment(table, common=common), alignment_by_hand(given), ALIGNED)


def test_alignment_of_nothing(no_docs, make):
    from cardrisk.llm.token_alignment import token_alignment

    assert token_alignment(no_docs).collect() == []
    same(token_alignment(make([(1, None), (None, "")])), [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], ALIGNED)


def test_windows_told_apart_by_ids(monkeypatch):
    from cardrisk.llm import kernels as K
    from cardrisk.llm.pretokens import tokenizer_path
    from cardrisk.llm.token_alignment import ID_BASE, Aligner

    own = K.span_hash
    aligner = Aligner(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    texts = ["one two three one two", "four five six"]
    plain = [d[:5] for d in aligner.documents(texts)]
    monkeypatch.setattr(K, "span_hash", lambda pre, a, b, base: np.zeros(len(a), np.uint64) if base == ID_BASE else own(pre, a, b, base))  # all windows collide
    assert [d[:5] for d in aligner.documents(texts)] == plain


def test_alignment_work_is_not_by_window():
    """Windows that differ are aligned together, not one by one in Python."""
    import sys

    from cardrisk.llm.pretokens import tokenizer_path
    from cardrisk.llm.token_alignment import Aligner

    aligner = Aligner(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))

    def calls(n):
        text = " ".join(f"w{k * 7919}q" for k in range(n))
        ids = [x[0] for x in aligner.encode([text])]
        cuts = aligner.windows(*ids, np.array([len(text) + 1]))
        aligner.alignments(*ids, *cuts)  # tables are made at first use
        seen = []
        sys.setprofile(lambda *a: seen.append(1))
        try:
            aligner.alignments(*ids, *cuts)
        finally:
            sys.setprofile(None)
        return len(seen)

    assert calls(4000) < 2 * calls(400)


# 12 ----------------------------------------------------------------------------------------------


def _page(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, role long")


def _text(found):
    return {r["page_id"]: r["text"] for r in found.collect()}


def test_extraction_on_given_pages(spark):
    from cardrisk.llm.html_extraction import main_text

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    expected = {}
    for i, source in [(r["page_id"], r["html"]) for r in pages.collect()]:
        article = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        expected[i] = "\n".join(b for b in blocks if b)
    assert _text(main_text(pages)) == expected


BODIES = [f"Article {w} begins here and tells of {w} at length" for w in "amber birch cedar dune ember fjord grove heath islet jetty".split()]
FIXED = "This standing text of the site is much longer than any article that the site holds, so weight alone would take it for the article"


def _site(host, body, count=10):
    return [(k, f"https://{host}/p/{k}", body.replace("BODY", BODIES[k % len(BODIES)]).replace("NUMBER", str(k))) for k in range(count)]


def test_template_without_named_markup(spark):
    """Only the template tells the standing text from the article here: no element or class names it."""
    from cardrisk.llm.html_extraction import main_text

    shape = f"<html><body><div class=x1><p>{FIXED}</p></div><div class=x2><p>BODY</p><p>Tail NUMBER</p></div></body></html>"
    found = _text(main_text(_page(spark, _site("plain.example.com", shape))))
    assert found == {k: f"{BODIES[k]}\nTail {k}" for k in range(10)}
    # too few pages to tell: the heavier container stays
    few = _text(main_text(_page(spark, _site("plain.example.com", shape, 2))))
    assert set(few.values()) == {FIXED}


def test_named_parts_go_and_repeats_in_articles_stay(spark):
    from cardrisk.llm.html_extraction import main_text

    shape = (
        "<head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><article><header><h1>Head &amp; line NUMBER</h1></header><p>BODY <span class=ad>Buy</span>  with&nbsp;<b>bold</b><br>end"
        "<p>a &lt; b < c<script>var t='</p>';</script><form><label>Mail</label><input></form><section class=comments><p>First!</p></section>"
        "<article><p>Reply</p></article></article><aside>Other</aside><footer>&copy; site</footer>"
    )
    rows = _site("news.example.com", shape)
    expected = {k: f"Head & line {k}\n{BODIES[k]} with bold end\na < b < c" for k in range(10)}
    assert _text(main_text(_page(spark, rows))) == expected


def test_the_host_s_slot_chooses_among_marked_articles(spark):
    """Two marked articles a page: the slot that holds most article text over the host's pages has the article, on every page."""
    from cardrisk.llm.html_extraction import main_text

    teaser = "The teaser of another story is longer on this page than the story of its own, and that many times over, but on no other page"
    shape = "<body><div class=t><article><p>TEASER</p></article></div><hr><div class=s><article><h1>Story NUMBER</h1><p>BODY</p></article></div></body>"
    rows = [(k, u, h.replace("TEASER", teaser if k == 3 else f"More {k}")) for k, u, h in _site("slots.example.com", shape)]
    assert _text(main_text(_page(spark, rows))) == {k: f"Story {k}\n{BODIES[k]}" for k in range(10)}
    # a page that marks nothing has its article in the slot of the others; weight on the page alone would take the teaser
    plain = [(k, u, h.replace("article>", "section>")) for k, u, h in rows]
    assert _text(main_text(_page(spark, plain)))[3] == f"Story 3\n{BODIES[3]}"
    # without a template (two pages) markup alone tells
    assert _text(main_text(_page(spark, rows[:2])))[1] == f"More 1\nStory 1\n{BODIES[1]}"


def test_extraction_edges(spark):
    from cardrisk.llm.html_extraction import main_text

    rows = [
        (1, None, None), (2, "", ""), (3, "no url", "<p>plain"), (None, "https://u:p@H.example.com:80/x", "<article>x</article>"), (5, "http://h.example.com", "just text & more"),
        (6, "http://h.example.com", "<article><p>" + "word " * 50_000 + "</article>"), (6, "http://h.example.com", "<article><p>again</article>"), (7, "http://h.example.com", "<" * 2000 + "<div " * 300),
        (8, "http://h.example.com", "<div>" * 3000 + "deep"),
    ]
    found = sorted(main_text(_page(spark, rows)).collect(), key=lambda r: key((r["page_id"], r["text"])))
    texts = [(r["page_id"], r["text"]) for r in found]
    assert (1, "") in texts and (2, "") in texts and (3, "plain") in texts and (None, "x") in texts and (5, "just text & more") in texts
    assert (6, " ".join(["word"] * 50_000)) in texts and (6, "again") in texts and (8, "deep") in texts and len(texts) == len(rows)
    assert main_text(_page(spark, [])).collect() == []


def test_copies_and_crossing_classes(spark):
    """Many copies of one page don't turn its article into template; tokens out of order are no template."""
    from cardrisk.llm.html_extraction import deduced, _sources, main_text

    shape = "<body><div class=a><p>left NUMBER</p></div><article><p>BODY</p></article></body>"
    rows = [(k, f"https://copies.example.com/{k}", shape.replace("BODY", BODIES[0]).replace("NUMBER", "1")) for k in range(50)]
    assert set(_text(main_text(_page(spark, rows))).values()) == {BODIES[0]}
    swapped = [(k, f"https://swap.example.com/{k}", f"<body><i>x</i><div class=one>{'up down' if k % 2 else 'down up'}</div><div class=two>z{k}</div></body>") for k in range(8)]
    moved = [(k, f"https://move.example.com/{k}", "<body>" + ("<ul class=u></ul><ol class=o></ol>" if k % 2 else "<ol class=o></ol><ul class=u></ul>") + f"<p>{k}</p></body>") for k in range(8)]
    found, _ = deduced(_sources(_page(spark, swapped + moved)))
    kinds = {r["host"]: (sum(x["tag"] for x in r["roles"]), sum(not x["tag"] for x in r["roles"])) for r in found.collect()}
    assert kinds["swap.example.com"] == (6, 3)  # body, one, two; x and the words between the tags of one
    assert kinds["move.example.com"][0] < 8  # not all of body, ul, ol, p


# 13 ----------------------------------------------------------------------------------------------


def codes_by_hand(rows, parts=8, entries=16, rounds=6):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    v = np.floor(4096 * np.array([r[1] for r in rows], float)).astype(np.int64)
    width = v.shape[1] // parts
    books, codes, error = [], np.zeros((len(v), parts), int), np.zeros(len(v), int)
    for p in range(parts):
        own = v[:, p * width : (p + 1) * width]
        book = own[:entries].copy()
        near = lambda: ((own[:, None] - book[None]) ** 2).sum(-1).argmin(1)
        for _ in range(rounds):
            at = near()
            for e in set(at.tolist()):
                book[e] = own[at == e].sum(0) // (at == e).sum()
        at = near()
        codes[:, p], error = at, error + ((own - book[at]) ** 2).sum(1)
        books.append(book)
    sums = collections.Counter()
    for r, e in zip(rows, error):
        sums[r[2]] += int(e)
    return [(r[0], "".join(f"{c:02x}" for c in own), int(e), sums[r[2]]) for r, own, e in zip(rows, codes, error)], np.concatenate([b.reshape(-1) for b in books]).tolist()


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, label int, error long, v string")


def _codes(table, **how):
    from cardrisk.llm.vector_codes import vector_codes, with_label_error

    codes, books = vector_codes(table, **how)
    return sorted((tuple(r) for r in with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()), key=key), books.reshape(-1).tolist()


def _rows(n, seed, wide=16):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, wide)).astype(np.float32)
    v[n // 3 : n // 2] = v[0]  # a large group of equal vectors
    v[n // 2 : n // 2 + 40] = np.round(v[n // 2 : n // 2 + 40])  # ties
    return [(int(i), x.tolist(), None if i % 5 == 0 else int(i % 3)) for i, x in zip(rng.permutation(n), v)]


@pytest.mark.parametrize("block", [64, 4096])
def test_codes(spark, block):
    rows = _rows(900, 5)
    expected, books = codes_by_hand(rows)
    assert _codes(_vectors(spark, rows).repartition(4), block=block) == (sorted(expected, key=key), books)


def test_codes_edges(spark):
    rows = _rows(30, 6) + [(3, [0.25] * 16, 1), (3, [0.25] * 16, 1), (None, [0.5] * 16, 9)]
    bad = [(100, None, 1), (101, [1.0, None] * 8, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, 1), (104, [-float("inf")] * 16, None)]
    odd = [(-5, [1e30] * 16, 2), (205, [1.0] * 8, 2), (206, [], 9)]
    expected, books = codes_by_hand(rows)
    sums = {r[2]: e[3] for r in rows for e in expected if e[0] == r[0] and (r[0] != 3 or r[2] == 1)}
    expected += [(i, None, None, sums.get(label)) for i, _, label in odd]
    assert _codes(_vectors(spark, rows + bad + odd)) == (sorted(expected, key=key), books)
    assert _codes(_vectors(spark, []))[0] == [] and _codes(_vectors(spark, bad))[0] == []
    one, _ = _codes(_vectors(spark, [(1, [0.5] * 8, None)]))
    assert one == [(1, "00" * 8, 0, 0)]
    with pytest.raises(ValueError):
        _codes(_vectors(spark, [(1, [0.5] * 9, None)]))


def test_cover_tree():
    from cardrisk.llm.vector_codes import built, coded

    rng = np.random.default_rng(1)
    for n, wide, spread in ((1, 2, 9), (500, 3, 5), (700, 8, 4096), (300, 2, 1)):
        points = rng.integers(-spread, spread, (n, wide))
        order, nodes, radii = built(points)
        assert sorted(order.tolist()) == list(range(n))
        laid = points[order]
        for (lo, hi, first, children), r in zip(nodes.tolist(), radii.tolist()):
            assert (((laid[lo:hi] - laid[lo]) ** 2).sum(1) <= r * r * (1 + 1e-9) + 1e-9).all()
            own = nodes[first : first + children]
            assert not children or (own[0][0] == lo and own[-1][1] == hi and (own[1:, 0] == own[:-1, 1]).all() and (radii[first : first + children] <= r / 2).all())
        entries = rng.integers(-spread, spread, (16, wide))
        assert (coded(laid, nodes, radii, entries) == ((laid[:, None] - entries[None]) ** 2).sum(-1).argmin(1)).all()


def test_subtrees_go_whole():
    """Well separated clumps are assigned by their roots' children, not point by point."""
    from cardrisk.llm.vector_codes import built, walked

    rng = np.random.default_rng(2)
    centres = rng.integers(-10**6, 10**6, (16, 8))
    points = centres[rng.integers(0, 16, 4000)] + rng.integers(-50, 50, (4000, 8))
    order, nodes, radii = built(points)
    lo, hi, _ = walked(points[order], nodes, radii, centres)
    assert len(lo) < 200 and (hi - lo).sum() == 4000


def test_hot_label_is_broadcast_and_rare_ones_join(spark, monkeypatch):
    from cardrisk.llm import vector_codes as V

    random.seed(4)
    labels = [0] * 30 + list(range(1, 31))
    table = spark.createDataFrame([(i, f"{i:02x}", i, x if x % 7 else None) for i, x in enumerate(labels)], "vec_id long, code string, error long, label int")
    monkeypatch.setattr(V, "HOT", 10)
    sums = collections.Counter()
    for i, x in enumerate(labels):
        sums[x if x % 7 else None] += i
    same(V.with_label_error(table), [(i, sums[x if x % 7 else None]) for i, x in enumerate(labels)], ["vec_id", "label_error"])
