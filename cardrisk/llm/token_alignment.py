"""Token alignment of two tokenizers by whitespace anchors.

Every text is tokenised whole by both tokenizers.  Byte offsets where a token of
each ends are shared ends.  A shared end before a token of A that begins with a space
and a token of B that begins with the space mark is an anchor: it cuts the document into
windows, each a tuple of A ids and a tuple of B ids.  The windows of ordinary text repeat, so a
window's alignment (its groups and its links) is worked out once for each pair of id tuples of a
slice of some documents, all of a slice at once; windows are told apart by hash and compared id by id.

1. each document: its counts, its groups' digest and the id pairs that it links, written once;
2. in how many documents each id pair is linked, and each A id's highest such number (at most
   one row an A id, so bounded by the vocabulary);
3. each document's links against these numbers.  The ``common`` most frequent pairs (a fixed
   number of keys, broadcast) are summed on the spot, so no hot pair is shuffled; the others go
   through a shuffle join on the pair.

Nulls and edges: a null or empty text, and a text whose joined token bytes are not a space and
the text, has no tokens (zeros and an empty digest); repeated rows are documents of their own;
a null ``doc_id`` stays null; an empty table gives an empty result; other columns are not read.
A very long text is one numpy step, of some 100 bytes a byte of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.llm import kernels as K
from cardrisk.llm.common import batch, frequent, keyed, prepare, text_slices, written
from cardrisk.llm.pretokens import PieceCache, Split, load_tokenizer, tokenizer_path

#: Broadcast id pairs: 17 bytes each.
COMMON = 1 << 17
MARK = "▁"
ID_BASE = 0x9FB21C651E98DF25  # odd

_LOADED: dict = {}


def byte_alphabet() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable bytes stand for themselves, the rest follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """The bytes of every id, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.fromiter((t[:1] == b" " for t in tokens), bool, len(tokens))
        self.decimals, self.digits = _decimals(len(tokens))

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.at[ids] - (ends - n), n) + np.arange(int(n.sum()))]


def byte_level(path: str) -> tuple[PieceCache, Vocabulary]:
    """A ``.json`` byte-level BPE; strings of its special tokens are plain text."""
    tokenizer = load_tokenizer(path)
    tokenizer.encode_special_tokens = True
    letters = byte_alphabet()
    tokens = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for piece, i in tokenizer.get_vocab(with_added_tokens=False).items():
        tokens[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else b""
    return PieceCache(tokenizer), Vocabulary(tokens)


def pieces(path: str):
    """A sentencepiece ``.model``: the processor and its ids' bytes (control ids have none)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(piece[1:-1], 16)]))
        else:
            tokens.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(MARK, " ").encode())
    return model, Vocabulary(tokens)


def _tokenizers(a_path: str, b_path: str):
    at = (a_path, b_path)
    if at not in _LOADED:
        _LOADED[at] = (*byte_level(a_path), *pieces(b_path))
    return _LOADED[at]


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id below ``n`` in decimals, as the bytes of a little-endian integer (the first byte is free), and their number."""
    rows = np.zeros((n, 8), np.uint8)
    values, size = np.arange(n), np.ones(n, np.int64)
    for k in range(1, 7):
        size += values >= 10**k
    for k in range(7):
        own = np.flatnonzero(size > k)
        rows[own, size[own] - k] = values[own] // 10**k % 10 + ord("0")
    return rows.reshape(-1).view("<u8"), size


def align(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, vocab_a: Vocabulary, vocab_b: Vocabulary):
    """Alignments of windows that lie end to end, ``n_a`` and ``n_b`` ids each.

    Each window's groups as text, their number, the number of its links, and the id pair ``a << 32 | b`` of every link.
    Between two neighbouring ends (of either side) stand one A token and one B token: a link.
    """
    ends_a, ends_b = np.cumsum(vocab_a.size[a]), np.cumsum(vocab_b.size[b])
    cut = np.zeros(int(ends_a[-1]) + 1, np.uint8)
    cut[ends_a] = 1
    cut[ends_b] += 2
    ends = np.flatnonzero(cut)
    kind = cut[ends]
    in_a, in_b = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64)
    links = a[np.cumsum(in_a) - in_a].astype(np.int64) << 32 | b[np.cumsum(in_b) - in_b].astype(np.int64)
    top = np.searchsorted(ends, ends_a[np.cumsum(n_a) - 1])  # each window's last link
    n = np.diff(top + 1, prepend=0)
    groups = np.diff(np.cumsum(kind == 3)[top], prepend=0)

    # a group's A ids, then its B ids, each after its separator
    shared_a, shared_b = cut[ends_a] == 3, cut[ends_b] == 3
    upto_a, upto_b = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (shared_a, shared_b))
    place_a = np.arange(len(a)) + upto_b[np.cumsum(shared_a) - shared_a]
    place_b = np.arange(len(b)) + upto_a[np.cumsum(shared_b) - shared_b + 1]
    first_a, first_b = (np.concatenate([[True], x[:-1]]) for x in (shared_a, shared_b))
    ids_text, size = np.empty(len(a) + len(b), "<u8"), np.empty(len(a) + len(b), np.int64)
    for place, ids, vocab, first, mark in ((place_a, a, vocab_a, first_a, ";"), (place_b, b, vocab_b, first_b, "|")):
        ids_text[place] = vocab.decimals[ids] | np.where(first, ord(mark), ord(",")).astype("<u8")
        size[place] = vocab.digits[ids] + 1
    raw = ids_text.view(np.uint8)
    text = raw[raw != 0].tobytes().decode("ascii")
    stop = np.cumsum(size)[np.cumsum(n_a + n_b) - 1]
    return [text[x + 1 : y] for x, y in zip([0, *stop[:-1].tolist()], stop.tolist())], groups, n, links


def _alike(ids: np.ndarray, lo: np.ndarray, n: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Whether each window's ids are those of the window it is said to be like."""
    same = n == n[like]
    n = np.where(same, n, 0)
    ends = np.cumsum(n)
    own = np.arange(int(n.sum())) - np.repeat(ends - n, n)
    differ = np.append(ids[own + np.repeat(lo, n)] != ids[own + np.repeat(lo[like], n)], False)
    return same & ~(np.logical_or.reduceat(differ, np.minimum(ends - n, len(differ) - 1)) & (n > 0))


class Aligner:
    """Aligns many texts at once."""

    def __init__(self, a_path: str, b_path: str):
        self.cache, self.a, self.model, self.b = _tokenizers(a_path, b_path)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Whole tokenisations of each text by A (with a space before it) and by B (which puts one there)."""
        spaced = [" " + t for t in texts]
        split = Split(spaced)
        ids, count = self.cache.encode(split)
        at = np.concatenate([[0], np.cumsum(count)])[split.first]
        a = [ids[at[k] : at[k + 1]] for k in range(len(texts))]
        for k in np.flatnonzero(split.odd):
            a[k] = np.array(self.cache.tokenizer.encode(spaced[k], add_special_tokens=False).ids, np.uint32)
        b = [np.fromiter(x, np.uint32, len(x)) for x in self.model.encode(texts, num_threads=1)]
        return a, b

    def windows(self, ids_a: np.ndarray, ids_b: np.ndarray, last: np.ndarray):
        """First A and B tokens of every window (and the ends); ``last``: byte ends of the documents."""
        ends_a, ends_b = np.cumsum(self.a.size[ids_a]), np.cumsum(self.b.size[ids_b])
        total = int(ends_a[-1])
        spaced = np.zeros(total + 1, np.uint8)
        spaced[np.concatenate([[0], ends_a[:-1]])[self.a.spaced[ids_a]]] = 1
        spaced[np.concatenate([[0], ends_b[:-1]])[self.b.spaced[ids_b]]] += 2
        cut = np.zeros(total + 1, np.uint8)  # 3: an end of both, 7: an anchor too
        cut[ends_a] = 1
        cut[ends_b] += 2
        cut[last] |= 4
        cut[spaced == 3] |= 4
        return [np.concatenate([[0], np.flatnonzero(cut[e] == 7) + 1]) for e in (ends_a, ends_b)]

    def alignments(self, ids_a: np.ndarray, ids_b: np.ndarray, wa: np.ndarray, wb: np.ndarray):
        """Each window's place in the list of different ones, and that list's alignments."""
        pre_a, pre_b = K.prefix(ids_a.astype(K.U) + K.U(1), ID_BASE), K.prefix(ids_b.astype(K.U) + K.U(1), ID_BASE)
        h = K.mix(K.span_hash(pre_a, wa[:-1], wa[1:], ID_BASE)) + K.span_hash(pre_b, wb[:-1], wb[1:], ID_BASE)
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        like = first[which]
        other = np.flatnonzero(~(_alike(ids_a, wa[:-1], np.diff(wa), like) & _alike(ids_b, wb[:-1], np.diff(wb), like)))
        which[other] = len(first) + np.arange(len(other))
        first = np.concatenate([first, other])
        own = []
        for ids, w in ((ids_a, wa), (ids_b, wb)):
            n = np.diff(w)[first]
            own.append((ids[np.repeat(w[first] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n))
        (a, n_a), (b, n_b) = own
        return which, align(a, b, n_a, n_b, self.a, self.b)

    def documents(self, texts: list[str]) -> list[tuple]:
        """``n_a, n_b, n_groups, n_links, digest, pairs, links of each pair`` of every text."""
        none = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int32))
        out = [none] * len(texts)
        at = [k for k, t in enumerate(texts) if t]
        if not at:
            return out
        all_a, all_b = self.encode([texts[k] for k in at])
        good = []
        for k, a, b in zip(at, all_a, all_b):
            own = b" " + texts[k].encode()
            if self.a.joined(a).tobytes() == own and self.b.joined(b).tobytes() == own:
                good.append((k, a, b, len(own)))
        if not good:
            return out
        ids_a, ids_b = np.concatenate([g[1] for g in good]), np.concatenate([g[2] for g in good])
        wa, wb = self.windows(ids_a, ids_b, np.cumsum([g[3] for g in good]))
        which, (strings, groups, n, pool) = self.alignments(ids_a, ids_b, wa, wb)
        begin = np.cumsum(n) - n
        tops = np.searchsorted(wa, np.cumsum([len(g[1]) for g in good]))
        lo = 0
        for (k, a, b, _), hi in zip(good, tops.tolist()):
            own = which[lo:hi]
            size = n[own]
            ends = np.cumsum(size)
            links = pool[np.repeat(begin[own] - (ends - size), size) + np.arange(int(ends[-1]))]
            pairs, counts = np.unique(links, return_counts=True)
            digest = hashlib.sha256(";".join([strings[w] for w in own.tolist()]).encode()).hexdigest()
            out[k] = (len(a), len(b), int(groups[own].sum()), len(links), digest, pairs, counts.astype(np.int32))
            lo = hi
        return out


_PLAIN = ("doc_id", "n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each document's counts, digest and linked pairs (``a << 32 | b``) with their links."""
    schema = pa.schema([(c, pa.int64()) for c in _PLAIN] + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for b in batches:
            for lo, hi, _, _ in text_slices(b.column(1)):
                found = aligner.documents(b.column(1)[lo:hi].to_pylist())
                yield batch(schema, b.column(0)[lo:hi], *[list(c) for c in zip(*found)])

    kind = ", ".join(f"{c} bigint" for c in _PLAIN) + ", groups_sha256 string, pairs array<bigint>, links array<int>"
    return keyed(docs).select("doc_id", "text").mapInArrow(run, kind)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that link the pair, and whether no pair of its A id has more."""
    counts = written(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "id-pairs")
    first = F.shiftright("pair", 32).cast("int")
    top = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))  # a row an A id at most
    return counts.join(F.broadcast(top), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def most_common(pairs: DataFrame, common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent pairs, at most ``common``."""
    rows = frequent(pairs, "n", common).toPandas().sort_values("pair")
    return rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["best"].to_numpy(bool)


def token_alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, common: int = COMMON) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    spark = prepare(docs.sparkSession)
    a_path, b_path = a_path or tokenizer_path(), b_path or tokenizer_path("piece_bpe_32k.model")
    found = written(aligned(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "alignments")
    pairs = written(pair_counts(found), "pair-counts")
    table = spark.sparkContext.broadcast(most_common(pairs, common))
    schema = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("pair", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for b in batches:
            pair, links = b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy().astype(np.int64)
            size = np.diff(b.column(1).offsets.to_numpy())
            row = np.repeat(np.arange(len(b)), size)
            spot = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[spot] == pair if len(known) else np.zeros(len(pair), bool)
            sums = np.zeros((2, len(b)), np.int64)
            at = spot[hit]
            if len(at):
                np.add.at(sums[0], row[hit], links[hit] * best[at])
                np.add.at(sums[1], row[hit], links[hit] * n[at])
            # a row of each document's sums (no pair), and one for each pair that is not in the table
            rest = np.flatnonzero(~hit)
            take = np.concatenate([np.arange(len(b)), row[rest]])
            gap = np.arange(len(take)) < len(b)
            pad = np.zeros(len(rest), np.int64)
            more = np.zeros(len(b), np.int64)
            yield batch(
                schema, b.column(0).take(pa.array(take)), np.concatenate([sums[0], pad]), np.concatenate([sums[1], pad]),
                pa.array(np.concatenate([more, pair[rest]]), mask=gap), np.concatenate([more, links[rest]]),
            )

    parts = written(found.select("row", "pairs", "links").mapInArrow(run, "row bigint, n_best bigint, count_sum bigint, pair bigint, links bigint"), "pair-parts")
    rare = parts.filter(F.col("pair").isNotNull()).join(pairs, "pair")
    rare = rare.select("row", F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"), (F.col("links") * F.col("n")).alias("count_sum"))
    sums = parts.filter(F.col("pair").isNull()).select("row", "n_best", "count_sum").unionByName(rare)
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select("row", *_PLAIN, "groups_sha256").join(sums, "row").select(*_PLAIN, "n_best", "count_sum", "groups_sha256")
