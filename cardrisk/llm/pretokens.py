"""Byte-level BPE pre-tokens of many texts at once, and a cache of their pieces.

The split is that of the tokenizer file's ByteLevel pre-tokenizer:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Code points whose class differs between Unicode versions, those beyond the
basic plane and special token strings are left to the tokenizer itself: their
documents are ``odd`` and encoded whole by the library.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from cardrisk.llm import kernels as K

LETTER, NUMBER, OTHER, BLANK, CUT, ODD = range(6)
POINT_BASE = 0xE7037ED1A0B428DB  # odd
_BLANKS = [9, 10, 11, 12, 13, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of each code point of the basic plane; ODD where Unicode 3.2 and today disagree."""
    if not _CLASSES:
        old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
        table = np.full(1 << 16, ODD, np.uint8)
        for p in range(1 << 16):
            kind = new(chr(p))
            if kind == old(chr(p)) and kind not in ("Cn", "Cs"):
                table[p] = {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)
        table[[*range(0x1C, 0x20), 0x85]] = ODD
        table[_BLANKS] = BLANK
        _CLASSES.append(table)
    return _CLASSES[0]


def load_tokenizer(path: str):
    """The tokenizer of a byte-level BPE ``.json`` file, on one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if "ByteLevel" not in repr(tokenizer.pre_tokenizer) or tokenizer.normalizer is not None:
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
    return tokenizer


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Split:
    """The pre-tokens of some texts: code point spans, 64-bit hashes, and the document of each."""

    def __init__(self, texts: list[str], specials: tuple[str, ...] = ()):
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1  # each text is followed by one cut
        kind = classes()[np.minimum(points, 0xFFFF)]
        kind[points > 0xFFFF] = ODD
        kind[ends] = CUT
        begins = np.concatenate([[0], ends[:-1] + 1])
        odd = np.add.reduceat((kind == ODD).astype(np.int64), begins) > 0
        for s in specials:
            odd |= np.fromiter((s in t for t in texts), bool, len(texts))

        before = np.concatenate([[CUT], kind[:-1]])
        after = np.concatenate([kind[1:], [CUT]])
        start = kind != before
        start[ends] = True
        # the last blank before a word starts a pre-token, and a plain space takes the word with it
        last_blank = (kind == BLANK) & (after != BLANK) & (after != CUT)
        start |= last_blank
        start[1:] &= ~(last_blank[:-1] & (points[:-1] == 0x20))
        # contractions
        mark = np.flatnonzero((points == 0x27) & start & (after == LETTER))
        one = points[mark + 1]
        two = points[np.minimum(mark + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        start[mark[short | long] + 1] = False
        for at in (mark[short] + 2, mark[long] + 3):
            start[at[kind[at] == LETTER]] = True

        edges = np.flatnonzero(start)
        real = kind[edges] != CUT
        self.text, self.odd, self.texts = joined, odd, texts
        self.begin = edges[real]
        self.end = np.append(edges[1:], len(points))[real]
        self.first = np.searchsorted(self.begin, np.concatenate([begins, [len(points)]]))
        pre = K.prefix(points.astype(K.U) + K.U(1), POINT_BASE)
        self.hash = K.span_hash(pre, self.begin, self.end, POINT_BASE)
        if odd.any():  # their pre-tokens are not used
            keep = ~np.repeat(odd, np.diff(self.first))
            counts = np.where(odd, 0, np.diff(self.first))
            self.begin, self.end, self.hash = self.begin[keep], self.end[keep], self.hash[keep]
            self.first = np.concatenate([[0], np.cumsum(counts)])

    def strings(self, which: np.ndarray) -> list[str]:
        text = self.text
        return [text[a:b] for a, b in zip(self.begin[which].tolist(), self.end[which].tolist())]


class PieceCache:
    """Ids of pre-tokens by hash: a table of fixed size in front of the tokenizer.

    Two slots for each hash; what is not there is encoded by the tokenizer
    itself and takes a slot.  The id pool is emptied when it is full, so memory is bounded.
    """

    SLOTS, POOL = 1 << 20, 1 << 23

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.reset()

    def reset(self) -> None:
        self.key = np.zeros(self.SLOTS, np.uint64)
        self.at = np.zeros(self.SLOTS, np.int64)
        self.count = np.zeros(self.SLOTS, np.int32)
        self.pool = np.zeros(self.POOL, np.uint32)
        self.used = 0

    def encode(self, split: Split) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pre-tokens in order, and the number of ids of each pre-token."""
        h = split.hash
        mask = np.uint64(self.SLOTS - 1)
        slot = (h & mask).astype(np.int64)
        other = ((h >> np.uint64(40)) & mask).astype(np.int64)
        slot = np.where(self.key[slot] == h, slot, other)
        hit = self.key[slot] == h
        at, count = self.at[slot], self.count[slot]
        pool = self.pool
        missing = np.flatnonzero(~hit)
        if len(missing):
            new, first, back = np.unique(h[missing], return_index=True, return_inverse=True)
            encoded = self.tokenizer.encode_batch(split.strings(missing[first]), add_special_tokens=False)
            ids = [e.ids for e in encoded]
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
            if self.used + len(flat) > self.POOL:
                pool = np.concatenate([pool[: self.used], flat])  # this call's ids; the cache starts anew
                base = self.used
                self.reset()
            else:
                base = self.used
                pool[base : base + len(flat)] = flat
                self.used += len(flat)
                where = base + np.cumsum(sizes) - sizes
                spot = (new & mask).astype(np.int64)
                spot = np.where(self.key[spot] == 0, spot, ((new >> np.uint64(40)) & mask).astype(np.int64))
                self.key[spot], self.at[spot], self.count[spot] = new, where, sizes
                # of several in one slot the last stays; write its own place and size again
                wins = self.key[spot] == new
                self.at[spot[wins]], self.count[spot[wins]] = where[wins], sizes[wins]
            where = base + np.cumsum(sizes) - sizes
            at[missing], count[missing] = where[back], sizes[back]
        total = int(count.sum())
        ends = np.cumsum(count, dtype=np.int64)
        index = np.repeat(at - (ends - count), count) + np.arange(total)
        return pool[index], count
