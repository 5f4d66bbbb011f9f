"""Byte-level BPE: encode texts to ids with a ranked vocabulary, and decode ids to bytes.

A text is cut by the vocabulary's pattern and every piece is merged on its own: of all neighbouring
pairs whose bytes together are a token, the one of lowest rank merges first, the leftmost among equals.
A segment tree over the piece's byte positions holds the rank of the pair that begins at each position;
its root names the next merge, and a merge updates the leaves of the live neighbours, a logarithmic
number of nodes each. Pieces not met before are merged side by side, one tree a row; a few pieces, such
as a very long one, each in a tree of their own.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame

from canopy.llm.batches import add_columns, texts

# The pattern that cuts texts for the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same cut for texts of these characters only, with the character classes spelled out.
PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ɏ]")
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN_PATTERN = (rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{LETTERS}0-9]+"
                 r"|\s+(?!\S)|\s+")

HELD_CHARS = 1 << 20      # of texts whose pieces are held at once, or one text
KNOWN_PIECES = 200_000    # pieces a Python process remembers; it forgets all when full
TREES = 1 << 17           # bytes of pieces merged side by side
FEW = 32                  # pieces for which a tree of their own is faster than trees side by side
NONE = np.int64(1 << 40)  # above every rank
EMPTY = np.iinfo(np.int64).max     # leaf without a merge: above rank * width + position at every width


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Vocabulary:
    """Ranks of a tiktoken file, and the pairs of tokens that make another token."""

    def __init__(self, data: bytes):
        self.ranks = read_ranks(data)
        self.decimal = {rank: str(rank) for rank in self.ranks.values()}
        self.bytes = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        if (self.bytes < 0).any():
            raise ValueError("a byte-level vocabulary has a token for every byte")
        pairs = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], rank) for t, rank in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        pairs.sort()
        self.pairs = np.array([p for p, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.merged = np.array([r for _, r in pairs] + [0], np.int64)
        self.rank_of = dict(pairs)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbours make together, NONE if they make none or one is missing."""
        key = (left << 32) | right
        at = np.searchsorted(self.pairs, key)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.merged[at], NONE)

    def merge(self, pieces: list[bytes]) -> list[str]:
        """Ids of every piece, joined by commas; the pieces' trees stand side by side and take one merge each per round."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        width = 1 << int(max(sizes.max() - 1, 1)).bit_length()      # leaves
        ends = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        ids = np.full((n, width + 1), -1, np.int64)                 # token that begins at a position; -1: none
        inside = np.arange(width + 1) < sizes[:, None]
        ids[inside] = raw
        after = np.minimum(np.arange(1, width + 2), sizes[:, None])  # next live position; the size at the end
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), EMPTY, np.int64)  # rank and position in one number: leftmost wins
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        tree[:, width:] = np.where(ranks < NONE, ranks * width + np.arange(width), EMPTY)
        for level in range(width.bit_length() - 2, -1, -1):
            a = 1 << level
            tree[:, a:2 * a] = np.minimum(tree[:, 2 * a:4 * a:2], tree[:, 2 * a + 1:4 * a:2])

        def put(rows: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = np.where(ranks < NONE, ranks * width + at, EMPTY)
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < EMPTY)
        while len(rows):
            best = tree[rows, 1]
            left, rank = best % width, best // width
            right = after[rows, left]
            follow = after[rows, right]
            ids[rows, left], ids[rows, right] = rank, -1
            after[rows, left] = follow
            before[rows, follow] = left
            put(rows, right, np.full(len(rows), NONE))
            put(rows, left, self.pair_ranks(rank, ids[rows, follow]))
            prior = before[rows, left]
            has = prior >= 0
            if has.any():
                put(rows[has], prior[has], self.pair_ranks(ids[rows[has], prior[has]], rank[has]))
            rows = rows[tree[rows, 1] < EMPTY]
        live = list(map(self.decimal.__getitem__, ids[ids >= 0].tolist()))
        cuts = np.concatenate([[0], np.cumsum((ids >= 0).sum(1))]).tolist()
        return [",".join(live[a:b]) for a, b in zip(cuts, cuts[1:])]

    def merge_one(self, piece: bytes) -> str:
        """As ``merge`` for one piece: the same tree in flat arrays of machine words, one merge after the other."""
        size = len(piece)
        shift = max(size - 1, 1).bit_length()
        width, rank_of = 1 << shift, self.rank_of.get
        own = self.bytes[np.frombuffer(piece, np.uint8)]
        ranks = self.pair_ranks(own[:-1], own[1:])
        start = np.full(2 * width, EMPTY, np.int64)
        start[width:width + size - 1] = np.where(ranks < NONE, (ranks << shift) + np.arange(size - 1), EMPTY)
        for level in range(shift - 1, -1, -1):
            a = 1 << level
            start[a:2 * a] = np.minimum(start[2 * a:4 * a:2], start[2 * a + 1:4 * a:2])
        tree, ids = array("q", start.tobytes()), array("q", own.tobytes())
        del start
        after, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        empty = int(EMPTY)

        def put(at: int, left: int, right: int) -> None:
            rank = rank_of(left << 32 | right) if left >= 0 <= right else None
            node = at + width
            tree[node] = low = empty if rank is None else (rank << shift) + at
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                low = other if other < low else low
                if tree[node] == low:
                    break
                tree[node] = low

        while (best := tree[1]) < empty:
            left, rank = best & (width - 1), best >> shift
            right = after[left]
            after[left] = follow = after[right]
            ids[left], ids[right] = rank, -1
            if follow < size:
                before[follow] = left
            put(right, -1, -1)
            put(left, rank, ids[follow] if follow < size else -1)
            if (prior := before[left]) >= 0:
                put(prior, ids[prior], rank)
        return ",".join(self.decimal[i] for i in ids if i >= 0)

    def encode(self, pieces: list[bytes]) -> list[str]:
        """Ids of every piece. A piece that is a token is that token; the others are merged by size class."""
        out = [self.decimal[r] if (r := self.ranks.get(p)) is not None else None for p in pieces]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        left = [i for i in np.argsort(sizes, kind="stable").tolist() if out[i] is None]
        start = 0
        while start < len(left):
            width = 1 << (len(pieces[left[start]]) - 1).bit_length()
            most = start + max(TREES // width, 1)
            stop = bisect.bisect_right(left, width, start, min(most, len(left)), key=lambda i: len(pieces[i]))
            part = left[start:stop]
            some = [pieces[i] for i in part]
            for i, ids in zip(part, self.merge(some) if len(some) > FEW else map(self.merge_one, some)):
                out[i] = ids
            start = stop
        return out


@functools.lru_cache(maxsize=4)
def vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary(data)


@functools.lru_cache(maxsize=4)
def decoder(data: bytes):
    """Function from decimal ids joined by commas to bytes."""
    token = {str(rank): token for token, rank in read_ranks(data).items()}.__getitem__
    return lambda ids: b"".join(map(token, ids.split(","))) if ids else b""


@functools.lru_cache(maxsize=4)
def splitter(pattern: str):
    """Function that cuts a text into pieces; white space is Unicode's property, as in the library."""
    general = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    if pattern != PATTERN:
        return general
    plain = re.compile(PLAIN_PATTERN).findall
    return lambda text: general(text) if PLAIN.search(text) else plain(text)


class Encoder:
    """Pieces and their ids, remembered between batches of a Python process up to KNOWN_PIECES."""

    def __init__(self, data: bytes, pattern: str):
        self.vocabulary, self.cut = vocabulary(data), splitter(pattern)
        self.ids: dict[str, str] = {}

    def learn(self, pieces: list[list[str]]) -> None:
        new = set().union(*pieces) - self.ids.keys()
        if len(self.ids) + len(new) > KNOWN_PIECES:
            self.ids = {}
            new = set().union(*pieces)
        new = list(new)
        self.ids.update(zip(new, self.vocabulary.encode([p.encode() for p in new])))

    def encode(self, values: list) -> list[str]:
        """Decimal ids joined by commas, one string a text; a null is an empty text."""
        out: list[str] = []
        start = 0
        while start < len(values):
            cut, held = [], 0
            while start < len(values) and held < HELD_CHARS:
                value = values[start] or ""
                cut.append(self.cut(value))
                held += len(value)
                start += 1
            self.learn(cut)
            out += [",".join(map(self.ids.__getitem__, c)) for c in cut]
        return out


@functools.lru_cache(maxsize=2)
def encoder(data: bytes, pattern: str) -> Encoder:
    return Encoder(data, pattern)


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file, read where the driver is and broadcast: its size does not follow the data."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens",
           pattern: str = PATTERN, verify: bool = False) -> DataFrame:
    """Append ``ids``, the token ids of every whole text in decimal joined by commas, and their ``count``.

    With ``verify`` the ids are decoded again, and a text that does not come back fails the job. Null and empty texts have the empty string and count 0. Other columns stay; one that has the name of
    a new one is replaced. Repeated rows are encoded alike; an empty table stays empty.
    """
    data = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def start():
        encode_texts = encoder(data.value, pattern).encode

        def columns(batch):
            values = texts(batch, text)
            made = encode_texts(values)
            if verify:
                back = decoder(data.value)
                for value, ids in zip(values, made):
                    if back(ids) != (value or "").encode():
                        raise ValueError("ids do not decode to the text")
            return [made, [s.count(",") + 1 if s else 0 for s in made]]

        return columns

    return add_columns(df, f"{ids} string, {count} bigint", start)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append ``decoded``, the bytes that the ids stand for; null and empty ids give no bytes."""
    data = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def start():
        back = decoder(data.value)
        return lambda batch: [[back(s or "") for s in texts(batch, ids)]]

    return add_columns(df, f"{decoded} binary", start)
