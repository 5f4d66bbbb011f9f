"""Substring dedup: words covered by a window of words that also starts in an earlier document.

Rabin-Karp hashes of all windows of a fixed number of words come from prefix sums modulo 2**64. Documents
lie in chunks that follow their ids, so "an earlier document" is an earlier chunk or an earlier document
of the same chunk, and a window travels as a bare hash. A chunk sends its distinct hashes to buckets; a
bucket counts in which chunks a hash occurs and answers one bit a hash: whether an earlier chunk has it. The
chunk then joins the repeated windows of each document into maximal intervals of words and removes them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from canopy.llm.chunks import id_bounds, numbered

WINDOW = 50
BLOCK = 1 << 18     # words whose prefix sums are held at once
# Odd bases of the two hashes. Fixed, as every task must hash alike.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash of every window, modulo 2**64: a difference of prefix sums, shifted to one exponent."""
    n = min(len(words), BLOCK + window)
    powers, inverse = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    out = np.empty(len(words) - window + 1, np.uint64)
    for a in range(0, len(out), BLOCK):
        part = words[a:a + BLOCK + window - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * powers[:len(part)])])
        found = sums[window:] - sums[:-window]
        out[a:a + len(found)] = found * inverse[:len(found)]
    return out


class Windows:
    """The windows of a chunk's documents: distinct hashes in order, and which window has which."""

    def __init__(self, values: list, ids: list, window: int, buckets: int):
        parts = [word_hashes(t.encode().split()) if t and i is not None else np.zeros(0, np.uint64)
                 for t, i in zip(values, ids)]
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        words = np.concatenate([*parts, np.zeros(0, np.uint64)])
        self.at = np.concatenate([np.zeros(0, np.int64), *[
            np.arange(a, a + n - window + 1) for a, n in zip(starts, self.sizes) if n >= window]])
        self.starts = starts
        if not len(self.at):
            self.bounds = np.zeros(buckets + 1, np.int64)
            return
        first = window_hashes(words, window, BASES[0])[self.at]
        second = window_hashes(words, window, BASES[1])[self.at] >> np.uint64(16)
        del words
        ranks = np.unique(np.array(ids, np.int64), return_inverse=True)[1] if None not in ids else None
        if ranks is None:
            given = [i for i in ids if i is not None]
            rank = {i: r for r, i in enumerate(sorted(set(given)))}
            ranks = np.array([rank.get(i, -1) for i in ids])
        doc = np.repeat(ranks.astype(np.int32), np.maximum(self.sizes - window + 1, 0))
        order = np.argsort(first)
        a, b = first[order], second[order]
        same = a[1:] == a[:-1]
        if (b[1:][same] != b[:-1][same]).any():
            order = np.lexsort((second, first))
            a, b = first[order], second[order]
        del first, second
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        heads = np.flatnonzero(new)
        a, b = a[heads], b[heads]
        group = np.empty(len(order), np.int32)
        group[order] = np.cumsum(new, dtype=np.int32) - 1
        earliest = np.minimum.reduceat(doc[order], heads)
        self.later = doc > earliest[group]       # an earlier document of this chunk has the window
        bucket = (b >> np.uint64(16)).astype(np.int64) % buckets
        by_bucket = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        self.first = a[by_bucket]
        self.second = (b[by_bucket] & np.uint64(0xFFFF)).astype("<u2")
        place = np.empty(len(heads), np.int32)
        place[by_bucket] = np.arange(len(heads))
        self.place = place[group]                # of each window, among the distinct hashes


def send(buckets: int, window: int):
    """A chunk's distinct hashes, one row a bucket: 64 bits of one hash and 16 of the other, beside the bucket."""
    def run(table: pa.Table) -> pa.Table:
        w = Windows(table["text"].to_pylist(), table["key"].to_pylist(), window, buckets)
        full = np.flatnonzero(np.diff(w.bounds))
        cut = [(w.bounds[b], w.bounds[b + 1]) for b in full]
        return pa.table({
            "chunk": pa.array([table["chunk"][0].as_py()] * len(full), pa.int32()),
            "bucket": pa.array(full, pa.int32()),
            "first": pa.array([w.first[a:b].tobytes() for a, b in cut], pa.binary()),
            "second": pa.array([w.second[a:b].tobytes() for a, b in cut], pa.binary())})

    return run


def answer(table: pa.Table) -> pa.Table:
    """For every hash of a bucket and chunk, whether an earlier chunk has it; a bit each, in the order sent."""
    table = table.sort_by("chunk")
    chunks = np.array(table["chunk"].to_pylist(), np.int64)
    first = [np.frombuffer(x, "<u8") for x in table["first"].to_pylist()]
    sizes = list(map(len, first))
    first = np.concatenate(first)
    second = np.frombuffer(b"".join(table["second"].to_pylist()), "<u2")
    order = np.lexsort((second, first))          # stable: by chunk within equal hashes
    repeated = np.zeros(len(order), bool)
    repeated[order[1:]] = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    return pa.table({
        "chunk": pa.array(chunks, pa.int32()), "bucket": table["bucket"].combine_chunks(),
        "bits": pa.array([np.packbits(repeated[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})


def intervals(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def cut(text: str | None, spans: list[tuple[int, int]], one_space: bool) -> str | None:
    """Text without the words of the spans: words joined by one space, or the rest as it stood."""
    if text is None:
        return "" if one_space else None
    raw = text.encode()
    if one_space:
        words, kept, at = raw.split(), [], 0
        for a, b in spans:
            kept += words[at:a]
            at = b
        return b" ".join(kept + words[at:]).decode()
    if not spans:
        return text
    places = [m.start() for m in WORD.finditer(raw)] + [len(raw)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:places[a]])
        at = places[b]
    return b"".join(kept + [raw[at:]]).decode()


def nullable(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, nullable(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(nullable(kind.value_type))
    return kind


def remove(buckets: int, window: int, one_space: bool):
    def run(docs: pa.Table, bits: pa.Table) -> pa.Table:
        values, ids = docs["text"].to_pylist(), docs["key"].to_pylist()
        w = Windows(values, ids, window, buckets)
        spans: list = [[] for _ in values]
        if len(w.at):
            answers = dict(zip(bits["bucket"].to_pylist(), bits["bits"].to_pylist()))
            earlier = np.concatenate([
                np.unpackbits(np.frombuffer(answers[b], np.uint8), count=w.bounds[b + 1] - w.bounds[b])
                for b in np.flatnonzero(np.diff(w.bounds)).tolist()]).astype(bool)
            hit = w.at[earlier[w.place] | w.later]
            edge = np.zeros(w.starts[-1] + 1, np.int64)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + window, -1)
            covered = np.cumsum(edge) > 0
            spans = [intervals(covered[a:b]) for a, b in zip(w.starts, w.starts[1:])]
        counts = [len(v.encode().split()) if v else 0 for v in values]
        out = docs.drop_columns(["chunk", "text"])
        if "rest" in out.column_names:       # literals and the like come as not null, the result's schema says nullable
            at = out.column_names.index("rest")
            out = out.set_column(at, "rest", out["rest"].cast(nullable(out["rest"].type)))
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return (out.append_column("text", pa.array([cut(v, s, one_space) for v, s in zip(values, spans)], pa.string()))
                .append_column("n_words", pa.array(counts, pa.int64()))
                .append_column("n_removed", pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()))
                .append_column("spans", pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pair)))

    return run


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   one_space: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller key.

    Returns key, text (what is kept), n_words, n_removed and ``spans``, the maximal intervals of removed
    words, and as ``rest`` a struct of the columns to ``carry`` along. Words are runs without the bytes 20 and 09 to 0D. ``one_space`` joins the kept words by one
    space (null: empty); else the separators stay, a removed word takes those after it along, and a null
    text stays null.

    Windows are judged on the input. A document with fewer words than a window keeps all. Rows that repeat
    a key are one document, so they remove nothing from each other. A row with a null key is neither
    earlier nor later than any: it keeps all and removes nothing. A text of any length is one document of
    one chunk, its windows hashed block by block. Keys are whole numbers, others an error. Only the columns
    to carry along are kept. An empty table gives no rows.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"), *([F.struct(*carry).alias("rest")] if carry else []))
    bounds = id_bounds(docs, "key", "text")
    buckets = max(8, len(bounds) + 1)       # a bucket then holds about as many hashes as a chunk has windows
    parts = numbered(docs, "key", "text", bounds)       # its exchange serves both sides of the cogroup
    sent = parts.groupBy("chunk").applyInArrow(send(buckets, window), "chunk int, bucket int, first binary, second binary")
    bits = sent.groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, bits binary")
    parts_of = dict(docs.dtypes)
    rest = f"rest {parts_of['rest']}, " if carry else ""
    return (parts.groupBy("chunk").cogroup(bits.groupBy("chunk")).applyInArrow(
        remove(buckets, window, one_space),
        f"key {parts_of['key']}, {rest}text string, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>")
        .withColumnRenamed("key", key))
