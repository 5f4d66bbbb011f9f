"""Document fingerprints from Lempel-Ziv phrases, compared like compressors compare texts.

A text is parsed into dictionary phrases: each phrase is the longest one met before and one symbol more
(LZ78). Texts that would compress well together share phrases. The fingerprint is the signature of the
hashed phrase set, its smallest hashes; two signatures estimate the share of common phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from canopy.llm.batches import add_columns, texts
from canopy.llm.chunks import chunk_of, id_bounds, numbered

SMALLEST = 128       # hashes in a signature
LONG_WORD = 32       # code points; longer words are read code point by code point
DIGITS = 8           # hexadecimal digits of a hash


def symbols(text: str) -> list[str]:
    """Words of the text; code points where a word is long, as in scripts without spaces."""
    words = text.split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    return [s for w in words for s in ([w] if len(w) <= LONG_WORD else w)]


def phrases(text: str) -> list[int]:
    """Hashes of the phrases of the parse; the phrase left open at the end was met before."""
    nodes: dict[tuple[int, str], int] = {}
    node, get = 0, nodes.get
    for symbol in symbols(text):
        step = (node, symbol)
        node = get(step, -1)
        if node < 0:
            # A phrase is known by the hash of its path, so the same phrase has one number in all texts.
            nodes[step] = xxhash.xxh3_64_intdigest(symbol, step[0])
            node = 0
    return list(nodes.values())


def signature(text: str | None) -> np.ndarray:
    """Smallest distinct hashes of the phrase set, rising; none for a text without words."""
    found = np.unique(np.array(phrases(text), np.uint64) >> np.uint64(64 - 4 * DIGITS)) if text else np.zeros(0, np.uint64)
    return found[:SMALLEST]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases (0 to 1): of the smallest hashes of both, those in both.

    Exact where both texts have no more phrases than a signature holds. Two empty signatures are alike.
    """
    both = np.union1d(a, b)[:SMALLEST]
    if not len(both):
        return 1.0
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum()) / len(both)


def written(a: np.ndarray) -> str:
    return np.ascontiguousarray(a, ">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2:].tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[i:i + DIGITS], 16) for i in range(0, len(fingerprint), DIGITS)], np.uint64)


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Append the fingerprint of every whole text, hexadecimal; null and wordless texts have the empty one.

    Equal texts have equal fingerprints. Other columns stay; one called ``name`` is replaced.
    """
    return add_columns(df, f"{name} string", lambda: lambda batch: [[written(signature(t)) for t in texts(batch, text)]])


def edited(own: str, other: str) -> str:
    """The text with its last third replaced by the first as many code points of another text."""
    n = len(own) // 3
    return own[:len(own) - n] + other[:n]


def compare(table: pa.Table) -> pa.Table:
    """Documents of a chunk, in falling order, each with the one after it."""
    ids, values, own = (table[c].to_pylist() for c in ("key", "text", "own"))
    order = sorted((i for i in range(len(ids)) if ids[i] is not None), key=lambda i: (ids[i], values[i] is not None, values[i] or ""), reverse=True)
    # Lent rows stand behind the chunk's own: they have smaller ids, or are the largest of all after the smallest.
    order = [i for i in order if own[i]] + [i for i in order if not own[i]]
    after: list = [None] * len(ids)
    for i, j in zip(order, order[1:]):
        after[i] = j
    marks: dict[str, np.ndarray] = {}

    def mark(i: int) -> np.ndarray:
        t = values[i] or ""
        if t not in marks:
            marks[t] = signature(t)
        return marks[t]

    rows = []
    for i in range(len(ids)):
        if not own[i]:
            continue
        text, j = values[i] or "", after[i]
        # A row without a key has no place in the order and is its own next document, as is a lone one.
        other = values[i if j is None else j] or ""
        new = edited(text, other)
        a, b, c = mark(i), signature(new), mark(i if j is None else j)
        rows.append((ids[i], len(text), hashlib.sha256(new.encode()).hexdigest(), written(a), written(b),
                     likeness(a, b), likeness(a, c)))
    columns = list(zip(*rows)) or [[]] * 7
    kinds = [table.schema.field("key").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def lend(parts: DataFrame, heads: list[int], to: list[int]) -> DataFrame:
    """Add ``own``, and a copy of the rows with a key in ``heads`` for the chunk at the same place of ``to``."""
    shared = parts.sparkSession.sparkContext.broadcast((np.array(heads, np.int64), np.array(to, np.int32)))  # one entry a chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, chunks = shared.value
        for batch in batches:
            names = [*batch.schema.names, "own"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.repeat(pa.scalar(True), batch.num_rows)], names=names)
            ids = batch.column("key").fill_null(0).to_numpy(zero_copy_only=False)
            given = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(np.isin(ids, tops) & given)
            if len(rows):
                key, text, _ = batch.take(pa.array(rows)).columns
                chunk = pa.array(chunks[np.searchsorted(tops, ids[rows])])
                yield pa.RecordBatch.from_arrays([key, text, chunk, pa.repeat(pa.scalar(False), len(rows))], names=names)

    return parts.mapInArrow(run, StructType([*parts.schema.fields, StructField("own", BooleanType())]))


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, which ends like the next document begins.

    The next document is that with the next smaller key (after the smallest: the largest); rows that repeat
    a key follow each other by falling text, null last. A null text is empty. A row with a null key, and a
    lone document, is its own next. Documents lie in chunks that follow their keys; each chunk lends its
    first document to the chunk before it, so no text travels twice but one a chunk. An empty table gives
    no rows.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    bounds = id_bounds(docs, "key", "text")
    ids = numbered(docs.where("key is not null").select("key", F.lit("").alias("text")), "key", "text", bounds)
    # Largest key of every chunk that has one: the document that follows the smallest of the chunk above it.
    heads = sorted(r["top"] for r in ids.groupBy("chunk").agg(F.max("key").alias("top")).collect())
    parts = lend(numbered(docs, "key", "text", bounds), heads, [chunk_of(bounds, h) for h in heads[1:] + heads[:1]])
    kind = dict(docs.dtypes)["key"]
    return parts.groupBy("chunk").applyInArrow(
        compare, f"key {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double").withColumnRenamed("key", key)
