"""Ranked lexical search, term at a time, with a limit on accumulators that loses nothing.

A first pass writes each document's counts of the queries' terms and sums the corpus statistics. A second
reads them in shards. A shard inverts its documents, and for each query takes the terms from the rarest on:
a term adds its part to the accumulators of its documents. Once what the remaining terms can add at most is
less than the k-th best partial score, a document without an accumulator cannot come among the best any more,
and no accumulator is made from there on; those that can still reach are updated to their exact scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from canopy.llm.batches import bound_batches
from canopy.operators.relational import union_all
from canopy.session import new_folder

# On bytes in lower case: letters and digits, and all of UTF-8 outside ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
LONG_TEXT = 1 << 20             # bytes from which terms are read one by one
QUERY_BYTES = 4 << 20           # text of the queries that run together
SHARD_ROWS = 1 << 16            # documents inverted together
SHARD_POSTINGS = 1 << 21
SALTS = 64                      # parts of a query's candidates that are ranked on their own first


def term_counts(text: bytes | None, number) -> tuple[int, Counter]:
    """How many terms a text has, and how often those that ``number`` (bytes to number or None) knows."""
    text = (text or b"").lower()
    if len(text) < LONG_TEXT:
        found = TERM.findall(text)
        counts = Counter(map(number, found))
        n = len(found)
    else:
        counts = Counter(number(m.group()) for m in TERM.finditer(text))
        n = counts.total()
    counts.pop(None, None)
    return n, counts


def query_blocks(queries: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """(item, text) of all queries, at most ``QUERY_BYTES`` of text at a time, or one query if it is longer."""
    block, size = [], 0
    for r in queries.select(F.col(item).alias("i"), F.col(text).cast("binary").alias("t")).toLocalIterator():
        block.append((r["i"], r["t"]))
        size += len(r["t"] or b"") + 16
        if size >= QUERY_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def index(docs: DataFrame, key: str, text: str, numbers: dict[bytes, int]) -> DataFrame:
    """(key, n, terms, counts) of every document that has a term, written and read again."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(numbers)       # a block of queries
    schema = f"key {docs.schema[key].dataType.simpleString()}, n bigint, terms array<int>, counts array<bigint>"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            found = [term_counts(t, number) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            keep = [i for i, (n, _) in enumerate(found) if n]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(keep, pa.int64())), pa.array([found[i][0] for i in keep], pa.int64()),
                 pa.array([list(found[i][1].keys()) for i in keep], out.field("terms").type),
                 pa.array([list(found[i][1].values()) for i in keep], out.field("counts").type)], schema=out)

    folder = new_folder(spark, "index")
    docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(task, schema).write.parquet(folder)
    return spark.read.parquet(folder)


class Shard:
    """Some documents inverted: for each term its documents' places and what it adds to their scores."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, docs: int, length: int):
        self.keys = pa.concat_arrays([b.column("key") for b in batches])
        self.size = len(self.keys)
        # Place of every document in the order of the keys, null first: equal scores go by it.
        by_key = pc.sort_indices(self.keys, null_placement="at_start").to_numpy()
        self.order = np.empty(self.size, np.int64)
        self.order[by_key] = np.arange(self.size)
        n = np.concatenate([b.column("n").to_numpy() for b in batches])
        terms = np.concatenate([b.column("terms").flatten().to_numpy() for b in batches])
        tf = np.concatenate([b.column("counts").flatten().to_numpy() for b in batches])
        doc = np.repeat(np.arange(self.size), np.concatenate([b.column("terms").value_lengths().to_numpy() for b in batches]))
        by_term = np.argsort(terms, kind="stable")
        terms, tf, self.doc = terms[by_term], tf[by_term], doc[by_term]
        self.adds = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * (50 + 50 * n * docs // length)[self.doc]))
        self.starts = np.searchsorted(terms, np.arange(len(weights) + 1))
        filled = np.flatnonzero(np.diff(self.starts))
        self.most = np.zeros(len(weights), np.int64)
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.adds, self.starts[filled])

    def best(self, terms: Sequence[int], k: int, reached: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best k documents; ``reached`` is a score that k others are known to have, or 0."""
        bounds = self.most[terms]
        left = bounds.sum()
        acc = np.zeros(self.size, np.int64)
        least, done, at = reached, 0, 0
        for at, t in enumerate(terms):
            # What is left cannot lift a new document to the k-th place, not even to a tie.
            if left < least:
                break
            rows = slice(self.starts[t], self.starts[t + 1])
            acc[self.doc[rows]] += self.adds[rows]          # a document is once in a term's list
            left -= bounds[at]
            done += bounds[at]
            if left < done and at + 1 < len(terms):         # no partial score exceeds what was added at most
                least = max(least, kth(acc, k))
        else:
            at = len(terms)
        alive = np.flatnonzero(acc)
        for i in range(at, len(terms)):
            alive = alive[acc[alive] + left >= least]
            rows = slice(self.starts[terms[i]], self.starts[terms[i] + 1])
            docs, adds = self.doc[rows], self.adds[rows]
            if len(docs):
                where = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                acc[alive] += np.where(docs[where] == alive, adds[where], 0)
            left -= bounds[i]
            least = max(least, kth(acc[alive], k))
        alive = alive[acc[alive] >= max(least, 1)]
        if len(alive) > k:
            alive = alive[np.lexsort((self.order[alive], -acc[alive]))[:k]]
        return alive, acc[alive]


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def shard_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, rows, postings = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        postings += len(batch.column("terms").flatten())
        if rows >= SHARD_ROWS or postings >= SHARD_POSTINGS:
            yield held
            held, rows, postings = [], 0, 0
    if rows:
        yield held


def candidates(written: DataFrame, wanted: list[list[int]], weights: np.ndarray, docs: int, length: int, k: int) -> DataFrame:
    """(q, key, score): the best k documents of every query and shard, as far as they can be among the best of all."""
    spark = written.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast((wanted, weights))     # a block of queries
    schema = f"q int, key {written.schema['key'].dataType.simpleString()}, score bigint"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, w = shared.value
        top = [np.zeros(0, np.int64) for _ in queries]      # best scores so far, k at most
        for held in shard_batches(batches):
            shard = Shard(held, w, docs, length)
            for q, terms in enumerate(queries):
                at, scores = shard.best(terms, k, kth(top[q], k))
                if len(at):
                    top[q] = np.sort(np.concatenate([top[q], scores]))[-k:]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), q, np.int32)), shard.keys.take(pa.array(at)), pa.array(scores)], schema=out)

    return written.mapInArrow(task, schema)


def search(queries: DataFrame, docs: DataFrame, k: int = 50, item: str = "item_id", query_text: str = "text",
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, rank, key, score): the best k documents with a score above 0 of every query, whole texts compared.

    Terms, weights and scores are whole numbers as documented in ``Shard`` and below; equal scores go by
    ascending key, null first, and repeated rows of a document follow each other. A null or empty query, or one
    whose terms no document has, gives no rows; a repeated item is ranked again. A null text has no terms and
    is in no statistic. Queries run in blocks of bounded text, each over all documents; other columns play no
    part. A text of any length is read whole, in one task; its counts are as many as the block's terms at most.
    """
    spark = docs.sparkSession
    parts = []
    for block in query_blocks(queries, item, query_text):
        found = [TERM.findall((t or b"").lower()) for _, t in block]
        numbers = {t: i for i, t in enumerate(dict.fromkeys(t for terms in found for t in terms))}
        written = index(docs, key, text, numbers)
        n, length = written.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(numbers), np.int64)
        for r in written.select(F.explode("terms").alias("t")).groupBy("t").count().collect():     # one row a term of the block
            df[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        # The rarest first; a term without weight or documents adds nothing.
        wanted = [sorted({t for t in (numbers[x] for x in terms) if df[t] and weights[t]}, key=lambda t: (df[t], t)) for terms in found]
        kind = queries.schema[item].dataType.simpleString()
        items = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q int, item {kind}")
        of_part = Window.partitionBy("q", "salt").orderBy(F.desc("score"), F.asc_nulls_first("key"))
        of_query = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("key"))
        best = (candidates(written, wanted, weights, n, length or 1, k).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
                .withColumn("rank", F.row_number().over(of_part)).where(F.col("rank") <= k)
                .withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k))
        parts.append(best.join(F.broadcast(items), "q").select("item", "rank", "key", "score"))
    if not parts:
        kinds = queries.schema[item].dataType.simpleString(), docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"{item} {kinds[0]}, rank int, {key} {kinds[1]}, score bigint")
    return union_all(*parts).toDF(item, "rank", key, "score")
