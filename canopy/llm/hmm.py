"""Hidden Markov language model: latent states over word sequences, trained by Baum-Welch, scored exactly.

A text is its words and one end. The texts are first written in shards, as numbers of the shard's words. Each
training round is a pass over all shards: a task runs the scaled forward and backward recursions over the texts
that learn, many side by side, and hands on its expected counts, which Spark sums. The first rounds tie the
emissions of words to ``CLASSES`` hash classes, so their parameters have a fixed size and travel with the tasks;
the states and moves are found there. The last round counts by word. That table has a row for every word of
the corpus, is never gathered, and meets the shards in a join: a shard asks once for each of its words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from canopy.llm.batches import bound_batches
from canopy.session import new_folder

CLASSES = 1 << 14
STAY = 0.9                  # first probability of keeping a state
SPREAD = 1.0                # of the first, random log emissions
OWN = 0.9                   # share of a state's own counts in its emissions while training; the rest is the corpus's
UNIT = 1024                 # expected counts are summed in parts of one: whole numbers, so that order does not count
SHARD_BYTES = 24 << 20      # text whose words are numbered together
SIDE_TOKENS = 1 << 20       # tokens of texts that run side by side
BLOCK_TOKENS = 300_000      # tokens whose messages are held at once
LONGEST_WORD = 40           # bytes; a longer word goes by its digest, which is longer than that
END = b""


class Words(dict):
    """Number of every word met, from 0."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def tokens(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case, and the end. Bytes outside ASCII are letters of words."""
    return [*(text or b"").lower().split(), END]


def names(words: Sequence[bytes]) -> list[bytes]:
    """The words as table keys: of bounded length, and different for different words."""
    return [w if len(w) <= LONGEST_WORD else hashlib.sha384(w).digest() for w in words]


def classes(words: Sequence[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) & (CLASSES - 1) for w in words], np.uint16)


# --- recursions -------------------------------------------------------------------------------

class Lanes:
    """Texts side by side, longest first: the tokens in order of time, then of text."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        long_first = lengths[self.order]
        starts = (np.cumsum(lengths) - lengths)[self.order]
        steps = int(long_first[0]) if len(long_first) else 0
        # How many texts are longer than t, for every t.
        self.sizes = len(lengths) - np.searchsorted(long_first[::-1], np.arange(steps), "right")
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.lane = np.arange(self.offsets[-1]) - np.repeat(self.offsets[:-1], self.sizes)
        self.ids = ids[starts[self.lane] + np.repeat(np.arange(steps), self.sizes)]

    def blocks(self) -> list[tuple[int, int]]:
        """Steps cut so that a block holds about ``BLOCK_TOKENS`` tokens."""
        cuts = np.unique(np.searchsorted(self.offsets, np.arange(0, self.offsets[-1], BLOCK_TOKENS), "left"))
        cuts = [*cuts.tolist(), len(self.sizes)]
        return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def forward(e: np.ndarray, sizes: list[int], before: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward messages of a block, written over its emissions; the scales and the states expected next."""
    scale, at = np.empty(len(e)), 0
    for n in sizes:
        a, s = e[at:at + n], scale[at:at + n]
        np.multiply(a, before[:n], out=a)
        np.add.reduce(a, 1, out=s)
        np.divide(a, s[:, None], out=a)
        before = a @ moves
        at += n
    return scale, before


def backward(v: np.ndarray, sizes: list[int], after: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backward messages of a block from its scaled emissions, which they are multiplied into; and what is before it."""
    beta, back, at = np.ones_like(v), np.ascontiguousarray(moves.T), len(v)
    beta[at - sizes[-1]:at - sizes[-1] + len(after)] = after
    for i in range(len(sizes) - 1, -1, -1):
        n = sizes[i]
        now = v[at - n:at]
        np.multiply(now, beta[at - n:at], out=now)
        at -= n
        if i:
            np.matmul(now, back, out=beta[at - sizes[i - 1]:at - sizes[i - 1] + n])
    return beta, v[:sizes[0]] @ back


def log_likelihoods(ids: np.ndarray, lengths: np.ndarray, table: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """log10 probability of every text by the scaled forward recursion; ``table`` has the emissions by id."""
    lanes, out = Lanes(ids, lengths), np.zeros(len(lengths))
    before = np.tile(first, (len(lengths), 1))
    for a, b in lanes.blocks():
        part = slice(lanes.offsets[a], lanes.offsets[b])
        scale, before = forward(table[lanes.ids[part]], lanes.sizes[a:b].tolist(), before, moves)
        out += np.bincount(lanes.lane[part], np.log10(scale), len(out))
    told = np.empty(len(lengths))
    told[lanes.order] = out
    return told


def expected(ids: np.ndarray, lengths: np.ndarray, table: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """Baum-Welch counts of some texts: by id and state, of first states, of moves.

    The forward messages of one block are held; of the blocks before it only their ends, from which the
    messages are made again.
    """
    k = table.shape[1]
    lanes = Lanes(ids, lengths)
    blocks, seen = lanes.blocks(), np.zeros((len(table), k))
    begins, before, last = [], np.tile(first, (len(lengths), 1)), np.zeros((0, k))
    for n, (a, b) in enumerate(blocks):
        begins.append((before, last))
        if n + 1 < len(blocks):
            e = table[lanes.ids[lanes.offsets[a]:lanes.offsets[b]]]
            _, before = forward(e, lanes.sizes[a:b].tolist(), before, moves)
            last = e[len(e) - lanes.sizes[b - 1]:].copy()
    starts, pairs, after = np.zeros(k), np.zeros((k, k)), np.zeros((0, k))
    for (a, b), (before, last) in zip(reversed(blocks), reversed(begins)):
        at, sizes = lanes.ids[lanes.offsets[a]:lanes.offsets[b]], lanes.sizes[a:b].tolist()
        alpha = table[at]
        v = alpha.copy()
        scale, _ = forward(alpha, sizes, before, moves)
        v /= scale[:, None]
        beta, after = backward(v, sizes, after, moves)
        if a:
            pairs += last[:sizes[0]].T @ v[:sizes[0]]
        here = np.arange(sizes[0], len(v))
        pairs += alpha[here - np.repeat(lanes.sizes[a:b - 1], lanes.sizes[a + 1:b])].T @ v[sizes[0]:]
        alpha *= beta
        if not a:
            starts = alpha[:sizes[0]].sum(0)
        for s in range(k):
            seen[:, s] += np.bincount(at, alpha[:, s], len(seen))
    return seen, starts, pairs * moves


# --- shards -----------------------------------------------------------------------------------

def numbered(texts: Sequence[bytes | None], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers of all texts, one after the other, and the texts' lengths."""
    parts = [np.fromiter(map(words.__getitem__, found), np.int32, len(found)) for found in map(tokens, texts)]
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), np.array([len(p) for p in parts], np.int64)


def prepare(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(shard, words, classes, keys, learn, lengths, size, ids): the texts in shards, written and read again.

    A shard is up to ``SHARD_BYTES`` of text that one task reads, or one longer text. ``ids`` are the packed
    numbers of its words, text by text, and ``classes`` the words' classes; a null text is empty, and a null
    ``learn`` is false.
    """
    spark = df.sparkSession
    bound_batches(spark)
    schema = (f"shard bigint, words array<binary>, classes binary, keys array<{df.schema[key].dataType.simpleString()}>, learn array<boolean>, "
              "lengths array<bigint>, size bigint, ids binary")
    out = to_arrow_schema(StructType.fromDDL(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        words, ids, lengths, keys, learns, size = Words(), [], [], [], [], 0

        def row():
            raw = np.concatenate(ids).astype(np.int32).tobytes()
            known = names(list(words))
            made = [[shard], [known], [classes(known).tobytes()], [keys], [learns], [np.concatenate(lengths)], [len(raw)],
                    [pa.compress(raw, "zstd", asbytes=True)]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, out)], schema=out)

        for batch in batches:
            found = batch.column("text").cast(pa.binary()).to_pylist()
            some, of = numbered(found, words)
            ids.append(some)
            lengths.append(of)
            keys += batch.column("key").to_pylist()
            learns += batch.column("learn").to_pylist()
            size += sum(len(t) for t in found if t)
            if size >= SHARD_BYTES:
                yield row()
                shard += 1
                words, ids, lengths, keys, learns, size = Words(), [], [], [], [], 0
        if keys:
            yield row()

    folder = new_folder(spark, "shards")
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    rows.mapInArrow(task, schema).write.option("parquet.block.size", 8 << 20).option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a shard's words and the lengths of its texts."""
    return (np.frombuffer(pa.decompress(row["ids"].as_py(), row["size"].as_py(), "zstd", asbytes=True), np.int32),
            row["lengths"].values.to_numpy())


def side_by_side(ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Texts in a row, cut where they hold about ``SIDE_TOKENS``: which they are, their numbers and lengths."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        begin = ends[at] - lengths[at]
        stop = max(int(np.searchsorted(ends, begin + SIDE_TOKENS, "right")), at + 1)
        yield slice(at, stop), ids[begin:ends[stop - 1]], lengths[at:stop]
        at = stop


# --- training ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class States:
    """Parameters of fixed size: first states, moves, and how much likelier a class is in a state than at large."""
    first: np.ndarray
    moves: np.ndarray
    ratio: np.ndarray


def begin(states: int) -> States:
    """Even first states, sticky moves and random emissions from a fixed seed."""
    rng = np.random.default_rng(17)
    moves = np.full((states, states), (1 - STAY) / max(states - 1, 1))
    np.fill_diagonal(moves, STAY if states > 1 else 1.0)
    return States(np.full(states, 1 / states), moves, np.exp(rng.normal(0, SPREAD, (CLASSES, states))))


WORD, CLASS, MOVE, FIRST = range(4)


def counted(written: DataFrame, now: States, by_word: bool) -> DataFrame:
    """Expected counts of one round as rows (kind, name, c, g0, g1, …), summed over all shards.

    A row belongs to a word, a class, the moves out of a state or the first states. ``c`` is the plain count,
    ``g`` the expected one by state, in parts of ``UNIT``.
    """
    spark, k = written.sparkSession, len(now.first)
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(now)        # of fixed size
    gs = [f"g{s}" for s in range(k)]
    schema = "kind tinyint, name binary, c bigint, " + ", ".join(f"{g} bigint" for g in gs)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def rows(kind: int, keys: pa.Array | list[bytes], c: np.ndarray, g: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, units = pa.array(keys, pa.binary()), np.rint(g * UNIT).astype(np.int64)
        columns = [pa.array(np.full(len(c), kind, np.int8)), keys, pa.array(c.astype(np.int64)), *[pa.array(units[:, s]) for s in range(k)]]
        whole = pa.RecordBatch.from_arrays(columns, schema=out)
        yield from (whole.slice(i, 20_000) for i in range(0, len(c), 20_000))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        of_class, starts, pairs = np.zeros((CLASSES, k + 1)), np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                ids, lengths = unpacked(row)
                learns = row["learn"].values.to_numpy(zero_copy_only=False)
                ids, lengths = ids[np.repeat(learns, lengths)], lengths[learns]
                of = np.frombuffer(row["classes"].as_py(), np.uint16)
                table, seen = state.ratio[of], np.zeros((len(of), k))
                for _, some, long in side_by_side(ids, lengths):
                    got, first, moved = expected(some, long, table, state.first, state.moves)
                    seen, starts, pairs = seen + got, starts + first, pairs + moved
                plain = np.bincount(ids, minlength=len(of))
                if by_word:
                    met = np.flatnonzero(plain)
                    yield from rows(WORD, row["words"].values.take(pa.array(met)), plain[met], seen[met])
                else:
                    for s, x in enumerate([*seen.T, plain]):
                        of_class[:, s] += np.bincount(of, x, CLASSES)
        if not by_word:
            met = np.flatnonzero(of_class[:, k])
            yield from rows(CLASS, [int(x).to_bytes(4, "big") for x in met], of_class[met, k], of_class[met, :k])
        yield from rows(MOVE, [bytes([s]) for s in range(k)], np.zeros(k), pairs)
        yield from rows(FIRST, [b""], np.zeros(1), starts[None])

    columns = [*(["words"] if by_word else []), "classes", "learn", "lengths", "size", "ids"]
    return written.select(columns).mapInArrow(task, schema).groupBy("kind", "name").agg(
        F.sum("c").alias("c"), *[F.sum(g).alias(g) for g in gs])


def shares(counts: np.ndarray) -> np.ndarray:
    """Counts along the last axis as probabilities, one pseudocount spread over each."""
    return (counts + 1 / counts.shape[-1]) / (counts.sum(-1, keepdims=True) + 1)


def small(rows: Sequence, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First states and moves from the few rows that have them."""
    first, moves = np.zeros(k), np.zeros((k, k))
    for r in rows:
        g = np.array([r[f"g{s}"] for s in range(k)]) / UNIT
        if r["kind"] == FIRST:
            first += g
        elif r["kind"] == MOVE:
            moves[r["name"][0]] += g
    return shares(first), shares(moves)


@dataclass(frozen=True)
class Model:
    """First states and moves; the words' counts and expected counts by state as a table; its sums."""
    first: np.ndarray
    moves: np.ndarray
    words: DataFrame            # name, c, g0, g1, …
    tokens: int                 # all training tokens
    distinct: int
    totals: np.ndarray          # expected tokens by state, in parts of UNIT


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffles of an action go when it ends: no frame of the training is used twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def fit(written: DataFrame, states: int = 6, tied_rounds: int = 3) -> Model:
    """Train on the texts of the shards that learn, all of them in every round.

    ``tied_rounds`` rounds tie words to classes, one more round counts by word.
    """
    spark, now = written.sparkSession, begin(states)
    gs = [f"g{s}" for s in range(states)]
    with shuffles_freed(spark):
        for _ in range(tied_rounds):
            found = counted(written, now, False).collect()         # at most CLASSES rows and a few
            c, g = np.zeros(CLASSES), np.zeros((CLASSES, states))
            for r in found:
                if r["kind"] == CLASS:
                    at = int.from_bytes(r["name"], "big")
                    c[at], g[at] = r["c"], [r[x] for x in gs]
            large = (c + 1e-9) / (c.sum() + 1e-9 * CLASSES)
            now = States(*small(found, states), OWN * g / np.maximum(g.sum(0), 1) / large[:, None] + (1 - OWN))
        folder = new_folder(spark, "words")
        counted(written, now, True).write.option("compression", "zstd").parquet(folder)
    table = spark.read.parquet(folder)
    first, moves = small(table.where(F.col("kind") != WORD).collect(), states)       # one row a state and one more
    words = table.where(F.col("kind") == WORD).drop("kind")
    n, v, *totals = words.agg(F.sum("c"), F.count("*"), *[F.sum(g) for g in gs]).first()
    return Model(first, moves, words, n or 0, v, np.array([float(t or 0) for t in totals]))


# --- scoring ----------------------------------------------------------------------------------

def score(written: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for every text of the shards.

    ``score`` is the model's exact log10 probability of the whole text: words and end. A state emits a word by
    its own expected counts and, as if there were one count more for every distinct word, by the add-one
    frequency of the corpus, which an unknown word gets as well; ``base_score`` is that of the add-one frequencies
    alone. A null or empty text is its end
    alone. Repeated rows and null keys have rows of their own, other columns play no part, an empty table gives
    none. Where nothing was learnt, both scores are 0. Memory is bounded by a shard's words and the numbers of
    the longest text.
    """
    k = len(model.first)
    spark, gs = written.sparkSession, [f"g{s}" for s in range(k)]
    asked = written.select(F.col("shard").alias("asking"), F.posexplode("words").alias("i", "name"))
    told = asked.join(model.words, "name").drop("name")
    first, moves, n, v, totals = model.first, model.moves, model.tokens, model.distinct, model.totals
    schema = f"key {written.schema['keys'].dataType.elementType.simpleString()}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: texts[c][0] for c in texts.column_names}         # a shard is one row
        words = row["words"].as_py()
        c, g = np.zeros(words), np.zeros((words, k))
        at = answers["i"].to_numpy()
        c[at] = answers["c"].to_numpy()
        for s, name in enumerate(gs):
            g[at, s] = answers[name].to_numpy()
        large = (c + 1) / (n + v + 1)
        own = totals / np.maximum(totals + UNIT * v, 1)
        table = own * g / np.maximum(totals, 1) + (1 - own) * large[:, None]
        base = np.log10(large)
        ids, lengths = unpacked(row)
        known, plain, told = (np.zeros(len(lengths)) for _ in range(3))
        for here, some, long in side_by_side(ids, lengths):
            of = np.repeat(np.arange(len(long)), long)
            known[here], plain[here] = np.bincount(of, c[some] > 0, len(long)), np.bincount(of, base[some], len(long))
            told[here] = log_likelihoods(some, long, table, first, moves)
        return pa.Table.from_arrays([row["keys"].values, pa.array(lengths), pa.array(known.astype(np.int64)), pa.array(np.full(len(lengths), n)),
                                     pa.array(plain), pa.array(told)], schema=out)

    bound_batches(spark)
    texts = written.select("shard", F.size("words").alias("words"), "keys", "lengths", "size", "ids")
    return texts.groupBy("shard").cogroup(told.groupBy("asking")).applyInArrow(run, schema).withColumnRenamed("key", key)
