"""Embedding near-duplicates: cross-polytope hashing, multiprobe buckets, verified candidate pairs.

A vector is rotated at random (three rounds of sign flips and a fast Hadamard transform) and hashed to the
nearest of the signed axes. A table's bucket joins a few such hashes; a vector stands in its own bucket
and, for each hash, in the one with the second nearest axis. Vectors that share a bucket are candidates.
Their sign sketches rule out most chance meetings inside the equality join, and the cosine in double
precision decides. Equal vectors are one node, so copies make no pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from canopy.llm.batches import add_columns
from canopy.llm.components import components
from canopy.session import cut_lineage

SEED = 20240229
BUCKET = 64             # vectors expected in a bucket by chance; more vectors take more hashes a table
MISSED = 0.002          # share of pairs at the threshold that no table may bring together
SIMULATED = 4000        # pairs at the threshold that the number of tables is computed from
LENGTHS = 50            # lengths of vectors whose pairs are found in one plan
SKETCH = 128            # bits
SKETCH_MARGIN = 5.5     # standard deviations allowed to a pair at the threshold


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    width = 1
    while width < d:
        x = x.reshape(n, d // (2 * width), 2, width)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        width *= 2
    return x / math.sqrt(d)


@dataclass
class Hashing:
    """Fixed sign flips: ``flips[r]`` are the three of rotation r; the last ones make the sketch."""
    dim: int
    hashes: int
    tables: int
    flips: np.ndarray

    @property
    def padded(self) -> int:
        return self.flips.shape[2]

    def rotate(self, x: np.ndarray, r: int) -> np.ndarray:
        for signs in self.flips[r]:
            x = hadamard(x * signs)
        return x

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket numbers (vector, table, probe); probe 0 is the own bucket, probe i takes hash i's second axis."""
        n, axes = len(x), 2 * self.padded
        out = np.empty((n, self.tables, self.hashes + 1), np.int64)
        rows = np.arange(n)
        for t in range(self.tables):
            choice = np.empty((2, self.hashes, n), np.int64)
            for h in range(self.hashes):
                y = self.rotate(x, t * self.hashes + h)
                size = np.abs(y)
                for c in range(2):
                    at = size.argmax(1)
                    choice[c, h] = 2 * at + (y[rows, at] < 0)
                    size[rows, at] = -1
            for p in range(self.hashes + 1):
                bucket = np.full(n, t, np.int64)
                for h in range(self.hashes):
                    bucket = bucket * axes + choice[int(h == p - 1), h]
                out[:, t, p] = bucket
        return out

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """Signs of rotated coordinates, as two longs."""
        first = self.tables * self.hashes
        signs = np.concatenate([self.rotate(x, r) >= 0 for r in range(first, len(self.flips))], axis=1)[:, :SKETCH]
        return np.packbits(signs, axis=1).view("<i8")


def make(dim: int, hashes: int, tables: int) -> Hashing:
    padded = max(2, 1 << (dim - 1).bit_length())
    rng = np.random.default_rng(SEED)
    return Hashing(dim, hashes, tables, rng.choice([-1.0, 1.0], (tables * hashes + -(-SKETCH // padded), 3, padded)))


def padded(vectors: np.ndarray, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), max(2, 1 << (dim - 1).bit_length())))
    out[:, :dim] = vectors
    return out


def plan(n: int, dim: int, cosine: float) -> Hashing:
    """Hashes a table from the number of vectors, tables from the simulated rate at which pairs at the threshold meet."""
    axes = 2 * max(2, 1 << (dim - 1).bit_length())
    hashes = max(1, math.ceil(math.log(max(n / BUCKET, 1)) / math.log(axes)))
    rng = np.random.default_rng(SEED + 1)
    a, b = rng.standard_normal((2, SIMULATED, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b / np.where(norm > 0, norm, 1)
    trial = make(dim, hashes, 4)
    x, y = trial.buckets(padded(a, dim)), trial.buckets(padded(b, dim))
    met = (x[:, :, :, None] == y[:, :, None, :]).any((2, 3)).mean()
    return make(dim, hashes, max(1, math.ceil(math.log(MISSED) / math.log(max(1 - met, 1e-9)))))


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    def finite(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda v: v != 0), F.lit(False))


def dot(a: str, b: str) -> Column:
    """Sum of the products of two arrays of doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def links(nodes: DataFrame, cosine: float) -> DataFrame:
    """(a, b) for pairs of different vectors of ``nodes`` (node, v: doubles) with at least that cosine, a < b.

    Vectors of different lengths never link. Hash tables are made for each length that occurs, some lengths
    at a time. Vectors are scaled by a power of two first, which is exact, so that no norm overflows or vanishes.
    """
    lengths = nodes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").toLocalIterator()
    found = None
    for i, r in enumerate(lengths):
        hashing = plan(r["n"], r["dim"], cosine)
        pairs = candidates(nodes.where(F.size("v") == r["dim"]), hashing, cosine)
        found = pairs if found is None else found.union(pairs)
        if i % LENGTHS == LENGTHS - 1:
            found = cut_lineage(found)
    if found is None:
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))
    largest = F.array_max(F.transform("v", F.abs))
    scale = F.pow(F.lit(2.0), F.floor(F.log2(largest)))
    # Bound as a variable, so that the scale is not worked out for every component anew.
    scaled = nodes.withColumn("v", F.get(F.transform(F.array(scale), lambda s: F.transform("v", lambda x: x / s)), F.lit(0)))
    sides = scaled.select("node", "v", F.sqrt(dot("v", "v")).alias("norm"))
    both = (found.join(sides.select(F.col("node").alias("a"), F.col("v").alias("va"), F.col("norm").alias("na")), "a")
            .join(sides.select(F.col("node").alias("b"), F.col("v").alias("vb"), F.col("norm").alias("nb")), "b"))
    return both.where(dot("va", "vb") / (F.col("na") * F.col("nb")) >= cosine).select("a", "b")


def candidates(nodes: DataFrame, hashing: Hashing, cosine: float) -> DataFrame:
    """Distinct pairs (a, b) that share a bucket and whose sketches are near enough, a < b."""
    def start():
        def columns(batch: pa.RecordBatch):
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, hashing.dim)
            scale = np.abs(flat).max(axis=1, keepdims=True, initial=0)      # so that squares neither overflow nor vanish
            x = padded(flat / scale, hashing.dim)
            sketch = hashing.sketch(x)
            return [hashing.buckets(x).reshape(len(x), -1).tolist(), sketch[:, 0].tolist(), sketch[:, 1].tolist()]

        return columns

    index = (add_columns(nodes.select("node", "v"), "buckets array<bigint>, s1 bigint, s2 bigint", start)
             .select("node", "s1", "s2", F.explode("buckets").alias("bucket")))
    off = math.acos(cosine) / math.pi
    most = int(SKETCH * off + SKETCH_MARGIN * math.sqrt(SKETCH * off * (1 - off)))
    x = index.select("bucket", F.col("node").alias("a"), F.col("s1").alias("a1"), F.col("s2").alias("a2"))
    y = index.select("bucket", F.col("node").alias("b"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    apart = F.bit_count(F.col("a1").bitwiseXOR(F.col("b1"))) + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
    return x.join(y, "bucket").where((F.col("a") < F.col("b")) & (apart <= most)).select("a", "b").distinct()


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """(key, n_links, component_id, kept), one row per input row.

    ``n_links`` counts the other rows whose vector has at least that cosine, equal vectors included;
    ``component_id`` is the smallest key reachable over links, itself included; ``kept`` marks the row that
    has it. Null, empty and zero vectors and those with null or non-finite components link with nothing and
    are their own component. Rows that repeat a key count as rows. A row with a null key links like any
    other but is never the smallest; alone, its component is null and it is not kept. An empty table gives
    no rows.
    """
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    good = rows.where(usable(F.col("v")))
    # One node per different vector; the numbers only tell them apart.
    classes = cut_lineage(good.groupBy("v").agg(F.min("key").alias("first"), F.count("*").alias("n"))
                          .withColumn("node", F.monotonically_increasing_id()))
    pairs = cut_lineage(links(classes.select("node", "v"), cosine))
    counts = (pairs.union(pairs.select("b", "a")).toDF("node", "other")
              .join(classes.select(F.col("node").alias("other"), F.col("n").alias("others")), "other")
              .groupBy("node").agg(F.sum("others").alias("others")))
    parts = components(pairs, "a", "b")
    labelled = (classes.join(counts, "node", "left").join(parts, "node", "left")
                .select("v", "first", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "node").alias("component")))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    known = labelled.join(least, "component").select(F.col("v").alias("w"), "n_links", "component_id")
    joined = good.join(known, F.col("v") == F.col("w")).select("key", "n_links", "component_id")
    lone = rows.where(~usable(F.col("v"))).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return joined.union(lone).select(
        F.col("key").alias(key), "n_links", "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"))
