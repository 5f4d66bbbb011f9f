"""SimHash near-duplicates: fingerprints of shingles, linked at few differing bits, and their groups.

Fingerprints are cut into so few segments that one of them differs by at most one bit. Every segment is
indexed under one variant per bit, with that bit deleted; two segments that differ by one bit share the
variant of that bit, and equal segments share an exact key. Candidates are the pairs of an equality join
on these keys, verified on all bits inside the join.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from canopy.llm.batches import add_columns, quoted, texts
from canopy.llm.components import components
from canopy.session import cut_lineage

BITS = 64
SEED = 42
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of the bits of the shingles' hashes, as a signed integer; 0 without words."""
    words = text.encode().translate(LOWER).split() if text else []   # splits at the bytes 20 and 09 to 0D
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(line, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        hashes = [digest(line[a:b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1:])]
    count = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], "<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """Append the fingerprint of every whole text as a long; null and wordless texts have 0."""
    return add_columns(df, f"{name} bigint", lambda: lambda batch: [[fingerprint(t, shingle) for t in texts(batch, text)]])


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Pairs (x, y) of the distinct longs in ``f`` that differ in at most ``distance`` bits."""
    segments = distance // 2 + 1
    cuts = [BITS * i // segments for i in range(segments + 1)]
    pieces = [(s, a, b - a) for s, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    def value(a: int, width: int):
        return F.shiftrightunsigned("f", a).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else F.col("f")

    def keys(a: int, width: int, s: int):
        """One key a bit: the segment without that bit, and the bit as the side of the join."""
        def key(j):
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), j)
            return F.struct((F.lit(s * BITS) + j).alias("slot"),
                            value(a, width).bitwiseAND(F.bitwise_not(bit)).alias("rest"),
                            (value(a, width).bitwiseAND(bit) != 0).alias("side"))

        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), key)

    exact = prints.select("f", F.explode(F.array(*[
        F.struct(F.lit(s).alias("slot"), value(a, w).alias("rest")) for s, a, w in pieces])).alias("k")).select("f", "k.*")
    index = prints.select("f", F.explode(F.concat(*[keys(a, w, s) for s, a, w in pieces])).alias("k")).select("f", "k.*")
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance

    def side(frame: DataFrame, name: str) -> DataFrame:
        """Merged, never broadcast: the planner sizes the keys by the fingerprints, of which each has up to 64."""
        return frame.withColumnRenamed("f", name).hint("merge")

    same = (side(exact, "x").join(side(exact, "y"), ["slot", "rest"])
            .where((F.col("x") < F.col("y")) & near).select("x", "y"))
    flipped = (side(index.where("not side").drop("side"), "x").join(
        side(index.where("side").drop("side"), "y"), ["slot", "rest"]).where(near).select("x", "y"))
    return same.union(flipped)


def labelled(df: DataFrame, key: str, text: str, shingle: int, distance: int) -> DataFrame:
    """(key, told, f, component_id) a row; ``told`` is a digest of the text, an empty one for null, as both have one fingerprint."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    prints = cut_lineage(fingerprints(rows.withColumn("told", F.md5("text")), "text", "f", shingle).drop("text"))
    classes = prints.groupBy("f").agg(F.min("key").alias("first"))
    parts = components(links(classes.select("f"), distance), "x", "y").withColumnRenamed("node", "f")
    named = classes.join(parts, "f", "left").select("f", "first", F.coalesce("component", "f").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return prints.join(named.join(least, "component").select("f", "component_id"), "f").select("key", "told", "f", "component_id")


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """(key, fingerprint, component_id): the smallest key reachable over links, one row per input row.

    Equal fingerprints are one node, so copies make no pairs; texts without words share the fingerprint 0
    and are linked like any other. A row with a null key takes part in the links but is never the
    smallest; ``component_id`` is null only where a whole group has null keys. Rows repeating a key are
    rows of one document and each returned. A text of any length is read whole, by one task. Other columns
    are not looked at, whatever their names. An empty table gives no rows.
    """
    return labelled(df, key, text, shingle, distance).select(
        F.col("key").alias(key), F.col("f").alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One document of each group: the one with the smallest key, in all columns of ``df``, whatever their names.

    Exact repeats of that row are the same document and stay; a row of that key with another text is judged
    by its own group. Rows with a null key go if their group has a key; in a group without any they cannot
    be told apart and stay. Rows are met by key and a digest of the text, so no fingerprint is computed twice.
    An empty table gives no rows.
    """
    first = labelled(df, key, text, shingle, distance).where(F.col("key").eqNullSafe(F.col("component_id"))).select(
        F.col("key").alias("k"), F.col("told").alias("t")).distinct()
    rows = df.select(F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("told"), F.struct(*map(quoted, df.columns)).alias("row"))
    return rows.join(first, F.col("key").eqNullSafe(F.col("k")) & (F.col("told") == F.col("t")), "left_semi").select("row.*")
