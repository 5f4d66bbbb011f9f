"""Mixing sources to target weights by systematic sampling.

Targets share out a multiple of all words by weight; a source's target stops at a multiple of its size and
the excess is shared anew. Within a source every document expects ``target / size of the source`` copies.
The documents stand in order of size, so a systematic sample takes its share of every size; the expected
copies are prefix-summed, one random offset is added per source, and a document is emitted once for every
integer boundary that its stretch of the sum crosses.

A source's order is cut into cells of equal size and hash. Counts per cell are summed over the cells of a
size and over the sizes of a source, so a source of any size is never gathered in a task.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from canopy.llm.batches import quoted
from canopy.session import cut_lineage

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CELL_ROWS = 512        # rows of one size in a source that share a cell, about


def targets(sizes: dict, weights: dict, share: float, most: float) -> dict:
    """Words to take per source: ``share`` of all words by weight, at most ``most`` times the source.

    What a source may not take is shared by weight among those below their limit, until none is above. If
    all are at their limit, the rest is not placed.
    """
    left = Fraction(share).limit_denominator(10**6) * sum(sizes.values())
    limit = {s: Fraction(most).limit_denominator(10**6) * n for s, n in sizes.items()}
    got = dict.fromkeys(sizes, Fraction(0))
    open_ = set(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total >= limit[s]}
        if not full:
            for s in open_:
                got[s] = left * weights[s] / total
            break
        for s in full:
            got[s] = limit[s]
        left -= sum(limit[s] for s in full)
        open_ -= full
    return {s: float(t) for s, t in got.items()}


def hashed(parts: list[Column], seed: str, digits: int) -> Column:
    """Number of the first hexadecimal digits of an MD5 over the parts (null: empty) and the seed."""
    told = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts], F.lit(seed))
    return F.conv(F.substring(F.md5(told), 1, digits), 16, 10).cast("long")


def by_code_point(sources: list) -> list:
    """Sources in code point order, null last."""
    return sorted(sources, key=lambda s: (s is None, s))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix",
        most_sources: int = 100_000) -> DataFrame:
    """(key, source, size, source_size, target, copies, tie) for every row of the table.

    ``size`` counts the words of the whole text (null: 0). The weights repeat over the sources in code
    point order, null last. A document of size 0 is in the sample like any other and adds nothing. The
    offset is a hash of seed and source, and documents of one size stand in the order of a hash of key, text
    and seed, so reruns agree; rows alike in both take each other's place. No row gets more copies than ``most`` rounded up.
    The table of sources is bounded by ``most_sources``; more raise an error. An empty table gives no rows.
    """
    rows = cut_lineage(df.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        hashed([F.col(key), F.col(text)], seed, 15).alias("tie")))
    sums = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).limit(most_sources + 1).collect()
    if len(sums) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    size = {r["source"]: r["n"] for r in sums}
    order = by_code_point(list(size))
    target = targets(size, {s: weights[i % len(weights)] for i, s in enumerate(order)}, share, most)
    spark = df.sparkSession
    of_source = spark.createDataFrame(
        [(i, s, size[s], target[s], target[s] / size[s] if size[s] else 0.0) for i, s in enumerate(order)],
        "s int, source string, source_size long, target double, rate double")
    numbered = rows.join(F.broadcast(of_source), rows["source"].eqNullSafe(of_source["source"])).drop(of_source["source"])

    # Cells: the rows of a source and size, cut by hash into about CELL_ROWS rows each.
    by_size = numbered.groupBy("s", "size").agg(F.count("*").alias("n")).withColumn(
        "pieces", F.greatest(F.lit(1), F.ceil(F.col("n") / CELL_ROWS)).cast("long"))
    upto = Window.partitionBy("s").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.withColumn("below", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    placed = numbered.join(by_size.select("s", "size", "pieces", "below"), ["s", "size"]).withColumn(
        "cell", F.floor(F.col("tie") / float(1 << 60) * F.col("pieces")).cast("long"))
    cells = placed.groupBy("s", "size", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("s", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("in_size", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("s", "size", "cell").orderBy("tie", "key")
    offset = hashed([F.col("source")], seed, 5) / float(1 << 20)
    at = F.col("below") + F.col("in_size") + F.row_number().over(within)     # 1-based place in the source
    return (placed.join(cells, ["s", "size", "cell"]).withColumn("at", at)
            .withColumn("copies", (F.floor(F.col("at") * F.col("rate") + offset)
                                   - F.floor((F.col("at") - 1) * F.col("rate") + offset)).cast("long"))
            .select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "copies", "tie"))


def take(df: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "mix", **settings) -> DataFrame:
    """The mix itself: every row as often as ``mix`` says, in all columns of ``df``, whatever their names.

    See ``mix`` for the settings. Rows are met by key and hash. Rows alike in both share their copies as evenly
    as whole numbers allow, so repeated rows and null keys get their own; only the number of copies of
    alike rows is summed, no list of them. An empty table gives no rows.
    """
    shared = (mix(df, key, text, seed=seed, **settings).groupBy(F.struct(F.col(key).alias("key"), F.col("tie")).alias("at"))
              .agg(F.sum("copies").alias("copies"), F.count("*").alias("n")).where("copies > 0")
              .select("at", F.expr("copies div n").alias("each"), (F.col("copies") % F.col("n")).alias("more")))
    tie = hashed([F.col(key), F.col(text)], seed, 15)
    rows = df.select(F.struct(F.col(key).alias("key"), tie.alias("tie")).alias("at"), F.struct(*map(quoted, df.columns)).alias("row"))
    alike = Window.partitionBy("at").orderBy("at")       # in the order of the join: texts are shuffled once
    copies = F.col("each") + (F.row_number().over(alike) <= F.col("more")).cast("long")
    return (rows.join(shared, "at").withColumn("copies", copies).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))
