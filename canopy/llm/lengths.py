"""Exact histogram of encoded lengths, and from it every total, quantile and truncated total.

Documents are counted by their number of tokens. Sums from the long end (suffix sums) of the documents and
the tokens say, for a context limit L: how many documents are longer, how many tokens all texts keep when
cut at L, how many are lost. The number of distinct lengths does not follow the number of documents, and
the sums run over blocks of lengths, so no step holds more than one block or one row a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from canopy.llm.bpe import encode
from canopy.session import cut_lineage

BLOCK = 1024      # lengths in a block


def histogram(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(length, docs): documents of every whole text's token count; null and empty texts have length 0."""
    return encode(df.select(text), path, text, count="length").groupBy("length").agg(F.count("*").alias("docs"))


def limits(lengths: DataFrame) -> DataFrame:
    """Per distinct length, taken as the context limit, from a frame (length, docs); repeated lengths add up.

    docs, tokens             of exactly this length
    docs_from, tokens_from   of this length or longer (suffix sums)
    rank_to                  share of the documents that are no longer: the length is every quantile up to it
    truncated                tokens that stay when every text is cut at the limit
    lost                     tokens cut off
    total_docs, total_tokens of the table
    A limit between two lengths is answered by the larger one: its truncated total less docs_from for each
    token of difference. Rows with a null length are left out as they have no tokens to count. An empty table
    gives no rows.
    """
    # Checkpointed, as it is read for the blocks and for the rows, and what it is made from may be every text.
    rows = cut_lineage(lengths.where("length is not null").groupBy("length").agg(F.sum("docs").alias("docs")).select(
        "length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), F.floor(F.col("length") / BLOCK).alias("block")))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)    # one row a block
    everything = Window.partitionBy()
    above = blocks.select("block", *[F.coalesce(F.sum(x).over(longer), F.lit(0)).alias(f"{x}_above") for x in "dt"],
                          F.sum("d").over(everything).alias("total_docs"), F.sum("t").over(everything).alias("total_tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(above, "block").select(
        "length", "docs", "tokens", (F.col("d_above") + F.sum("docs").over(within)).alias("docs_from"),
        (F.col("t_above") + F.sum("tokens").over(within)).alias("tokens_from"), "total_docs", "total_tokens")
    lost = F.col("tokens_from") - F.col("length") * F.col("docs_from")
    return summed.select(
        "length", "docs", "tokens", "docs_from", "tokens_from",
        ((F.col("total_docs") - F.col("docs_from") + F.col("docs")) / F.col("total_docs")).alias("rank_to"),
        (F.col("total_tokens") - lost).alias("truncated"), lost.alias("lost"), "total_docs", "total_tokens")


def quantile(found: DataFrame, q: float) -> DataFrame:
    """Smallest length whose rank reaches ``q``; no row for an empty table."""
    return found.where(F.col("rank_to") >= q).agg(F.min("length").alias("length")).where("length is not null")


def truncated_total(found: DataFrame, limit: int) -> DataFrame:
    """Tokens that stay when every text is cut at any limit, also one between two lengths."""
    longer = F.min(F.when(F.col("length") >= limit, F.struct("length", "truncated", "docs_from"))).alias("c")
    return found.agg(longer, F.max("total_tokens").alias("total")).select(
        F.coalesce(F.col("c.truncated") - (F.col("c.length") - limit) * F.col("c.docs_from"), "total", F.lit(0)).alias("tokens"))
