"""URL filters: rules on host and path, and a logistic regression for the URLs that no rule fits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from canopy.llm.batches import quoted

GRAMS = (3, 4)            # characters
FEATURES = 1 << 14
MOST_RULES = 1000
ALLOW, BLOCK = "allow", "block"


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str        # host and path, such as example.org/es/

    def fits(self) -> Column:
        own, slash, rest = self.rule.partition("/")
        name = F.col("host")
        return ((name == own) | name.endswith("." + own)) & F.col("path").startswith(slash + rest)


def judged(df: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Append host, path, the longest rule that fits (null: none) and its ``rule_verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. Of rules of equal length the
    first in code point order wins. At most MOST_RULES rules; same-named columns are replaced.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    order = sorted(rules, key=lambda r: (-len(r.rule), r.rule))
    first = F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(), F.lit(r.rule)) for r in order])
    verdict = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col("rule") == r.rule, F.lit(r.verdict)) for r in order])
    return (df.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
            .withColumn("rule", first).withColumn("rule_verdict", verdict))


def grams() -> Column:
    """Character n-grams of host and path, each marked by where it is from; begin and end count as characters."""
    def of(mark: str, name: str, n: int) -> Column:
        told = F.concat(F.lit("^"), F.col(name), F.lit("$"))
        starts = F.when(F.length(told) >= n, F.sequence(F.lit(1), F.length(told) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(told, i, F.lit(n))))

    return F.concat(*[of(mark, name, n) for mark, name in (("h", "host"), ("p", "path")) for n in GRAMS])


def featured(df: DataFrame) -> DataFrame:
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features")
    return hashing.transform(df.withColumn("_grams", grams()))


def fit(labelled: DataFrame, rows: int = 4000, iterations: int = 40, strength: float = 0.001):
    """Logistic regression from a frame (host, path, verdict); null verdicts are left out.

    It learns from at most ``rows`` different URLs, the first by a hash of them, in one partition, so a rerun
    learns the same. Returns a function that appends ``learned``, allow or block. Without labelled rows it
    allows all; with one verdict only it gives that.
    """
    # The hash order takes the same rows wherever they lie; `rows` bounds what meets in one task.
    some = (labelled.where("verdict is not null").select("host", "path", "verdict").distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(rows).coalesce(1).cache())
    kinds = [r[0] for r in some.select("verdict").distinct().collect()]
    if len(kinds) < 2:
        some.unpersist()
        only = kinds[0] if kinds else ALLOW
        return lambda df: df.withColumn("learned", F.lit(only))
    table = featured(some).withColumn("label", (F.col("verdict") == BLOCK).cast("double"))
    model = LogisticRegression(featuresCol="_features", labelCol="label", maxIter=iterations, regParam=strength,
                               predictionCol="_prediction", rawPredictionCol="_raw", probabilityCol="_probability").fit(table)
    some.unpersist()

    def apply(df: DataFrame) -> DataFrame:
        got = model.transform(featured(df))
        verdict = F.when(vector_to_array("_probability")[1] >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
        return got.withColumn("learned", verdict).drop("_grams", "_features", "_raw", "_probability", "_prediction")

    return apply


def filtered(df: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, url: str = "url", rows: int = 4000) -> DataFrame:
    """Append host, path, rule and verdict to every row; the rule's verdict, else the learned one.

    ``labelled`` (url, verdict) is the table to learn from; without one, the rows that a rule fits. A null
    URL or one without ``://`` has empty host and path and is judged by them; a URL of any length is read
    whole. Other columns stay, whatever their names; same-named ones are replaced. Equal URLs are judged
    alike. An empty table gives no rows.
    """
    made = ("host", "path", "rule", "verdict")
    others = [quoted(c) for c in df.columns if c.lower() not in made]
    told = judged(df.select(F.col(url).alias("url"), F.struct(*others).alias("row")), rules)
    if labelled is None:
        examples = told.select("host", "path", F.col("rule_verdict").alias("verdict"))
    else:
        examples = labelled.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "verdict")
    found = fit(examples, rows)(told).withColumn("verdict", F.coalesce("rule_verdict", "learned"))
    return found.select("row.*", *made)
