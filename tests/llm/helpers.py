"""Small documents with every awkward case, for the brute-force comparisons."""

import random

WORDS = "the of and to in is was for with that shore night river stone glass paper window letter music garden".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


def awkward(seed=3):
    """(doc_id, text, lang, source) with nulls in every column, empty and long texts, copies and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (3, 20, 49, 50, 51, 120, 400, 1500)]
    passage = prose(rng, 70)
    rows = [(i, t, rng.choice(["en", "de"]), f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20 + i, f"{prose(rng, 30)} {passage}\n\n{prose(rng, 30)}", "en", "s1") for i in range(4)]
    rows += [(40 + i, base[6], "de", "s2") for i in range(5)]                               # exact copies
    rows += [(50, base[7].replace("river", "lake", 1), "en", None)]                         # a near copy
    rows += [(60, None, "en", "s0"), (61, "", "de", "s0"), (62, " \t\n", None, "s1"), (63, "123 ... 456", "en", "s2")]
    rows += [(70, "éß 漢字かな　🙂 " * 40, None, "s1"), (71, "x" * 5000, "en", "s1"), (72, "tail  \\ </s> [INST]", "de", "s1")]
    rows += [(80, passage, "en", "s1"), (80, passage, "en", "s1")]                          # a repeated row
    rows += [(None, passage, "de", "s2"), (None, None, None, None)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string"


def frame(spark, rows=None):
    """With extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    return df.selectExpr("*", "'k' as key", "1 as chunk", "2 as f", "'r' as rest", "3 as size", "4 as tie", "true as own", "5 as n_chars")


def listed(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
