"""Language of a text, word first: known words by their log frequency, unknown ones by ever shorter n-grams.

The model holds, per language, smoothed log frequencies of words and of the character n-grams of words
(begin and end marked). A word of the model scores by itself; any other word scores by the mean of its
longest n-grams that the model knows. A text's language is the one with the largest sum over its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from canopy.llm.batches import add_columns, bound_batches, texts
from canopy.llm.bpe import LETTERS, PLAIN
from canopy.operators.ranking import ranked
from canopy.session import cut_lineage

WORD = re.compile(r"[^\W\d_]+").findall
PLAIN_WORD = re.compile(f"[{LETTERS}]+").findall      # the same for the plain characters
LONGEST = 4           # characters of the longest n-gram
FLUSH = 30_000        # distinct words a task counts before it hands them and their n-grams on
CELLS = 1 << 24       # scores of a model, about: rows times languages, 128 MB
REMEMBERED = 150_000  # scores of unknown words a task keeps

UNKNOWN = "und"


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if the text is null or has no letter."""
    if not text:
        return []
    text = text.lower()
    if not PLAIN.search(text):
        return PLAIN_WORD(text)
    found = WORD(text)
    # Numerals such as a superscript two are word characters but no letters.
    return found if any(any(map(str.isalpha, w)) for w in found) else []


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]           # row of `scores`
    grams: list[dict[str, int]]     # by length, from the longest
    scores: np.ndarray              # log frequency by row and language


def sampled(labelled: DataFrame, lang: str, key: str, per_language: int, most_languages: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of the key; all where there are fewer."""
    counts = labelled.groupBy(lang).count().limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not counts:
        return labelled
    share = F.create_map(*[x for r in counts for x in (F.lit(r[lang]), F.lit(min(1.0, per_language / r["count"])))])
    draw = F.pmod(F.xxhash64(F.col(key), F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(draw < share[F.col(lang)])


def counted(df: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, n, gram, count) over whole texts; n is 0 for words. A task hands on partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            rows = {}
            for (language, word), c in seen.items():
                for n in range(LONGEST + 1):
                    for g in grams(word, n) if n else [word]:
                        rows[language, n, g] = rows.get((language, n, g), 0) + c
            seen.clear()
            keys = list(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.string()), pa.array(list(rows.values()), pa.int64())],
                names=["lang", "n", "gram", "count"])

        for batch in batches:
            for language, t in zip(texts(batch, lang), texts(batch, text)):
                seen.update((language, w) for w in words(t))
            if len(seen) > FLUSH:
                yield from flush()
        yield from flush()

    bound_batches(df.sparkSession)
    return (df.select(lang, text).mapInArrow(run, "lang string, n int, gram string, count bigint")
            .groupBy("lang", "n", "gram").agg(F.sum("count").alias("count")))


def most_frequent(df: DataFrame, groups: list[str], count: str, most: int) -> DataFrame:
    """(n, gram): the ``most`` rows of the largest count in each group, ties in code point order; no task sees a whole group."""
    placed = ranked(df.select(*groups, "gram", count), [*groups, F.desc(count), "gram"], "at")
    starts = placed.groupBy(*groups).agg(F.min("at").alias("start"))       # a row per length and language
    return placed.join(F.broadcast(starts), groups).where(F.col("at") - F.col("start") < most).select("n", "gram")


def fit(df: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = 10_000, entries: int = 40_000, most_languages: int = 1000) -> Model:
    """Learn from the rows where ``learn`` is true and neither text nor language is null.

    The sample is bounded by ``per_language`` rows a language, the model by ``entries`` words and as many
    n-grams of each length (the most frequent, ties in code point order), and as many again dealt evenly to
    the languages (the most frequent of each, so a small one keeps its own). Beyond CELLS scores there are
    fewer entries, so the model fits a broadcast at any size of the corpus and number of languages; more than
    ``most_languages`` are an error. Rows that repeat are counted as often as they are there. No labelled
    row: a model without languages, which calls everything ``und``.
    """
    labelled = df.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = cut_lineage(counted(sampled(labelled, "lang", "key", per_language, most_languages), "lang", "text"))
    by_gram = counts.groupBy("n", "gram").agg(
        F.sum("count").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "count"))).alias("by"))
    languages = max(counts.select("lang").distinct().count(), 1)
    entries = max(min(entries, CELLS // (2 * (LONGEST + 1) * languages)), 1)
    wanted = (most_frequent(by_gram, ["n"], "total", entries)
              .union(most_frequent(counts, ["n", "lang"], "count", max(entries // languages, 1))).distinct())
    kept = by_gram.join(wanted, ["n", "gram"], "left_semi").orderBy("n", "gram")
    rows = kept.select("n", "gram", "by").collect()
    languages = sorted({x for r in rows for x in r["by"]})
    table = np.zeros((len(rows), len(languages)))
    at = {x: i for i, x in enumerate(languages)}
    found: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    kinds = np.zeros(len(rows), np.int64)
    for i, r in enumerate(rows):
        found[r["n"]][r["gram"]] = i
        kinds[i] = r["n"]
        for x, c in r["by"].items():
            table[i, at[x]] = c
    for n in range(LONGEST + 1):
        own = table[kinds == n]
        if len(own):
            table[kinds == n] = np.log(own + 0.5) - np.log(own.sum(0) + 0.5 * len(own))
    return Model(languages, found[0], found[:0:-1], table)


class Rows(dict):
    """Row of every word met: those of the model, then words scored by their n-grams, as long as there is room."""

    def __init__(self, model: Model):
        super().__init__(model.words)
        self.model, self.next = model, len(model.scores)
        room = max(min(REMEMBERED, CELLS // max(len(model.languages), 1)), 1)
        self.full = self.next + room
        self.table = np.concatenate([model.scores, np.zeros((room, len(model.languages)))])

    def __missing__(self, word: str) -> int:
        if self.next == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        row = self[word] = self.next
        self.table[row] = backoff(self.model, word)
        self.next += 1
        return row


def backoff(model: Model, word: str) -> np.ndarray | float:
    """Mean score of the longest n-grams of the word that the model knows; 0 if it knows none."""
    for n, rows in zip(range(LONGEST, 0, -1), model.grams):
        known = [rows[g] for g in grams(word, n) if g in rows]
        if known:
            return model.scores.take(known, axis=0).mean(0)
    return 0.0


class Scorer:
    def __init__(self, model: Model):
        self.model, self.rows = model, Rows(model)

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = words(text)
        if not found or not self.model.languages:
            return UNKNOWN, 0.0
        if self.rows.next >= self.rows.full:     # begin anew
            self.rows = Rows(self.model)
        at = list(map(self.rows.__getitem__, found))
        total = self.rows.table.take(at, axis=0).sum(0)
        best = int(np.argmax(total))
        return self.model.languages[best], 1 / math.fsum(np.exp(total - total[best]))


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Append the language of every whole text and its posterior (0 to 1) over the learned languages.

    ``und`` with score 0: the text is null, empty or without a letter, or nothing was learned. A tie goes to
    the language first in code point order. Other columns stay; same-named ones are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)   # bounded by the model's entries

    def start():
        scorer = Scorer(shared.value)

        def columns(batch):
            made = [scorer(t) for t in texts(batch, text)]
            return [[m[0] for m in made], [m[1] for m in made]]

        return columns

    return add_columns(df, f"{lang} string, {score} double", start)
