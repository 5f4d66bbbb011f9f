"""The registered queries over whole small tables: SQL where there is one, brute force for the others and the pipeline."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import pytest
import tiktoken
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from canopy.llm import bpe, langid, mixing, simhash
from canopy.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert not differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_for_each_of_the_table(spark, name):
    table = {"op5_url_filter": "pages"}.get(name, "documents")
    got = QUERIES[name](spark, FOLDER)
    if name == "op10_token_lengths":
        assert got.agg({"docs": "sum"}).first()[0] == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    else:
        assert got.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()]


def test_registered_simhash(spark):
    from test_texts import brute_groups
    got = QUERIES["op2_simhash_near_dedup"](spark, FOLDER).collect()
    want = [(i, f"{m:016x}", c) for i, m, c in brute_groups(documents(spark), 3, 2)]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(want)


def test_registered_tokens(spark):
    path = corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=corpus_pipeline.public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(bpe.read_vocabulary(path)))
    ids = {i: library.encode_ordinary(t or "") for i, t, _ in documents(spark)}
    texts = {i: (t or "").encode() for i, t, _ in documents(spark)}
    got = QUERIES["op6_byte_bpe"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == {
        i: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(texts[i]).hexdigest()) for i, x in ids.items()}
    counts = sorted(map(len, ids.values()))
    found = QUERIES["op10_token_lengths"](spark, FOLDER).collect()
    assert {r.length: r.docs for r in found} == Counter(counts)
    assert all((r.truncated, r.docs_from) == (sum(min(x, r.length) for x in counts), sum(x >= r.length for x in counts)) for r in found)


def test_registered_fingerprints(spark):
    from test_texts import brute_phrases
    order = sorted(documents(spark), reverse=True, key=lambda r: r[0])
    got = {r.doc_id: r for r in QUERIES["op7_lz_fingerprint"](spark, FOLDER).collect()}
    assert len(got) == len(order)
    for (i, t, _), (_, n, _) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        new = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        a, b, c = map(brute_phrases, (t, new, n))
        for near, other in ((got[i].near_edited, b), (got[i].near_next, c)):
            assert abs(near - (len(a & other) / len(a | other) if a | other else 1.0)) < 0.25


def plain_words(text):
    return [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if any(map(str.isalpha, text))]


def plain_grams(word, n):
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n else [word]


def test_registered_languages_are_those_of_a_plain_model(spark):
    """Counts, frequencies and scores once more, with dictionaries over the whole table."""
    rows = documents(spark)
    seen = {}
    for i, t, lang in rows:
        if lang is not None and t is not None and zlib.crc32(str(i).encode()) % 5:
            for w in plain_words(t):
                for n in range(5):
                    for g in plain_grams(w, n):
                        seen.setdefault(n, {}).setdefault(g, Counter())[lang] += 1
    languages = sorted({x for of in seen.values() for by in of.values() for x in by})
    assert max(map(len, seen.values())) <= 40_000        # nothing is beyond the model's size
    score = {}
    for n, of in seen.items():
        total = {x: sum(by[x] for by in of.values()) for x in languages}
        score[n] = {g: [math.log((by[x] + 0.5) / (total[x] + 0.5 * len(of))) for x in languages] for g, by in of.items()}

    def said(word):
        if word in score[0]:
            return score[0][word]
        for n in (4, 3, 2, 1):
            known = [score[n][g] for g in plain_grams(word, n) if g in score[n]]
            if known:
                return [sum(c) / len(known) for c in zip(*known)]
        return [0.0] * len(languages)

    got = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        found = plain_words(t)
        if not found:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        sums = [math.fsum(c) for c in zip(*map(said, found))]
        best = max(sums)
        assert math.isclose(got[i].score, 1 / sum(math.exp(s - best) for s in sums), rel_tol=1e-6)
        assert best - sums[languages.index(got[i].lang_pred)] < 1e-6


def test_language_of_held_out_documents(spark):
    got = QUERIES["op3_language_id"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id")
    held = [r for r in got.collect() if r.held_out and r.lang is not None]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95


def test_language_stage_keeps_every_text_with_letters(spark):
    # A word as frequent in three languages as in each other has a posterior of 1/3; zq is unknown to all.
    rows = [(i, "taxi own" + "abc"[i % 3] * 4, "abc"[i % 3], "s", 9) for i in range(60)]
    rows += [(100, "taxi", "a", "s", 4), (101, "zq", "b", "s", 2), (102, "123 ...", "a", "s", 7), (103, None, "a", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id for r in corpus_pipeline.languages(spark, docs, FOLDER).collect()} == {*range(60), 100, 101}


def test_language_stage_without_labels_keeps_all(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(i, "the river", None, "s", 9) for i in range(9)] + [(9, None, None, "s", None)], schema)
    assert corpus_pipeline.languages(spark, docs, FOLDER).count() == 10
    assert corpus_pipeline.languages(spark, docs.where("false"), FOLDER).count() == 0


def test_language_stage_leaves_columns_of_any_name(spark):
    own = ("_lang", "_score", "told", "told_score", "TOLD_")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mine = docs.withColumns({c: F.lit(f"my {c}") for c in own})
    got = corpus_pipeline.languages(spark, mine, FOLDER)
    assert got.columns == mine.columns and all(r[c] == f"my {c}" for r in got.select(*own).collect() for c in own)
    assert got.count() == corpus_pipeline.languages(spark, docs, FOLDER).count()


def test_stage_folders_go_but_the_last(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    corpus_pipeline.run(spark, FOLDER).count()
    left = [x for x in set(os.listdir(folder)) - before if x.startswith("stage-")]
    assert [x.split("-")[1] for x in left] == ["3"]


def test_the_stage_of_near_copies_broadcasts_no_keys(spark, monkeypatch):
    kept = {}
    found = simhash.components
    monkeypatch.setattr(simhash, "components", lambda links, *a: kept.setdefault("links", links) and found(links, *a))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(50)
    assert corpus_pipeline.near_copies(spark, docs, FOLDER).count()
    assert "Broadcast" not in kept["links"]._jdf.queryExecution().executedPlan().toString()


def test_pipeline_stage_by_stage(spark):
    from test_texts import brute_groups, brute_removed
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    columns = docs.columns

    def rows(df):
        return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]

    told = corpus_pipeline.languages(spark, docs, FOLDER).cache()
    clean = [r.doc_id for r in docs.collect() if langid.words(r.text)]
    assert told.columns == columns and len(clean) - told.count() <= 0.01 * len(clean)
    one = corpus_pipeline.near_copies(spark, told, FOLDER).cache()
    assert one.columns == columns
    assert sorted(r[0] for r in rows(one)) == sorted(i for i, _, c in brute_groups(rows(told), 3, 2) if i == c)
    cut = corpus_pipeline.passages(spark, one, FOLDER).cache()
    want = {i: t for i, _, _, t in brute_removed(rows(one), 50)}
    assert cut.columns == columns
    assert {i: " ".join((t or "").split()) for i, t, *_ in rows(cut)} == {i: " ".join(t.split()) for i, t in want.items()}
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = corpus_pipeline.mixture(spark, cut, FOLDER).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    got = {}
    for i, *_ in rows(mixed):
        got[i] = got.get(i, 0) + 1
    assert mixed.columns == columns and got == {i: n for i, n in copies.items() if n}
    last = corpus_pipeline.tokens(spark, mixed, FOLDER).collect()
    back = bpe.decoder(bpe.read_vocabulary(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCABULARY)))
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert len(last) == mixed.count()
    assert all(back(r.ids).decode() == (texts[r.doc_id] or "") for r in last)
    assert corpus_pipeline.run(spark, FOLDER).count() == len(last)
