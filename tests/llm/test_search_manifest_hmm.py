"""Ranked search, Merkle manifest and hidden Markov scoring against plain versions, with every awkward row."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect
from helpers import awkward, frame
from pyspark.sql import functions as F

from canopy.llm import hmm, manifest, search
from canopy.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


# --- ranked search ----------------------------------------------------------------------------

def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def brute_ranked(queries, docs, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    n, length = len(counts), sum(x for *_, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in queries:
        scored = []
        for i, c, x in counts:
            m = 100 - 50 + (50 * x * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((s, i))
        scored.sort(key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


QUESTIONS = [(1, "River stone; NIGHT-glass 漢字かな"), (2, None), (3, ""), (4, "nosuchword"), (5, "the the of river windowing"),
             (5, "music"), (None, "garden x 🙂"), (7, " ".join(["paper"] * 50) + " shore éß"), (8, "of and to in is was for with that the")]


def ranked_rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def asked(spark, questions=QUESTIONS):
    return spark.createDataFrame(questions, "item_id bigint, text string").selectExpr("*", "1 as q", "2 as rank", "3 as score")


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_is_the_plain_ranking(spark, k):
    rows = awkward() + [(1000 + i, random.Random(i).choice(["river glass", "night river stone", "paper"]), "en", "s") for i in range(60)]
    got = search.search(asked(spark), frame(spark, rows).repartition(3), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_rows(got) == brute_ranked(QUESTIONS, [r[:2] for r in rows], k)


def test_search_in_blocks_of_queries(spark, monkeypatch):
    rows = [(i, t, "en", "s") for i, (_, t, *_r) in enumerate(awkward(5) * 6)]
    monkeypatch.setattr(search, "QUERY_BYTES", 40)
    got = search.search(asked(spark), frame(spark, rows).coalesce(1), 4)
    assert ranked_rows(got) == brute_ranked(QUESTIONS, [r[:2] for r in rows], 4)


def test_stopped_accumulators_lose_nothing():
    """Random shards: the best of a shard are the best of all its documents, whatever is known to be reached."""
    import pyarrow as pa
    rng = np.random.default_rng(4)
    for _ in range(60):
        size, vocabulary = int(rng.integers(1, 60)), 12
        counts = rng.poisson(rng.choice([0.2, 1.0, 3.0], vocabulary), (size, vocabulary))
        rows = [{"key": int(i), "n": int(c.sum()), "terms": np.flatnonzero(c).tolist(), "counts": c[c > 0].tolist()} for i, c in enumerate(counts)]
        batch = pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]))
        weights = rng.integers(0, 5000, vocabulary)
        length = max(int(counts.sum()), 1)
        shard = search.Shard([batch], weights, size, length)
        wanted = sorted(rng.choice(vocabulary, int(rng.integers(1, 8)), replace=False).tolist(), key=lambda t: int((counts[:, t] > 0).sum()))
        m = 50 + 50 * counts.sum(1) * size // length
        score = sum(weights[t] * (10**9 * counts[:, t] // (1000 * counts[:, t] + 20 * m)) for t in wanted)
        k = int(rng.integers(1, 8))
        best = sorted((-int(s), i) for i, s in enumerate(score) if s > 0)[:k]
        reached = int(rng.choice([0, -best[-1][0] if len(best) == k else 0]))
        at, got = shard.best(wanted, k, reached)
        assert sorted((-int(s), int(i)) for i, s in zip(at, got)) == best


def test_search_of_nothing(spark):
    docs, none = frame(spark), frame(spark, [])
    assert search.search(asked(spark, []), docs).count() == 0
    assert search.search(asked(spark), none).count() == 0
    assert search.search(asked(spark), frame(spark, [(1, None, None, None), (2, " .,", "en", "s")])).count() == 0


def test_terms_of_long_texts_are_read_one_by_one(monkeypatch):
    text = "River stone, river éß " * 50
    want = search.term_counts(text.encode(), {b"river": 1, b"stone": 2}.get)
    monkeypatch.setattr(search, "LONG_TEXT", 10)
    assert search.term_counts(text.encode(), {b"river": 1, b"stone": 2}.get) == want == (200, Counter({1: 100, 2: 50}))


# --- manifest ---------------------------------------------------------------------------------

FIELDS = ["doc_id", "source", "lang", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(levels, at, node):
    """(siblings, last copy) of a node, level by level."""
    seen = []
    for level in levels[:-1]:
        first = at // 16 * 16
        run = list(level[first:first + 16])
        seen += [h for i, h in enumerate(run) if i != at - first]
        run[at - first] = node
        node, at = sha("".join(run)), at // 16
    return seen, node


def brute_manifest(rows, changed):
    groups = {}
    for i, text, lang, source in rows:
        old = sha("".join(map(told, (i, source, lang, text))))
        new = sha("".join(map(told, (i, source, lang, None if text is None else lowered(text)))))
        groups.setdefault(source, []).append(((i is not None, i or 0, old), i, old, new))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([old for _, _, old, _ in sorted(groups[s], key=lambda g: g[0])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for n, s in enumerate(names):
        for at, (_, i, old, new) in enumerate(sorted(groups[s], key=lambda g: g[0])):
            inner, node = climb(trees[s], at, new if changed(i) else old)
            outer, node = climb(top, n, node)
            out.append((i, old, trees[s][-1][0], top[-1][0], sha("".join(inner + outer)), node))
    return sorted(out, key=repr)


def manifest_rows(df, levels=manifest.LEVELS):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    change = [F.col("doc_id"), F.col("source"), F.col("lang"), F.translate("text", letters, letters.lower())]
    out = manifest.manifest(df, FIELDS, F.col("doc_id") % 3 == 0, change, levels=levels)
    got = out.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("proof")), 256).alias("p"), "folded_root").collect()
    return sorted(map(tuple, got), key=repr)


def third(i):
    return i is not None and i % 3 == 0


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_is_the_plain_tree(spark, levels):
    """Groups of one row, of whole and broken runs, of several layers of blocks."""
    rng = random.Random(8)
    rows = awkward() + [(rng.randrange(5000), f"Text {rng.randrange(9)}", None, "hot") for _ in range(530)]
    rows += [(i, "B", "en", "sixteen") for i in range(16)] + [(i, "C", "en", "seventeen") for i in range(17)] + [(9, "D", "en", "é")]
    assert manifest_rows(frame(spark, rows), levels) == brute_manifest(rows, third)


def test_manifest_of_many_groups(spark):
    rows = [(i, "T", "en", f"g{i // 2:03}") for i in range(600)]
    assert manifest_rows(frame(spark, rows)) == brute_manifest(rows, third)


def test_manifest_of_little(spark):
    one = [(3, "Lone", None, None)]
    assert manifest_rows(frame(spark, one)) == brute_manifest(one, third)
    assert manifest_rows(frame(spark, [])) == []


def test_a_proof_folds_to_the_root(spark):
    letters = "ABC"
    out = manifest.manifest(frame(spark), FIELDS, F.lit(None).cast("boolean"), [F.col("doc_id"), F.col("source"), F.col("lang"), F.translate("text", letters, "abc")])
    for r in out.collect():
        assert r.new_leaf is None and manifest.fold(r.leaf, [(p.left, p.right) for p in r.proof]) == r.root == r.folded_root


# --- hidden Markov model ----------------------------------------------------------------------

def plain_forward(emissions, first, moves):
    """log10 probability of one sequence in plain arithmetic with logarithms."""
    a = np.log(first) + np.log(emissions[0])
    for e in emissions[1:]:
        a = np.logaddexp.reduce(a[:, None] + np.log(moves), axis=0) + np.log(e)
    return np.logaddexp.reduce(a) / math.log(10)


def plain_counts(sequences, table, first, moves):
    """Baum-Welch counts, one sequence at a time."""
    seen, starts, pairs = np.zeros(table.shape), np.zeros(len(first)), np.zeros(moves.shape)
    for ids in sequences:
        e = table[ids]
        a, b = np.zeros(e.shape), np.ones(e.shape)
        a[0] = first * e[0]
        for t in range(1, len(ids)):
            a[t] = a[t - 1] @ moves * e[t]
        for t in range(len(ids) - 2, -1, -1):
            b[t] = moves @ (e[t + 1] * b[t + 1])
        p = a[-1].sum()
        np.add.at(seen, ids, a * b / p)
        starts += a[0] * b[0] / p
        for t in range(1, len(ids)):
            pairs += np.outer(a[t - 1], e[t] * b[t]) * moves / p
    return seen, starts, pairs


@pytest.mark.parametrize("block", [7, 40, 10**6])
def test_recursions_are_the_plain_ones(monkeypatch, block):
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", block)
    rng = np.random.default_rng(2)
    lengths = np.array([1, 30, 1, 7, 55, 30, 2])
    ids = rng.integers(0, 9, lengths.sum()).astype(np.int32)
    table, first, moves = rng.random((9, 3)), rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3)
    sequences = np.split(ids, np.cumsum(lengths)[:-1])
    got = hmm.expected(ids, lengths, table, first, moves)
    for x, y in zip(got, plain_counts(sequences, table, first, moves)):
        assert np.allclose(x, y, atol=1e-9)
    want = [plain_forward(table[s], first, moves) for s in sequences]
    assert np.allclose(hmm.log_likelihoods(ids, lengths, table, first, moves), want, atol=1e-9)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text)) + [""]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def learn():
    return ~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def brute_base(rows):
    c = Counter(w for i, t, *_ in rows if not held(i) for w in words(t))
    n, v = c.total(), len(c)
    return sorted(((i, len(words(t)), sum(w in c for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6))
                   for i, t, *_ in rows), key=repr)


def brute_scores(rows, model):
    """Scores of the texts under the model's own tables, one text at a time."""
    own = {r["name"]: r for r in model.words.collect()}
    k = len(model.first)

    def emissions(text):
        out = []
        for w in words(text):
            r = own.get(hmm.names([w.encode()])[0])
            c, g = (r["c"], np.array([r[f"g{s}"] for s in range(k)])) if r else (0, np.zeros(k))
            share = model.totals / (model.totals + hmm.UNIT * model.distinct)
            out.append(share * g / np.maximum(model.totals, 1) + (1 - share) * (c + 1) / (model.tokens + model.distinct + 1))
        return np.array(out)

    return sorted(((i, round(plain_forward(emissions(t), model.first, model.moves), 6)) for i, t, *_ in rows), key=repr)


def test_scores_are_those_of_the_plain_recursion(spark):
    rows = awkward() + [(500, "w" * 50 + " " + "W" * 50 + " " + "v" * 41, "en", "s")]
    shards = hmm.prepare(frame(spark, rows).repartition(3), learn())
    model = hmm.fit(shards, states=3, tied_rounds=2)
    got = hmm.score(shards, model)
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    out = got.collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=repr) == brute_base(rows)
    for (i, x), (j, y) in zip(sorted(((r.doc_id, r.score) for r in out), key=repr), brute_scores(rows, model)):
        assert i == j and x == pytest.approx(y, abs=1e-4)
    assert model.totals.sum() / hmm.UNIT == pytest.approx(model.tokens, rel=1e-3)


def test_a_round_counts_what_the_plain_version_counts(spark):
    rows = awkward()
    learnt = [[w.encode() for w in words(t)] for i, t, *_ in rows if not held(i)]
    now = hmm.begin(3)
    numbers = {w: n for n, w in enumerate(sorted({w for s in learnt for w in s}))}
    table = now.ratio[hmm.classes(hmm.names(list(numbers)))]
    # Plain numbers run out on long texts: compare on the short ones.
    short = [i for i, (_, t, *_r) in enumerate(rows) if len(words(t)) < 200]
    shards = hmm.prepare(frame(spark, [rows[i] for i in short]).repartition(4), learn())
    sequences = [np.array([numbers[w.encode()] for w in words(rows[i][1])]) for i in short if not held(rows[i][0])]
    seen, starts, pairs = plain_counts(sequences, table, now.first, now.moves)
    got = hmm.counted(shards, now, True).collect()
    for r in got:
        g = np.array([r[f"g{s}"] for s in range(3)]) / hmm.UNIT
        want = {hmm.MOVE: lambda: pairs[r["name"][0]], hmm.FIRST: lambda: starts,
                hmm.WORD: lambda: seen[next(n for w, n in numbers.items() if hmm.names([w])[0] == bytes(r["name"]))]}[r["kind"]]()
        assert np.allclose(g, want, atol=0.01)


def test_training_makes_held_out_texts_likelier(spark):
    """Two vocabularies side by side: the states find them."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(40)}" for _ in range(60)), None, None) for i in range(300)]
    shards = hmm.prepare(frame(spark, rows).repartition(4), learn())
    out = {n: hmm.score(shards, hmm.fit(shards, states=4, tied_rounds=n)).where(F.col("doc_id").isin([i for i, *_ in rows if held(i)]))
           .agg(F.sum("score"), F.sum("base_score")).first() for n in (0, 4)}
    assert out[4][0] > out[0][0] and out[4][0] > out[4][1] * 0.9


def test_the_order_of_the_shards_does_not_count(spark):
    a, b = (sorted(((r.doc_id, r.score) for r in hmm.score(s, hmm.fit(s, tied_rounds=1)).collect()), key=repr)
            for s in (hmm.prepare(frame(spark).repartition(n), learn()) for n in (1, 5)))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([x for _, x in a], [x for _, x in b], atol=0.05)


def test_scoring_of_nothing(spark):
    none = hmm.prepare(frame(spark, []), learn())
    assert hmm.score(none, hmm.fit(none, tied_rounds=1)).count() == 0
    some = hmm.prepare(frame(spark), F.lit(None).cast("boolean"))
    out = hmm.score(some, hmm.fit(some, tied_rounds=1)).collect()
    assert len(out) == len(awkward()) and all((round(r.score, 9), r.base_score, r.n_known, r.train_tokens) == (0.0, 0.0, 0, 0) for r in out)


def test_registered_scoring(spark):
    rows = connect(FOLDER).execute("select doc_id, text from documents").fetchall()
    out = QUERIES["op13_hmm_scoring"](spark, FOLDER).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=repr) == brute_base(rows)
    assert all(r.held_out == held(r.doc_id) for r in out)
    late = [r for r in out if r.held_out]
    assert sum(r.score for r in late) > sum(r.base_score for r in late)
