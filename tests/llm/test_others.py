"""Chat, URLs, vectors, components, and the registered queries."""

import hashlib
import json
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from canopy.llm import chat, components, urls, vectors


def test_components(spark, monkeypatch):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(3, 3), (None, 4), (9, 8), (8, 9)]
    links += [(rng.randint(300, 380), rng.randint(300, 380)) for _ in range(60)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    near = {}
    for a, b in links:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for x in sorted(near):
        stack = [x] if x not in want else []
        while stack:
            y = stack.pop()
            if y not in want:
                want[y] = x
                stack += near[y]
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def brute_vectors(rows, cosine):
    good = {i: np.array(v, float) for i, (_, v) in enumerate(rows)
            if v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    near = {i: [] for i in range(len(rows))}
    for i, a in good.items():
        for j, b in good.items():
            if i != j and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                near[i].append(j)
    out = []
    for i in range(len(rows)):
        seen, stack = set(), [i]
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += near[x]
        keys = [rows[x][0] for x in seen if rows[x][0] is not None]
        out.append((rows[i][0], len(near[i]), min(keys, default=None), bool(keys) and rows[i][0] == min(keys)))
    return sorted(out, key=repr)


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        rows += [(len(rows) + i, (centre + 0.15 * rng.standard_normal(16)).tolist()) for i in range(rng.integers(1, 9))]
    copy = rows[0][1]
    rows += [(500, copy), (501, copy), (501, copy), (502, [2 * x for x in copy]), (503, [-x for x in copy]), (None, copy)]
    rows += [(510, None), (511, []), (512, [0.0] * 16), (513, [float("nan")] + [1.0] * 15), (514, [None] + [1.0] * 15),
             (515, [float("inf")] + [1.0] * 15), (None, None), (516, [1.0, 2.0]), (517, [1.0, 2.0]), (518, [3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("node", F.lit("mine"))
    got = vectors.near_duplicates(df)
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr) == brute_vectors(rows, 0.9)
    assert vectors.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("size", [1e-310, 1e-200, 1e200, 1e307])
def test_vectors_of_any_magnitude(spark, size):
    """Norms that would overflow or vanish: as many links as at an ordinary size."""
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(8) / 4
    rows = [(i, (centre + (0.05 if i < 6 else 0.4) * rng.standard_normal(8)).tolist()) for i in range(12)]
    want = brute_vectors(rows, 0.9)
    df = spark.createDataFrame([(i, [x * size for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, vectors.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr) == want
    assert any(n for _, n, *_ in want) and any(not n for _, n, *_ in want)


def test_vectors_of_very_many_lengths(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LENGTHS", 7)
    rows = [(2 * d + i, [1.0] * d) for d in range(1, 19) for i in (0, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert all(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in vectors.near_duplicates(df).collect())


@pytest.mark.parametrize("n", [500, 60_000, 10_000_000])
def test_recall_at_the_threshold(n):
    hashing = vectors.plan(n, 64, 0.9)
    rng = np.random.default_rng(9)
    a, b = rng.standard_normal((2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = (hashing.buckets(a)[:, :, :, None] == hashing.buckets(b)[:, :, None, :]).any((1, 2, 3))
    assert met.mean() > 0.99


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).standard_normal((5, 32))
    assert np.allclose(np.linalg.norm(vectors.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(vectors.hadamard(vectors.hadamard(x)), x)


NASTY = ["", "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "a\\", "</s>", "\\</s> \n[/MSG]\n", "[ROLE] x [/ROLE][MSG] y [/MSG]\n", None, "$1 \\1"]


def test_chat_round_trip(spark):
    rows = [(c, t, random.Random(c * 10 + t).choice(["user", "assistant", "system", "tool", "[INST]", None]), x)
            for c in range(8) for t, x in enumerate(random.Random(c).sample(NASTY, 6))]
    rows += [(8, 0, "assistant", "long " * 50_000), (8, 0, "assistant", "a tie"), (8, 0, "assistant", "a tie"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.digests(chat.formatted(df), "conv_id", ["turn"]).collect()
    assert len(got) == 10
    for r in got:
        own = sorted(((t, o, x) for c, t, o, x in rows if c == r.conv_id), key=lambda y: (y[0] or 0,))
        if r.conv_id == 8:
            own.sort(key=lambda y: y[2])
        turns = "".join(f"{o or ''}\n{x or ''}\n" for _, o, x in own)
        loss = "".join(x or "" for _, o, x in own if o == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    whole = "".join(r.formatted for r in chat.formatted(df).where("conv_id = 3").orderBy("turn").collect())
    assert chat.parse(whole) == [(o or "", x or "") for c, _, o, x in rows if c == 3]
    assert chat.digests(chat.formatted(df.where("false")), "conv_id", ["turn"]).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text("\\</s>[INST]RO ", max_size=30))
def test_escapes_are_reversible(text):
    import re
    escaped = re.sub(rf"(\\*{chat.CONTROL})", r"\\\1", text)
    assert chat.unescape(escaped) == text
    assert chat.parse(f"[INST] {escaped} [/INST]\n") == [("user", text)]


def test_layouts(spark):
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}, [("user", "q"), ("assistant", "")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
        ({"instruction": "do", "input": None, "output": "done"}, [("user", "do"), ("assistant", "done")]),
        ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do"), ("user", "this"), ("assistant", "done")]),
        ({"prompt": "p", "response": "r", "system": "s"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"question": "q", "answer": 4}, [("user", "q"), ("assistant", "4")]),
        ({"role": "user", "text": None}, [("user", "")]),
        ({"odd": {"deep": [{"x": 1}]}}, None),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(records)] + [(90, "no json"), (91, None), (92, "[1]")]
    got = {r.i: r for r in chat.turns(spark.createDataFrame(rows, "i int, record string").withColumn("turns", F.lit(1)), "record").collect()}
    for i, (_, want) in enumerate(records):
        assert (None if got[i].turns is None else [tuple(t) for t in got[i].turns]) == want
    assert got[8].layout == chat.fingerprint({"odd.deep[].x"}) and got[8].layout_name is None
    assert all(got[i].layout is None and got[i].turns is None for i in (90, 91, 92))
    mine = chat.Layout("mine", ("odd.deep[].x",), (("user", "odd"),))
    assert chat.turns(spark.createDataFrame(rows, "i int, record string"), "record", (mine,)).where("layout_name = 'mine'").count() == 1


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    at = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    path = rest[at:]
    path = path[:min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), path


URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=/", "http://example.org", "http://myexample.org/es/", "x://b.com/fr/#t",
        "http://com/de/", "http://a.com?/de/", "http://a.com/de/x", "no scheme", "", None, "http://", "a://b://c/d", "http://ÄX.NET/é", "http://n.net/\nx"]


def test_urls(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:3])], "page_id bigint, url string").withColumn("host", F.lit("mine"))
    got = urls.filtered(df, [urls.Rule(*r) for r in rules]).collect()
    assert len(got) == len(URLS) + 3
    for r in got:
        host, path = brute_url(r.url)
        assert (r.host, r.path) == (host, path)
        fits = [(v, x) for v, x in rules for h, _, p in [x.partition("/")]
                if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        verdict, rule = max(fits, key=lambda f: len(f[1]), default=(None, None))
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert urls.filtered(df.where("false"), []).count() == 0
    assert {r.verdict for r in urls.filtered(df, []).collect()} == {"allow"}          # nothing to learn from


def test_url_filter_leaves_columns_of_any_name(spark):
    own = ("learned", "rule_verdict", "_features", "_grams", "_raw", "row", "a.b")
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string").withColumns({c: F.lit(f"my {c}") for c in own})
    rules = [urls.Rule("allow", "org/"), urls.Rule("block", "com/de/")]
    got = urls.filtered(df.withColumns({"Host": F.lit(1), "verdict": F.lit(2)}), rules)
    assert got.columns == [*df.columns, "host", "path", "rule", "verdict"]
    assert all(r[c] == f"my {c}" for r in got.collect() for c in own)
    only = urls.filtered(df.select("url"), rules).collect()
    assert sorted(r.verdict for r in only) == sorted(r.verdict for r in got.collect())


def plain_grams(host, path):
    return [mark + told[i:i + n] for mark, name in (("h", host), ("p", path)) for n in urls.GRAMS
            for told in [f"^{name}$"] for i in range(len(told) - n + 1)]


def test_learned_verdicts_are_those_of_a_plain_regression(spark):
    """Newton steps on the same penalised likelihood, in the space of the examples instead of the features."""
    rng = random.Random(7)
    rows = [(f"http://{rng.choice(['news', 'shop', 'blog', 'bets'])}{rng.randint(0, 9)}.{rng.choice(['casino.biz', 'library.edu', 'town.net'])}/{rng.randint(0, 999)}",) for _ in range(240)]
    rows = sorted(set(rows))
    verdicts = ["block" if ("casino" in u) != (rng.random() < 0.05) else "allow" for u, in rows]
    labelled = spark.createDataFrame([(u, v) for (u,), v in zip(rows[::2], verdicts[::2])], "url string, verdict string")
    got = {r.url: r.verdict for r in urls.filtered(spark.createDataFrame(rows, "url string"), [], labelled).collect()}

    split = spark.createDataFrame(rows, "url string").select("url", urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path"))
    found = {r.url: r for r in urls.featured(split).collect()}
    assert all(r._grams == plain_grams(r.host, r.path) for r in found.values())
    x = np.array([found[u]._features.toArray() for u, in rows])
    y = np.array([v == "block" for v in verdicts], float)[::2]
    spread = x[::2].std(0, ddof=1)
    z = np.divide(x, spread, out=np.zeros_like(x), where=spread > 0)       # the penalty is on features of equal spread
    own = z[::2]
    n, strength = len(own), 0.001
    kernel, a, b = own @ own.T, np.zeros(n), 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(kernel @ a + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        left = np.block([[w[:, None] * kernel + n * strength * np.eye(n), w[:, None]], [w[None] @ kernel, w.sum()[None, None]]])
        right = np.concatenate([w * (kernel @ a + b) + y - p, [w @ (kernel @ a + b) + (y - p).sum()]])
        solved = np.linalg.solve(left, right)
        a, b = solved[:-1], solved[-1]
    said = z @ (own.T @ a) + b
    clear = np.abs(said) > 0.05
    assert clear.mean() > 0.95
    assert all(got[u] == ("block" if v > 0 else "allow") for (u,), v, sure in zip(rows, said, clear) if sure)


def test_url_model_on_held_out_urls(spark):
    rng = random.Random(6)
    rows = [(f"http://{rng.choice(['news', 'shop', 'blog'])}{rng.randint(0, 99)}.{t}/{rng.randint(0, 9999)}", v)
            for t, v in [("casino-bets.biz", "block"), ("library.edu", "allow")] for _ in range(150)]
    labelled = spark.createDataFrame(rows[::2] + [(None, None), (None, "allow")], "url string, verdict string")
    got = urls.filtered(spark.createDataFrame(rows[1::2], "url string, want string"), [], labelled).collect()
    assert sum(r.verdict == r.want for r in got) / len(got) > 0.95
