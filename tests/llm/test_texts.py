"""Operators on documents, against brute force over whole small tables."""

import base64
import hashlib
import inspect
import re
from collections import Counter

import pytest
import public_tokenizers
import tiktoken
import xxhash
from helpers import SCHEMA, awkward, frame, listed, prose
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from canopy.llm import bpe, chunks, langid, lengths, lzprint, mixing, simhash, substring

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.vocabulary(bpe.read_vocabulary(PATH)).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("aeth 's\n\t\x0b\x1c\x85\u3000é×½٣_-", max_size=80)), max_size=5))
def test_ids_are_the_librarys(library, values):
    encoder = bpe.encoder(bpe.read_vocabulary(PATH), bpe.PATTERN)
    for text, ids in zip(values, encoder.encode(values)):
        assert ids == ",".join(map(str, library.encode_ordinary(text)))


def test_long_pieces_and_a_full_memory(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 10)
    monkeypatch.setattr(bpe, "HELD_CHARS", 50)
    values = ["ab" * 4000, " " * 700, "é" * 999, "q" * 33 + "!" * 300, "the cat sat on the mat " * 30, None, ""]
    encoder = bpe.Encoder(bpe.read_vocabulary(PATH), bpe.PATTERN)
    assert encoder.encode(values) == [",".join(map(str, library.encode_ordinary(v or ""))) for v in values]


@settings(max_examples=200, deadline=None)
@given(st.text("aethrs", min_size=2, max_size=200))
def test_a_piece_of_its_own_is_merged_as_beside_others(text):
    known = bpe.vocabulary(bpe.read_vocabulary(PATH))
    assert known.merge_one(text.encode()) == known.merge([text.encode()])[0] == known.merge([b"the", text.encode(), b"sea" * 50])[1]


def test_a_letter_run_of_a_megabyte(library):
    import random
    text = "".join(random.Random(8).choices("abcdefghijklmnopqrstuvwxyz", k=1 << 20))
    same = bpe.Encoder(bpe.read_vocabulary(PATH), bpe.PATTERN).encode([text, text + "a"]) == [
        ",".join(map(str, library.encode_ordinary(t))) for t in (text, text + "a")]
    assert same


@pytest.mark.parametrize("size", [1 << 22, (1 << 22) + 1])      # trees of 2**22 and 2**23 leaves
def test_pieces_of_megabytes(size):
    tokens = [bytes([i]) for i in range(256)] + [b"ab"]
    ranks = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    piece = b"ab" + b"." * (size - 4) + b"ab"
    same = bpe.Vocabulary(ranks).encode([piece]) == ["256," + "46," * (size - 4) + "256"]
    assert same         # no listing of megabytes


def test_encode_and_decode_frames(spark, library):
    df = bpe.decode(bpe.encode(frame(spark).withColumn("ids", F.lit("mine")), PATH), PATH)
    assert df.columns[:2] == ["doc_id", "text"] and df.columns.count("ids") == 1
    for r in df.collect():
        ids = library.encode_ordinary(r.text or "")
        assert (r.ids, r.n_tokens, bytes(r.decoded)) == (",".join(map(str, ids)), len(ids), (r.text or "").encode())
    assert bpe.encode(frame(spark, []), PATH).count() == 0


def brute_removed(rows, window):
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    seen = {}
    for (i, *_), w in zip(rows, words):
        for a in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[a:a + window])
                seen[k] = min(seen.get(k, i), i)
    out = []
    for (i, *_), w in zip(rows, words):
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and seen[tuple(w[a:a + window])] < i:
                gone.update(range(a, a + window))
        out.append((i, len(w), len(gone), " ".join(x for a, x in enumerate(w) if a not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 5])
@pytest.mark.parametrize("chunk_bytes", [1 << 20, 2000])
def test_substring_dedup(spark, monkeypatch, window, chunk_bytes):
    monkeypatch.setattr(chunks.id_bounds, "__defaults__", (chunk_bytes,))
    monkeypatch.setattr(substring, "BLOCK", 64)
    df = frame(spark)
    if chunk_bytes == 2000:
        assert len(chunks.id_bounds(df, "doc_id", "text")) > 3
    got = substring.remove_repeats(df, window=window)
    assert listed(got, "doc_id", "n_words", "n_removed", "text") == brute_removed(awkward(), window)
    for r in got.where("n_removed > 0").collect():
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))        # maximal


def test_substring_dedup_keeps_separators_and_columns(spark):
    got = substring.remove_repeats(frame(spark), one_space=False, carry=["lang", "rest", "chunk"])
    texts = {r[0]: r[1] for r in awkward()}
    for r in got.collect():
        assert r.rest.chunk == 1 and r.rest.rest == "r"
        assert r.n_removed or r.text == (texts[r.doc_id] if r.doc_id is not None else r.text)
    assert got.where("doc_id = 60").first().text is None
    assert got.where("doc_id = 40").first().text == ""                          # a copy is removed whole
    assert substring.remove_repeats(frame(spark, [])).count() == 0


def test_ids_that_are_no_numbers_are_an_error(spark):
    df = frame(spark).withColumn("doc_id", F.col("doc_id").cast("string"))
    for operator in (substring.remove_repeats, lzprint.compare_edited):
        with pytest.raises(TypeError, match="doc_id|key"):
            operator(df)


def test_interval_edges():
    assert substring.cut("a b\n\nc  d", [(1, 2)], False) == "a c  d"
    assert substring.cut("  a b c ", [(0, 1), (2, 3)], True) == "b"
    assert substring.cut("a b", [(0, 2)], False) == "" and substring.cut(None, [], False) is None


def brute_groups(rows, shingle, distance):
    def mark(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if not words:
            return 0
        parts = [" ".join(words[a:a + shingle]) for a in range(max(1, len(words) - shingle + 1))]
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    marks = [mark(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for a, x in enumerate(marks):
            for b, y in enumerate(marks):
                if (x ^ y).bit_count() <= distance:
                    group[a] = group[b] = min(group[a], group[b])
    first = {}
    for (i, *_), g in zip(rows, group):
        if i is not None:
            first[g] = min(first.get(g, i), i)
    return [(i, m, first.get(g)) for (i, *_), m, g in zip(rows, marks, group)]


@pytest.mark.parametrize("shingle,distance", [(3, 2), (3, 0), (2, 5)])
def test_simhash_groups(spark, shingle, distance):
    got = simhash.groups(frame(spark), shingle=shingle, distance=distance)
    want = [(i, m - (1 << 64) if m >> 63 else m, c) for i, m, c in brute_groups(awkward(), shingle, distance)]
    assert listed(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_simhash_links_are_all_pairs_within_the_distance(spark, distance):
    import random
    rng = random.Random(7)
    prints = {0, -1, 1 << 62, -(1 << 63)}
    for _ in range(20):
        base = rng.getrandbits(64)
        prints.update((x := base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))) - ((x >> 63) << 64) for _ in range(8))
    mask = (1 << 64) - 1
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & mask).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(p,) for p in prints], "f bigint"), distance).collect()
    assert {(min(r), max(r)) for r in map(tuple, got)} == want


def test_simhash_keys_are_never_broadcast(spark):
    """The planner sees the fingerprints' size, a 64th of that of their keys, and would collect the keys in the driver."""
    links = simhash.links(spark.range(100).select(F.xxhash64("id").alias("f")), 2)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2


def test_keep_first_leaves_one_of_each_group(spark):
    df = frame(spark)
    kept = simhash.keep_first(df)
    groups = brute_groups(awkward(), 3, 2)
    want = sorted((i for i, _, c in groups if i is not None and i == c), key=repr)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want
    assert simhash.keep_first(frame(spark, [])).count() == 0


def test_keep_first_tells_texts_of_one_key_apart(spark):
    import random
    a, b = (prose(random.Random(n), 60) for n in (1, 2))
    rows = [(1, a, "en", "s"), (2, a, "en", "s"), (2, b, "en", "s"), (3, b, "en", "s")]
    assert listed(simhash.keep_first(frame(spark, rows)), "doc_id", "text") == sorted([(1, a), (2, b)], key=repr)


OWN = ("_key", "_print", "_first", "k", "t", "told", "row", "component_id", "fingerprint", "a.b")


def test_keep_first_leaves_columns_of_any_name(spark):
    df = frame(spark).withColumns({c: F.lit(f"my {c}") for c in OWN})
    got = simhash.keep_first(df)
    assert got.columns == df.columns
    assert all(r[c] == f"my {c}" for r in got.collect() for c in OWN)
    assert listed(got, "doc_id", "text") == listed(simhash.keep_first(frame(spark)), "doc_id", "text")


def test_a_small_language_keeps_its_words(spark):
    rows = [(i, f"big{i} big{i}x", "big", "s") for i in range(30)] * 5 + [(99, "wee", "small", "s")]
    df = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], SCHEMA)
    model = langid.fit(df.withColumn("text", F.translate("text", "0123456789", "klmnopqrst")), F.lit(True), entries=10)
    assert model.languages == ["big", "small"] and "wee" in model.words
    assert inspect.signature(langid.fit).parameters["per_language"].default == 10_000


def test_very_many_languages(spark, monkeypatch):
    rows = [(i, f"own{w} taxi", f"x{w}", "s") for i in range(402) for w in ["".join(chr(97 + i % 201 // 26 ** k % 26) for k in range(2))]]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(df, F.lit(True))
    assert len(model.languages) == 201
    assert all(r.lang_pred == r.lang for r in langid.predict(df, model).collect())
    monkeypatch.setattr(langid, "CELLS", 201 * 10 * 3)       # room for three entries a length, and one of each language
    small = langid.fit(df, F.lit(True))
    assert len(small.languages) == 201 and len(small.scores) <= 5 * (3 + 201) < len(model.scores)
    with pytest.raises(ValueError):
        langid.fit(df, F.lit(True), most_languages=200)


def test_language(spark):
    import random
    rng = random.Random(5)
    said = {"en": "the of and stone night river".split(), "de": "der die und stein nacht fluss".split(), "fr": "le de et pierre nuit eau".split()}
    rows = [(i, " ".join(rng.choice(said[x]) for _ in range(30)), x, "s") for i in range(200) for x in [rng.choice(list(said))]]
    rows += [(1000, None, "en", "s"), (1001, "12 ² ⅷ !!", "en", "s"), (1002, "", None, "s"), (1003, "steinfluss nachtstein", None, "s"),
             (1004, "le " * 100_000, None, "s"), (None, "the stone", "en", "s")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(df, ~held, per_language=40, entries=500)
    assert model.languages == ["de", "en", "fr"]
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert all(got[i].lang_pred == x and 0.5 < got[i].score <= 1 for i, _, x, _ in rows[:200])
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == "de" and got[1004].lang_pred == "fr"            # unseen words by their n-grams
    assert langid.fit(df.where("false"), ~held).languages == []
    assert langid.predict(df, langid.fit(df.where("false"), ~held)).where("lang_pred <> 'und'").count() == 0


def test_language_backoff_takes_the_longest_known_grams():
    import numpy as np
    model = langid.Model(["a", "b"], {"known": 0}, [{}, {"<xy": 1}, {"xy": 2}, {}], np.array([[-1.0, -5], [-3, -1], [-1, -9]]))
    scorer = langid.Scorer(model)
    assert list(langid.backoff(model, "xyz")) == [-3.0, -1.0]          # three characters before two
    assert list(langid.backoff(model, "axy")) == [-1.0, -9.0]
    assert scorer("known xyz")[0] == "a" and scorer("qq") == ("a", 0.5)     # nothing known: a tie, the first language


def test_language_with_a_full_memory(monkeypatch):
    import numpy as np
    monkeypatch.setattr(langid, "REMEMBERED", 2)
    model = langid.Model(["a", "b"], {"known": 0}, [{}, {"<xy": 1}, {"xy": 2}, {}], np.array([[-1.0, -5], [-3, -1], [-1, -9]]))
    scorer = langid.Scorer(model)
    text = "xyz known " + " ".join("xy" + c for c in "abcdefgh")
    assert [scorer(text), scorer("xyz"), scorer(text)] == [langid.Scorer(model)(t) for t in (text, "xyz", text)]


def brute_phrases(text):
    found, phrase = set(), ()
    for s in lzprint.symbols(text):
        phrase += (s,)
        if phrase not in found:
            found.add(phrase)
            phrase = ()
    return found


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 1000])
def test_fingerprints_and_edited_texts(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(chunks.id_bounds, "__defaults__", (chunk_bytes,))
    rows = [r for r in awkward() if r[0] is not None]
    got = {(r.doc_id, r.near_next): r for r in lzprint.compare_edited(frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""), reverse=True)
    for (i, t, *_), (_, n, *_) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        new = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        a, b, c = map(brute_phrases, (t, new, n))
        r = next(r for (k, _), r in got.items() if k == i)
        if i != 80:
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
            for near, other in ((r.near_edited, b), (r.near_next, c)):
                exact = len(a & other) / len(a | other) if a | other else 1.0
                assert abs(near - exact) < (1e-9 if len(a | other) <= lzprint.SMALLEST else 0.2)
    assert lzprint.compare_edited(frame(spark, [])).count() == 0
    lone = lzprint.compare_edited(frame(spark, [(5, "abcdef ghi", None, None), (None, "one two", None, None)]))
    assert listed(lone, "doc_id", "near_next") == [(5, 1.0), (None, 1.0)]


def test_fingerprints_are_equal_for_equal_texts_and_alike_for_near_ones(spark):
    import random
    rng = random.Random(1)
    text = prose(rng, 900)
    near, far = text.replace(" ", "  ", 1) + " end", prose(random.Random(2), 900).upper()
    a, b, c = (lzprint.signature(t) for t in (text, near, far))
    assert lzprint.likeness(a, b) > 0.9 and lzprint.likeness(a, c) < 0.2
    assert (lzprint.read(lzprint.written(a)) == a).all() and lzprint.written(lzprint.signature(None)) == ""
    df = lzprint.fingerprints(frame(spark))
    assert all(n == 1 for (n,) in listed(df.groupBy("text").agg(F.countDistinct("fingerprint").alias("n")), "n"))


def test_mix_meets_the_targets(spark):
    import random
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(1, 60)), "en", "abc"[min(2, rng.randint(0, 6))]) for i in range(1500)] + awkward()
    df = frame(spark, rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in got)
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = mixing.targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    assert target == want and abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1e-6
    longest = max(len(WORD.findall(r[1] or "")) for r in rows)
    assert all(abs(taken[s] - want[s]) <= max(2 * longest, 0.02 * want[s]) for s in sizes)
    key = ("doc_id", "size", "copies")
    assert listed(mixing.mix(df.repartition(7)), *key) == listed(mixing.mix(df), *key)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_targets_reshare_what_does_not_fit():
    got = mixing.targets({"a": 10, "b": 100, "c": 1000}, {"a": 5, "b": 2, "c": 1}, 1.5, 2.0)
    assert got == {"a": 20.0, "b": 200.0, "c": 1445.0}
    assert mixing.targets({"a": 0, "b": 4}, {"a": 1, "b": 1}, 1.5, 2.0) == {"a": 0.0, "b": 6.0}
    assert mixing.targets({"a": 0}, {"a": 5}, 1.5, 2.0) == {"a": 0.0}


def test_take_repeats_the_rows_of_the_mix(spark):
    df = frame(spark)
    copies = Counter()
    for r in mixing.mix(df).collect():
        copies[r.doc_id] += r.copies
    got = mixing.take(df)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == +copies


def test_take_shares_the_copies_of_alike_rows(spark):
    rows = [(1, "one two", "en", "a")] * 7 + [(None, "one two", "en", "a")] * 5 + [(2, "x " * 9, "de", "b"), (3, None, None, None)]
    own = ("_key", "_tie", "_i", "_copy", "at", "row", "copies", "each", "more", "a.b")
    df = frame(spark, rows).withColumns({c: F.lit(f"my {c}") for c in own})
    copies = Counter()
    for r in mixing.mix(df).collect():
        copies[r.doc_id] += r.copies
    got = mixing.take(df)
    assert got.columns == df.columns and all(r[c] == f"my {c}" for r in got.collect() for c in own)
    assert Counter(r.doc_id for r in got.collect()) == +copies
    assert mixing.take(frame(spark, [])).count() == 0


def test_lengths(spark, library):
    df = frame(spark)
    found = lengths.limits(lengths.histogram(df, PATH)).cache()
    each = sorted(len(library.encode_ordinary(t or "")) for _, t, *_ in awkward())
    assert {r.length: r.docs for r in found.collect()} == Counter(each)
    for r in found.collect():
        assert r.truncated == sum(min(x, r.length) for x in each) and r.lost == sum(each) - r.truncated
        assert (r.docs_from, r.tokens_from) == (sum(x >= r.length for x in each), sum(x for x in each if x >= r.length))
        assert (r.total_docs, r.total_tokens) == (len(each), sum(each))
    for limit in (0, 1, 7, 100, 511, 512, 10**7):
        assert lengths.truncated_total(found, limit).first().tokens == sum(min(x, limit) for x in each)
    for q in (0.01, 0.5, 0.9, 1.0):
        assert lengths.quantile(found, q).first().length == next(x for i, x in enumerate(each) if (i + 1) / len(each) >= q)
    empty = lengths.limits(lengths.histogram(frame(spark, []), PATH))
    assert empty.count() == 0 and lengths.truncated_total(empty, 5).first().tokens == 0
