"""The operators with production parameters over their whole tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from canopy.llm import bpe, chat, hmm, langid, lengths, lzprint, manifest, mixing, search, simhash, substring, urls, vectors
from canopy.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(apply_settings(spark), folder)

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op6_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every whole text and the bytes they decode to, as digests."""
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_source_mixing", """
with docs as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
           ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '') || '|mix'), 1, 15))::bigint as tie
    from documents),
sizes as (
    select source, sum(size)::bigint as n, [5, 2, 1][((row_number() over (order by source nulls last)) - 1) % 3 + 1] as w
    from docs group by source),
filled as (
    select *, 1.5::double * sum(n) over () - coalesce(sum(2 * n) over before, 0) as room,
           sum(w) over () - coalesce(sum(w) over before, 0) as weights
    from sizes
    window before as (order by n::double / w, source nulls last rows between unbounded preceding and 1 preceding)),
rates as (
    select *, room * w >= 2 * n * weights as is_full from filled),
level as (
    select min(weights) filter (where is_full) as x, max(room) filter (where not is_full) as room,
           max(weights) filter (where not is_full) as weights from rates),
targets as (
    select r.source, r.n, case when r.is_full then 2.0::double * r.n else level.room::double * r.w / level.weights end as target,
           ('0x' || substr(md5(coalesce(r.source, '') || '|mix'), 1, 5))::bigint / 1048576.0::double as u
    from rates r, level),
placed as (
    select d.doc_id, d.size, t.n as source_size, t.target, t.u, case when t.n = 0 then 0.0::double else t.target / t.n end as rate,
           row_number() over (partition by d.source order by d.size, d.tie, d.doc_id) as pos
    from docs d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       ((floor(pos * rate + u) - floor((pos - 1) * rate + u)) * size)::bigint as taken
from placed""")
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 5, 2, 1 in turn."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op1_substring_dedup", """
with docs as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
windows as (
    select doc_id, pos, array_to_string(w[pos:pos + 49], ' ') as s
    from (select doc_id, w, unnest(range(1, len(w) - 48)) as pos from docs where len(w) >= 50)),
first as (select s, min(doc_id) as doc_id from windows group by s having min(doc_id) < max(doc_id)),
gone as (
    select distinct doc_id, unnest(range(pos, pos + 50)) as pos
    from (select w.doc_id, w.pos from windows w join first f on w.s = f.s and f.doc_id < w.doc_id)),
kept as (
    select d.doc_id, string_agg(d.word, ' ' order by d.pos) as text
    from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from docs) d
    anti join gone g on d.doc_id = g.doc_id and d.pos = g.pos group by d.doc_id),
counts as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n, 0)::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from docs d left join counts c on d.doc_id = c.doc_id left join kept k on d.doc_id = k.doc_id""")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words under a 50-word window that an earlier document also has are removed."""
    kept = substring.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 or fewer differing bits."""
    found = simhash.groups(table(spark, folder, "documents"), shingle=3, distance=2)
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query("op3_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text, learnt from the documents that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(docs, ~held_out)
    predicted = langid.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op4_chat_formatting", """
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
told as (
    select *, regexp_replace(text, '(\\\\*(?:</?s>|\\[/?(?:INST|SYS|ROLE|MSG)\\]))', '\\\\\\1', 'g') as t,
           regexp_replace(role, '(\\\\*(?:</?s>|\\[/?(?:INST|SYS|ROLE|MSG)\\]))', '\\\\\\1', 'g') as r
    from rows)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
       sum(length(t) + case role when 'user' then 16 when 'assistant' then 10 when 'system' then 14
                                 else 29 + length(r) end)::bigint as formatted_chars
from told group by conv_id""")
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation in one template, read back from it; one row more shows control strings in texts."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    records = rows.union(hostile).select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("record"))
    found = chat.turns(records, "record").select("conv_id", "turn", F.posexplode("turns").alias("part", "t"))
    return chat.digests(chat.formatted(found.select("conv_id", "turn", "part", "t.role", "t.text")), "conv_id", ["turn", "part"])


RULES = [urls.Rule("allow", "org/"), urls.Rule("block", "example.org/es/"), urls.Rule("block", "example.org/en/1"),
         urls.Rule("allow", "com/fr/"), urls.Rule("block", "com/de/")]


@query("op5_url_filter")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL judged by rule, else by what a bounded sample of the ruled URLs teaches."""
    found = urls.filtered(table(spark, folder, "pages").select("page_id", "url"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query("op7_lz_fingerprint")
def lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike text, edited text and next text are."""
    return lzprint.compare_edited(table(spark, folder, "documents"))


@query("op8_embedding_near_dedup", """
with vecs as (select vec_id, embedding::double[] as v from embeddings),
good as (select * from vecs where v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
         and len(list_filter(v, lambda x: x <> 0)) > 0),
pairs as (select a.vec_id as a, b.vec_id as b from good a join good b
          on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
reach as (
    with recursive r(vec_id, to_id) as (
        select vec_id, vec_id from vecs union select r.vec_id, p.b from r join pairs p on r.to_id = p.a)
    select vec_id, min(to_id) as component_id from r group by vec_id)
select v.vec_id, (select count(*) from pairs p where p.a = v.vec_id)::bigint as n_links, r.component_id,
       v.vec_id = r.component_id as kept
from vecs v join reach r on v.vec_id = r.vec_id""")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links between all vectors of at least cosine 0.9, and their groups."""
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query("op10_token_lengths")
def token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Totals, quantiles and truncated totals of the documents' token counts, for every limit."""
    counts = lengths.histogram(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))
    return lengths.limits(counts)


@query("op11_ranked_search", """
with terms as (
    select doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from (select doc_id, text, row_number() over () as row from documents)),
tf as (select doc_id, row, term, count(*)::bigint as tf from terms group by all),
docs as (select row, sum(tf)::bigint as n from tf group by row),
total as (select count(*)::bigint as docs, sum(n)::bigint as length from docs),
weight as (
    select term, floor(1000 * ln((2 * any_value(t.docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
    from tf, total t group by term),
part as (
    select tf.doc_id, tf.row, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (100 - 50 + (50 * d.n * t.docs) // t.length))) as x
    from tf join docs d on tf.row = d.row join weight w on tf.term = w.term, total t),
items as (
    select distinct item_id, item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from (select item_id, text, row_number() over () as item from benchmark)),
scored as (select i.item_id, i.item, p.doc_id, p.row, sum(p.x)::bigint as score from items i join part p on i.term = p.term group by all),
ranked as (select *, row_number() over (partition by item order by score desc, doc_id nulls first, row) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50""")
def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item, over all documents."""
    return search.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf_sql(text: str) -> str:
    each = [f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in [*_FIELDS[:-1], text]]
    return f"sha256({' || '.join(each)})"


@query("op12_merkle_manifest", f"""
with recursive docs as (
    select *, row_number() over () as row, {_leaf_sql("text")} as leaf,
           {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as lowered from documents),
crc as (
    select 0 as byte, (select list(c order by i) from (
        with recursive t(i, c, k) as (
            select i, i::bigint, 0 from range(256) r(i)
            union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from t where k < 8)
        select i, c from t where k = 8)) as tab),
hashed(row, digits, c) as (
    select row, doc_id::varchar, 4294967295::bigint from docs where doc_id is not null
    union all
    select row, digits[2:], xor(c >> 8, tab[(xor(c, ord(digits[1])) & 255) + 1]) from hashed, crc where digits <> ''),
tampered as (select row from hashed where digits = '' and xor(c, 4294967295) % 5 = 0),
leaves as (
    select d.row, d.doc_id, d.source, d.leaf, case when t.row is null then d.leaf else d.lowered end as changed,
           row_number() over (partition by d.source order by d.doc_id nulls first, d.leaf) - 1 as pos, count(*) over (partition by d.source) as n
    from docs d left join tampered t on d.row = t.row),
nodes(source, level, pos, n, h) as (
    select source, 0, pos, n, leaf from leaves
    union all
    select source, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' order by pos)) from nodes where n > 1
    group by source, level, pos // 16, (n + 15) // 16),
subroots as (
    select source, h as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1),
upper_nodes(level, pos, n, h) as (
    select 0, pos, n, subroot from subroots
    union all
    select level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' order by pos)) from upper_nodes where n > 1 group by level, pos // 16, (n + 15) // 16),
own(row, source, level, pos, n, h) as (
    select row, source, 0, pos, n, changed from leaves
    union all
    select f.row, f.source, f.level + 1, f.pos // 16, (f.n + 15) // 16, sha256(string_agg(case when c.pos = f.pos then f.h else c.h end, '' order by c.pos))
    from own f join nodes c on c.source is not distinct from f.source and c.level = f.level and c.pos // 16 = f.pos // 16
    where f.n > 1 group by f.row, f.source, f.level, f.pos // 16, (f.n + 15) // 16),
higher(row, level, pos, n, h) as (
    select o.row, 0, s.pos, s.n, o.h from own o join subroots s on o.source is not distinct from s.source where o.n = 1
    union all
    select f.row, f.level + 1, f.pos // 16, (f.n + 15) // 16, sha256(string_agg(case when c.pos = f.pos then f.h else c.h end, '' order by c.pos))
    from higher f join upper_nodes c on c.level = f.level and c.pos // 16 = f.pos // 16
    where f.n > 1 group by f.row, f.level, f.pos // 16, (f.n + 15) // 16),
sides as (
    select f.row, 0 as stage, f.level, c.pos, c.h from own f join nodes c
        on c.source is not distinct from f.source and c.level = f.level and c.pos // 16 = f.pos // 16 and c.pos <> f.pos where f.n > 1
    union all
    select f.row, 1, f.level, c.pos, c.h from higher f join upper_nodes c
        on c.level = f.level and c.pos // 16 = f.pos // 16 and c.pos <> f.pos where f.n > 1),
proofs as (select row, string_agg(h, '' order by stage, level, pos) as p from sides group by row)
select l.doc_id, l.leaf, s.subroot, r.h as root, sha256(coalesce(p.p, '')) as proof_sha256, f.h as folded_root, f.h = r.h as verified
from leaves l join subroots s on l.source is not distinct from s.source join higher f on f.row = l.row and f.n = 1
left join proofs p on p.row = l.row, (select h from upper_nodes where n = 1) r""")
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a leaf, its proof, and the root of a version in which a fifth of the texts are changed."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    change = [*map(F.col, _FIELDS[:-1]), F.translate("text", letters, letters.lower())]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = manifest.manifest(table(spark, folder, "documents"), _FIELDS, tampered, change)
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_hmm_scoring")
def hmm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probability of every text under states learnt from the texts that are not held out, and word by word."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    shards = hmm.prepare(table(spark, folder, "documents"), ~held_out)
    scored = hmm.score(shards, hmm.fit(shards))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
