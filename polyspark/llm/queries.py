"""One query per operator over its whole table, with its SQL where one exists.

``QUERIES``: name -> (function of session and data folder, SQL or None).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from polyspark.llm import automaton, covertree, decontam, html, langid, merkle, merkle_sql, minhash, mixing, negatives, quality, suffixes, toxicity, warc
from polyspark.llm.common import crc_rest, held_out, read_table
from polyspark.session import checkpoint_dir


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with d as (
  select doc_id, source, case when source is null then '1' else '0' || source end s,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint size, md5(coalesce(doc_id::varchar, '')) k
  from documents),
t as (select s, sum(size)::bigint source_size from d group by s),
w as (select *, list_element([5, 2, 1], ((row_number() over (order by s) - 1) % 3 + 1)::int)::bigint w, 3 * source_size cap from t),
l as (select *, row_number() over o n, (sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))::bigint rem,
             (sum(w) over (o rows between current row and unbounded following))::bigint rest
      from w window o as (order by cap / w, s)),
f as (select n, rem, rest from l where cap::hugeint * rest > rem::hugeint * w order by n limit 1),
g as (select l.s, l.source_size, case when l.n >= f.n then f.rem * l.w / f.rest else l.cap::double end target from l left join f on true),
p as (select d.*, g.source_size, g.target, coalesce(sum(size) over (partition by d.s order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint before
      from d join g using (s))
select doc_id, source, size, source_size, target,
       ((floor(target)::bigint // greatest(source_size, 1)) * size
         + greatest(0, least(size, floor(target)::bigint % greatest(source_size, 1) - before)))::bigint taken, before
from p
"""


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
with p as (select page_id, coalesce(html, '') h from pages),
q as (select page_id, octet_length(encode(h))::bigint payload_bytes, sha256(h) payload_digest from p),
f as (select payload_digest, min(page_id) first from q where payload_bytes >= 100 group by 1)
select q.page_id, q.payload_bytes, q.payload_digest,
       case when f.first is null or f.first = q.page_id then 'response' else 'revisit' end record_type,
       case when f.first <> q.page_id then f.first end refers_to
from q left join f using (payload_digest)
"""


def op1_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(read_table(spark, sf_dir, "embeddings"))


OP1_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from r join l on l.a = r.b),
c as (select a vec_id, min(b) component_id from r group by 1),
n as (select a vec_id, count(*) n from l group by 1)
select e.vec_id, coalesce(n.n, 0)::bigint n_links, c.component_id, e.vec_id = c.component_id kept
from embeddings e join c using (vec_id) left join n using (vec_id)
"""


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("th")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    named = langid.identify(docs, langid.fit(docs))
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_bytes(read_table(spark, sf_dir, "documents")).drop("kept")


OP4_SQL = """
with d as (select doc_id, encode(coalesce(text, '')) b, octet_length(encode(coalesce(text, '')))::bigint n from documents),
p as (select doc_id, b, unnest(range(1, n + 1)) i, n from d),
w as (select doc_id, i, md5(hex(b[i:i + 49])) h from p where i + 49 <= n),
f as (select h, min(doc_id) first from w group by 1 having count(*) > 1),
r as (select w.doc_id, w.i from w join f using (h) where f.first < w.doc_id),
m as (select p.doc_id, p.i, hex(p.b[p.i:p.i]) x, max(r.i) over (partition by p.doc_id order by p.i) >= p.i - 49 gone from p left join r using (doc_id, i)),
s as (select *, coalesce(gone, false) g, coalesce(lag(gone) over (partition by doc_id order by i), false) before from m),
k as (select doc_id, count(*) filter (g) n_removed, count(*) filter (g and not before) n_spans,
             sha256(unhex(coalesce(string_agg(x, '' order by i) filter (not g), ''))) kept_sha256 from s group by 1)
select d.doc_id, d.n n_bytes, coalesce(n_removed, 0)::bigint n_removed, coalesce(n_spans, 0)::bigint n_spans, coalesce(kept_sha256, sha256('')) kept_sha256
from d left join k using (doc_id)
"""


def op5_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.removed_words(read_table(spark, sf_dir, "documents")).drop("kept")


OP5_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
p as (select doc_id, w, unnest(range(1, len(w) + 1)) i from d),
v as (select doc_id, i, array_to_string(w[i:i + 19], ' ') g from p where i + 19 <= len(w)),
f as (select g, min((doc_id, i)) first from v group by 1 having count(*) > 1),
r as (select v.doc_id, v.i from v join f using (g) where f.first < (v.doc_id, v.i)),
m as (select p.doc_id, p.i, p.w[p.i] x, coalesce(max(r.i) over (partition by p.doc_id order by p.i) >= p.i - 19, false) gone from p left join r using (doc_id, i)),
k as (select doc_id, count(*) filter (gone) n_removed, sha256(coalesce(string_agg(x, ' ' order by i) filter (not gone), '')) kept_sha256 from m group by 1)
select d.doc_id, len(d.w)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, coalesce(kept_sha256, sha256('')) kept_sha256
from d left join k using (doc_id)
"""


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("group", "th")


OP10_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
e as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
             else list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) end s from d),
n as (select doc_id, len(s)::bigint n_shingles from e),
c as (select s, min(doc_id) rep from e where len(s) > 0 group by s),
x as (select rep, unnest(s) g from c),
p as (select a.rep a, b.rep b, count(*) k from x a join x b on a.g = b.g and a.rep < b.rep group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 85 * (na.n_shingles + nb.n_shingles - k)),
u as (select a, b from l union all select b, a from l),
r(a, b) as (select rep, rep from c union select r.a, u.b from r join u on r.b = u.a),
m as (select a rep, min(b) component_id from r group by 1)
select e.doc_id, n.n_shingles, coalesce(m.component_id, e.doc_id) component_id, coalesce(m.component_id, e.doc_id) = e.doc_id kept
from e join n using (doc_id) left join c on c.s = e.s and n.n_shingles > 0 left join m on m.rep = c.rep
"""



def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    held = crc_rest("doc_id", 4) == 2
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    divides = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(read_table(spark, sf_dir, "documents"), tampered=divides)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), label=moved, anchors=F.col("vec_id") % 50 == 0)


OP13_SQL = """
with v as (
  select vec_id, row_number() over () r, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
         list_transform(embedding, lambda x: floor(256 * x::double)) q
  from embeddings
  where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select a.r ar, a.vec_id anchor_id, b.r, b.vec_id, a.l = b.l same, list_dot_product(a.q, b.q)::bigint s
      from v a join v b on a.vec_id % 50 = 0 and a.r <> b.r and len(a.q) = len(b.q)),
p as (select * from s where same qualify row_number() over (partition by ar order by s desc, vec_id, r) <= 5),
n as (select p.anchor_id, p.vec_id positive_id, row_number() over (partition by p.ar, p.r order by n.s desc, n.vec_id, n.r)::int as rank,
             n.vec_id negative_id, p.s positive_score, n.s negative_score
      from p join s n on n.ar = p.ar and not n.same and 50 * p.s <= 100 * n.s and 100 * n.s <= 95 * p.s)
select * from n where rank <= 3
"""

QUERIES = {
    "op7_mixing": (op7_mixing, OP7_SQL),
    "op8_html": (op8_html, None),
    "op9_warc": (op9_warc, OP9_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op1_covertree": (op1_covertree, OP1_SQL),
    "op2_decontam": (op2_decontam, None),
    "op3_quality": (op3_quality, None),
    "op4_suffix_array": (op4_suffix_array, OP4_SQL),
    "op5_automaton": (op5_automaton, OP5_SQL),
    "op6_langid": (op6_langid, None),
    "op10_minhash": (op10_minhash, OP10_SQL),
    "op11_toxicity": (op11_toxicity, None),
    "op12_merkle": (op12_merkle, merkle_sql.SQL),
    "op13_negatives": (op13_negatives, OP13_SQL),
}
