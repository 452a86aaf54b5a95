"""Registered queries of the corpus operators: thin wrappers over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, decontam, middle, minhash, negatives, phrases, pii, ppm, quality, suffix_dedup, tagpaths
from .util import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_spans(table(spark, sf_dir, "documents")).drop("spans")


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.language_scores(table(spark, sf_dir, "documents"))


def op7_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.removed_words(table(spark, sf_dir, "documents")).drop("spans")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.extract(table(spark, sf_dir, "pages"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, shifted)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_conversations(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_quality_classifier, op2_pii, op3_bpe, op4_decontamination, op5_suffix_dedup, op6_ppm, op7_phrases, op8_html_text, op9_ann, op10_minhash,
        op11_hard_negatives, op12_fill_in_middle, op13_chat_format,
    )
    return {f.__name__: f for f in own}


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7_SQL = f"""
with d as (select doc_id, {WORDS} w from documents),
n as (select doc_id, s, w[s + 1:s + 35] v from (select doc_id, w, unnest(range(len(w) - 34)) s from d where len(w) >= 35)),
dup as (select doc_id, s from n where v in (select v from n group by v having count(*) > 1)),
p as (select doc_id, w[p + 1] x, p from (select doc_id, w, unnest(range(len(w))) p from d)),
c as (select p.*, coalesce(max(dup.s) over (partition by p.doc_id order by p.p rows unbounded preceding) > p.p - 35, false) gone from p left join dup on dup.doc_id = p.doc_id and dup.s = p.p),
o as (select doc_id, count_if(gone) n_removed, string_agg(x, ' ' order by p) filter (not gone) kept from c group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join o using (doc_id)"""

OP10_SQL = f"""
with recursive d as (select doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} w from documents),
g as (select distinct doc_id, w[i + 1:i + 5] v from (select doc_id, w, unnest(range(greatest(1, len(w) - 4))) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from g group by 1),
pairs as (select a.doc_id a, b.doc_id b, count(*) m from g a join g b on a.v = b.v and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * m >= 75 * (x.n + y.n - m)),
e as (select a, b from links union all select b, a from links),
reach as (select a node, a root from e union select e.b, reach.root from reach join e on e.a = reach.node where reach.root < e.b),
c as (select node, min(root) component from reach group by 1)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, least(d.doc_id, coalesce(component, d.doc_id)) component_id,
  d.doc_id <= coalesce(component, d.doc_id) kept from d left join n using (doc_id) left join c on c.node = d.doc_id"""


OP11_SQL = """
with u as (select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end l, list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)),
s as (select a.vec_id a, b.vec_id b, a.l = b.l same, list_inner_product(a.v, b.v)::bigint s from u a join u b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select a, b, s from s where same qualify row_number() over (partition by a order by s desc, b) <= 5),
n as (select p.a, p.b p, p.s ps, s.b n, s.s ns, row_number() over (partition by p.a, p.b order by s.s desc, s.b) r
  from p join s on s.a = p.a and not s.same and 50 * p.s <= 100 * s.s and 100 * s.s <= 95 * p.s)
select a anchor_id, p positive_id, r::int "rank", n negative_id, ps positive_score, ns negative_score from n where r <= 3"""

OP12_SQL = """
with h as (select doc_id, coalesce(text, '') t, length(coalesce(text, '')) n, sha256('1:' || coalesce(doc_id::varchar, '')) h from documents),
k as (select *, ('0x' || h[1:8])::ubigint h1, ('0x' || h[9:16])::ubigint h2, ('0x' || h[17:24])::ubigint h3, ('0x' || h[25:32])::ubigint h4 from h),
c as (select *, least(h1 % (n + 1), h2 % (n + 1))::bigint a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end form from k),
o as (select *, t[1:a] p, t[a + 1:b] m, t[b + 1:] s from c)
select doc_id, n::bigint n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(t) restored_sha256 from o"""

OP13_SQL = r"""
with r as (select conv_id, turn, role, coalesce(text, '') t from conversations
  union all select -1, k, case k when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) x(k)),
e as (select *, regexp_replace(t, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS>|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g') x from r),
f as (select *, case role when 'user' then '[INST] ' || x || ' [/INST]' when 'assistant' then ' ' || x || '</s>' when 'system' then '<SYS>' || x || '</SYS>'
  else '[ROLE]' || role || '[TEXT]' || x || '[/ROLE]' end p from e)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn)) turns_sha256,
  coalesce(sum(length(t)) filter (role = 'assistant'), 0)::bigint loss_chars, sha256(coalesce(string_agg(t, '' order by turn) filter (role = 'assistant'), '')) loss_sha256,
  (3 + sum(length(p)))::bigint formatted_chars from f group by 1"""


def oracle_sql() -> dict[str, str]:
    return {"op7_phrases": OP7_SQL, "op10_minhash": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_chat_format": OP13_SQL}
