"""The queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import collocations, decontaminate, langid, licenses, middle, mixing, packing, pii, quality, sharding, simhash, tokens, warc
from concord.session import table

TOKENIZER = "byte_bpe_50k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), decontaminate.items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), keep=["doc_id"])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = langid.identify(documents, langid.fit(documents), keep=["doc_id"])
    return found.select("doc_id", langid.is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = middle.fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("fim")).alias("output_sha256"), sha(middle.restored("fim", "form")).alias("restored_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_packing, op3_simhash, op4_warc, op5_licenses, op6_pii, op7_sharding, op8_token_counts, op9_language_id, op10_quality, op11_fill_in_middle, op12_collocations, op13_mixing)}
_WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: Windows of every length that an item gives, joined with the documents' windows of that length.
_OP1_SQL = f"""with d as (select doc_id, row_number() over () as r, {_WORDS.format("coalesce(text, '')")} as w from documents),
 i as (select item_id::varchar as item, {_WORDS.format("text")} as w from benchmark where item_id is not null and text is not null),
 x as (select distinct item, least(len(w), 10) as m, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as g from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from i where len(w) > 0)),
 sizes as (select distinct m from x),
 p as (select r, k, m, array_to_string(w[k:k + m - 1], ' ') as g from (select r, w, m, unnest(range(1, len(w) - m + 2)) as k from d, sizes where len(w) >= m)),
 h as (select p.r, p.k, p.m, x.item from p join x on p.g = x.g and p.m = x.m),
 hit as (select r, count(distinct word) as n from (select r, unnest(range(k, k + m)) as word from (select distinct r, k, m from h)) group by r),
 items as (select r, count(*) as n, string_agg(item, ',' order by item) as s from (select distinct r, item from h) group by r)
 select doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items, sha256(coalesce(items.s, '')) as items_sha256, coalesce(hit.n, 0) > 0 as contaminated
 from d left join hit using (r) left join items using (r)"""
_OP11_SQL = """with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as s from documents),
 h as (select doc_id, t, length(t)::bigint as n, ('0x' || s[1:8])::bigint as h1, ('0x' || s[9:16])::bigint as h2, ('0x' || s[17:24])::bigint as h3, ('0x' || s[25:32])::bigint as h4 from d),
 c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
 p as (select *, substring(t, 1, a) as pre, substring(t, a + 1, b - a) as mid, substring(t, b + 1) as suf from c)
 select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256, sha256(t) as restored_sha256 from p"""
#: Every phrase of every piece is laid out and counted.
_OP12_SQL = """with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
 p as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) as piece from d)),
 g as (select lang, m, array_to_string(w[k:k + m - 1], ' ') as g from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as k from p, (values (1), (2), (3), (4), (5)) v(m) where len(w) >= m)),
 f as (select lang, m, g, count(*) as f from g group by all),
 n as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
 c as (select lang, m, g, f as a, string_split(g, ' ') as w from f where m >= 2 and f >= 100),
 held as (select distinct lang, array_to_string(w[k:k + len - 1], ' ') as g, a from (select lang, w, a, len, unnest(range(1, m - len + 2)) as k from (select lang, m, w, a, unnest(range(2, m)) as len from c))),
 best as (select lang, g, max(a) as longer from held group by lang, g),
 x as (select c.lang, c.g, c.a, k, array_to_string(c.w[1:k], ' ') as lg, array_to_string(c.w[k + 1:], ' ') as rg from (select c.*, unnest(range(1, m)) as k from c) c left join best b on b.lang = c.lang and b.g = c.g where b.longer is null or 100 * b.longer < 100 * c.a),
 s as (select x.lang, x.g, x.a, x.k, l.f as l, r.f as r, n.n, ((1000::hugeint * x.a * n.n) // (l.f::hugeint * r.f))::bigint as score from x join f l on l.lang = x.lang and l.g = x.lg join f r on r.lang = x.lang and r.g = x.rg join n on n.lang = x.lang),
 low as (select * from s qualify row_number() over (partition by lang, g order by score, k) = 1)
 select lang, rank, g as phrase, a, l, r, n, score from (select *, row_number() over (partition by lang order by score desc, a desc, g) as rank from low) where rank <= 2000"""
#: The other queries learn, tokenise, hash by XXH64, draw or pack; SQL cannot express them.
ORACLES: dict[str, str] = {"op1_decontamination": _OP1_SQL, "op11_fill_in_middle": _OP11_SQL, "op12_collocations": _OP12_SQL}
