"""Registered queries of the operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontam, htmltext, langid, ngramlm, packing, quality, rans, simhash, substrings, turns, urlfilter, warc
from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.as_responses(table(spark, sf_dir, "pages"))).withColumn("record", F.col("record").cast("string"))


def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "mixture")


def op4_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


#: The rules of the URL query.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark, URL_RULES))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = rans.new_folder(spark)
    rans.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 0, folder)
    return rans.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = langid.fold(parts=10)
    return ngramlm.score(table(spark, sf_dir, "documents"), learn=part != 0, held_out=part == 0)


def op11_prefix_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turns.report(turns.repair(turns.damage(conversations), conversations.select("conv_id")))


def op13_removal_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, QueryFn] = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_weak_supervision": op2_weak_supervision,
    "op3_language_mixture": op3_language_mixture,
    "op4_prefix_join": op4_prefix_join,
    "op5_text_density": op5_text_density,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_sum_of_squares": op8_sum_of_squares,
    "op9_rans_files": op9_rans_files,
    "op10_ngram_trie": op10_ngram_trie,
    "op11_prefix_suffix_trees": op11_prefix_suffix_trees,
    "op12_checkpointed_repair": op12_checkpointed_repair,
    "op13_removal_ranks": op13_removal_ranks,
}

_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP4_SQL = f"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '{_WORD}') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '{_WORD}') as w from benchmark),
item_windows as (
  select distinct item_id, least(len(w), 10) as m, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') as ws
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as k from b where len(w) > 0)),
doc_windows as (
  select doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') as ws
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as k from d, (select distinct m from item_windows))),
hits as (select doc_id, k, m, item_id from doc_windows join item_windows using (m, ws)),
words_hit as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(k, k + m)) as pos from hits) group by doc_id),
items_hit as (select doc_id, list_sort(list(distinct item_id::varchar)) as ids from hits group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(ids), 0)::bigint as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, n_hit is not null as contaminated
from d left join words_hit using (doc_id) left join items_hit using (doc_id)
"""

OP6_SQL = f"""
with rules(rule, verdict) as (values {", ".join(f"('{r}', '{v}')" for r, v in URL_RULES)}),
r as (select rule, verdict, split_part(rule, '/', 1) as rhost, substr(rule, strpos(rule, '/')) as rpath from rules),
u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest, row_number() over () as n from pages),
p as (select n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_FOLD}) as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
fit as (select n, rule, verdict, row_number() over (partition by n order by length(rule) desc, length(rhost) desc, verdict desc) as k
        from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join (select * from fit where k = 1) using (n)
"""

OP11_SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
wins as (select r, k, md5(array_to_string(w[k:k + 34], ' ')) as h from (select r, w, unnest(range(1, len(w) - 33)) as k from d where len(w) >= 35)),
twice as (select h from wins group by h having count(*) > 1),
hit as (select distinct r, unnest(range(k, k + 35)) as pos from wins where h in (select h from twice)),
kept as (select r, string_agg(word, ' ' order by pos) as t from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from d) anti join hit using (r, pos) group by r),
n as (select r, count(*) as n from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join n using (r) left join kept using (r)
"""

OP13_SQL = r"""
with w as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
firsts as (select t, min(doc_id) as first_id from w group by t),
l as (select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic from labels group by doc_id),
f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
             case when len(ws) < 100 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' else '' end
             || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 'C' else '' end
             || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end || case when w.doc_id > first_id then 'E' else '' end as failed
      from w join firsts using (t) left join l on w.doc_id = l.doc_id),
c as (select part, failed, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from x a, x b, x c, x d, x e
      where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, step, substr(filter_order, step::int, 1) as fl, substr(filter_order, 1, step::int - 1) as before, substr(filter_order, 1, step::int) as upto
      from o, (select unnest(range(1, 6)) as step)),
m as (select part, filter_order, step, fl, n, good, toxic, contains(failed, fl) as hit, failed = fl as alone,
             before <> '' and regexp_matches(failed, '[' || before || '_]') as earlier, regexp_matches(failed, '[' || upto || ']') as gone
      from c, s),
r as (select part, filter_order, step, fl, coalesce(sum(n) filter (not gone), 0) as kept, coalesce(sum(n) filter (hit and not earlier), 0) as removed,
             coalesce(sum(n) filter (hit and earlier), 0) as redundant, coalesce(sum(n) filter (alone), 0) as unique_fails,
             coalesce(sum(good) filter (hit and not earlier), 0) as good_lost, coalesce(sum(toxic) filter (hit and not earlier), 0) as toxic_lost
      from m group by all)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, fl))::bigint as shapley
from r
"""

ORACLE_SQL: dict[str, str] = {"op4_prefix_join": OP4_SQL, "op6_url_filter": OP6_SQL, "op11_prefix_suffix_trees": OP11_SQL, "op13_removal_ranks": OP13_SQL}
