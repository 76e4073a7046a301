"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations, html, langid, licenses, mixing, neighbours, packing, quality, ranking, secrets, simhash,
    token_counts, url_filters,
)
from .common import read_table

SEQUENCE_TOKENS = 4096


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), path)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), path, SEQUENCE_TOKENS)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(read_table(spark, sf_dir, "pages"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.lexical_search(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations")
    return conversations.conversation_digests(conversations.damage(table), table)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filters.judge_urls(pages, url_filters.rule_frame(pages, url_filters.RULES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_token_counts, op3_secret_scan, op4_best_fit_packing, op5_quality_rules,
        op6_mixing, op7_html_extraction, op8_simhash_dedup, op9_license_scan, op10_nearest_neighbours,
        op11_lexical_search, op12_conversation_repair, op13_url_filters,
    )
}


QUALITY_SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
), parts as (
  select rid, doc_id, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from docs
), windows as (
  select rid, i, array_to_string(words[i:i+7], ' ') as w
  from (select rid, words, unnest(range(1, len(words) - 6)) as i from parts)
), again as (
  select rid, i from (select rid, i, count(*) over (partition by rid, w) as n from windows) where n > 1
), covered as (
  select rid, count(distinct i + k) as n from again, (select unnest(range(0, 8)) as k) group by rid
), measured as (
  select doc_id, t, words, lines,
    len(words)::bigint as n_words,
    length(array_to_string(words, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words
  from parts left join covered using (rid)
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed
    or 5 * n_symbols > n_words
    or 10 * n_dup_lines > 4 * len(lines)
    or word_chars > 15 * n_words or word_chars < 2 * n_words
    or 2 * (length(t) - length(replace(t, '!', ''))) > n_words
    or 10 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) > 4 * word_chars
    or (n_words >= 2
      and 2 * len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) > n_words)
  ) as kept
from judged
"""


def license_sql() -> str:
    """Every rule is one step of a chain: its sequence is counted and taken away."""
    known = licenses.sentence_ids()
    cases = " ".join(f"when '{s}' then '<{i}>'" for s, i in known.items())
    steps, last = [], "marked"
    for number, (name, ids) in enumerate(licenses.rule_sequences()):
        lost = f"(length(rest) - length(replace(rest, '{ids}', '-')))"
        steps.append(
            f"step{number} as (select doc_id, ids, replace(rest, '{ids}', '-') as rest,"
            f" n + {lost} // {len(ids) - 1} as n,"
            f" case when {lost} > 0 then list_append(names, '{name}') else names end as names from {last})"
        )
        last = f"step{number}"
    return rf"""
with split as (
  select doc_id, list_filter(
    list_transform(regexp_split_to_array(coalesce(text, ''), '[.!?:]+[\x20\x09-\x0D]+|[\n\r]+'),
      lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') as sentences
  from documents
), joined as (
  select doc_id, regexp_replace(array_to_string(
    list_transform(sentences, lambda s: case s {cases} else '-' end), ''), '-+', '-', 'g') as ids
  from split
), marked as (
  select doc_id, ids, ids as rest, 0::bigint as n, []::varchar[] as names from joined
), {", ".join(steps)}
select doc_id, (length(ids) - length(replace(ids, '<', '')))::bigint as n_sentences,
  n::bigint as n_statements,
  array_to_string(list_sort(list_distinct(names)), ',') as licenses,
  case when contains(ids, '<') then ids else '' end as license_ids
from {last}
"""


LEXICAL_SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), held as (
  select rid, doc_id, terms, len(terms)::bigint as n from docs where len(terms) > 0
), corpus as (
  select count(*)::bigint as docs, sum(n)::bigint as length from held
), postings as (
  select rid, term, count(*)::bigint as tf from (select rid, unnest(terms) as term from held) group by all
), weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)::double))::bigint as w
  from postings, corpus group by term
), asked as (
  select row_number() over () as iid, item_id, list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as terms
  from (select distinct item_id, text from benchmark)
), scored as (
  select iid, item_id, rid, doc_id, 10 + 90 * n * docs // length as m,
    sum(w * (1000000000 * tf // (1000 * tf + 8 * (10 + 90 * n * docs // length))))::bigint as score
  from (select iid, item_id, unnest(terms) as term from asked)
    join postings using (term) join weights using (term) join held using (rid), corpus
  group by all
), ranked as (
  select *, row_number() over (partition by iid order by score desc, doc_id nulls last)::int as rank
  from scored where score > 0
)
select item_id, rank, doc_id, score, m from ranked where rank <= 10
"""


URL_SQL = r"""
with urls as (
  select row_number() over () as rid, page_id,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), split as (
  select rid, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from urls
), rules(verdict, host, path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fitting as (
  select rid, arg_max(rules.host || rules.path, length(rules.host || rules.path)) as rule,
    arg_max(verdict, length(rules.host || rules.path)) as ruled
  from split join rules on (split.host = rules.host or ends_with(split.host, '.' || rules.host))
    and starts_with(split.path, rules.path)
  group by rid
), sites as (
  select *, regexp_extract(host, '^(.+)\.[^.]*$', 1) as site from split left join fitting using (rid)
), votes as (
  select site, site <> '' and sum(case ruled when 'block' then 1 when 'allow' then -1 else 0 end) > 0 as listed
  from sites group by site
)
select page_id, host, path, rule,
  coalesce(ruled, case when listed then 'block' else 'allow' end) as verdict, listed
from sites join votes using (site)
"""


ORACLE: dict[str, str] = {
    "op5_quality_rules": QUALITY_SQL,
    "op9_license_scan": license_sql(),
    "op11_lexical_search": LEXICAL_SQL,
    "op13_url_filters": URL_SQL,
}
