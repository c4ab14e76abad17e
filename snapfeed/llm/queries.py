"""The registered queries of the training-data operators, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, decontaminate, hosts, langid, lattice, lines, merkle, pii, quality, simhash, tokencount, variants, warc
from .common import fresh_path, prepare, table


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers; never copied into this package."""
    import public_tokenizers

    return public_tokenizers.path(name)


RULES = [
    hosts.Rule("allow", "org", "/"), hosts.Rule("block", "example.org", "/es/"), hosts.Rule("block", "example.org", "/en/1"),
    hosts.Rule("allow", "com", "/fr/"), hosts.Rule("block", "com", "/de/"),
]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of ``documents`` against ``benchmark``: passages with 0.8 of an item's five-word shingles."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.judge(docs, items, least=0.8).withColumnRenamed("key", "doc_id")


def op2_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each url of ``pages``, with the pages in ``labels`` (by id) as outcomes: bad if of low quality or toxic."""
    pages = table(prepare(spark), sf_dir, "pages", "page_id", "url")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return hosts.judge(pages, labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), RULES).select(
        F.col("key").alias("page_id"), "host", "path", "rule", "verdict",
        F.round("bad_share", 4).alias("bad_share"), F.round("bad_bound", 4).alias("bad_bound"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of ``documents``: 4-word shingles, 4 bits."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs, k=4, max_bits=4).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in ``documents``, and the terms that disclose over 0.8 of an entity's information content in three or more distinct
    texts, marked wherever they stand."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return pii.find(docs, threshold=0.8, least_texts=3).select(
        F.col("key").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.all_spans().alias("spans"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts of ``documents``, against a limit of 512."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return tokencount.token_counts(docs, tokenizer_path("byte_bpe_50k.json")).select(
        F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of ``documents``, learnt from those that are not held out (5,000 of each language at most)."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), most_per_language=5000)
    return langid.predict(docs, model).select(
        F.col("key").alias("doc_id"), langid.held_out(F.col("key")).alias("held_out"), "lang_pred", "score")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the lines that repeat an earlier one, up to a Jaccard similarity of 0.8."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return lines.dedup(docs, least=0.8, counts=("n_lines", "n_kept"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as archives without repeated payloads, and what reading them back gives for each page."""
    pages = table(prepare(spark), sf_dir, "pages", "page_id", "url", "html")
    path = fresh_path(spark, "warc")
    warc.write(warc.records(pages), path)
    return warc.resolve(warc.read(spark, path)).select(
        F.col("key").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.col("refers_to_key").alias("refers_to"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of ``documents`` and of their edited texts."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return merkle.compare_with_next(docs).withColumnRenamed("key", "doc_id")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two segmentations of each of ``documents``, sampled without replacement, as piece ids, and the text each decodes to."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    path = tokenizer_path("piece_bpe_32k.model")
    return lattice.encode(docs, path, k=2, verify=True).withColumnRenamed("key", "doc_id")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` by the base rules and by trees grown on the labelled ones (20,000 at most): kept from a score of 0.5 on."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    forest = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), most=20_000)
    return quality.judge(docs, forest, least=0.5).select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("score", 4).alias("score"))


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters of ``documents`` in all orders: what each step removes, by language."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text", "lang")
    return audit.audit(audit.masks(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` with at least 7 letters and 2 occurrences, their near words, forms and roots."""
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return variants.group(variants.vocabulary(docs), times=10).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_hosts": op2_hosts,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_tokens": op5_tokens,
    "op6_language": op6_language,
    "op7_lines": op7_lines,
    "op8_warc": op8_warc,
    "op9_merkle": op9_merkle,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_quality": op11_quality,
    "op12_audit": op12_audit,
    "op13_variants": op13_variants,
}

def _level(name: str, members: str) -> str:
    """SQL of one level of the host posterior: ``members`` has (name, n, bad, prior)."""
    return f"""
{name}_rows AS ({members}),
{name}_sums AS (SELECT sum(n) AS n, sum(n * pow(bad / n - prior, 2)) AS spread, sum(prior * (1 - prior)) AS chance,
                       sum(n * prior * (1 - prior)) AS most FROM {name}_rows WHERE n > 0),
{name}_strength AS (SELECT CASE WHEN coalesce(n, 0) = 0 THEN 1.0 WHEN most = 0 OR spread <= chance THEN {hosts.STRONGEST}
                       ELSE least({hosts.STRONGEST}, greatest(1.0, most / (spread - chance) - 1)) END AS s FROM {name}_sums),
{name}s AS (SELECT {name}_rows.*, s, (prior * s + bad) / (s + n) AS mean FROM {name}_rows, {name}_strength)"""


def _hosts_sql() -> str:
    doubles = ", ".join(f"'{x}'" for x in hosts.DOUBLE_SUFFIXES)
    ordered = sorted(RULES, key=lambda r: (len(r.text), r.text), reverse=True)
    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in ordered]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r.text}'" for c, r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{r.verdict}'" for c, r in fits) + " WHEN bound > 0.3 THEN 'block' ELSE 'allow' END"
    return f"""
WITH urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{hosts.UPPER}', '{hosts.LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
counted AS (
  SELECT host, count(quality = 0 OR toxic = 1)::DOUBLE AS n, (count(*) FILTER (quality = 0 OR toxic = 1))::DOUBLE AS bad
  FROM urls LEFT JOIN labels ON doc_id = page_id GROUP BY host),
labelled AS (SELECT *, string_split(host, '.') AS l FROM counted),
domained AS (
  SELECT host, n, bad, array_to_string(l[-(CASE WHEN array_to_string(l[-2:], '.') IN ({doubles}) THEN 3 ELSE 2 END):], '.') AS domain FROM labelled),
named AS (SELECT *, CASE WHEN contains(domain, '.') THEN domain[strpos(domain, '.') + 1:] ELSE domain END AS suffix FROM domained),
{_level("suffix", "SELECT suffix AS name, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM named) AS prior FROM named GROUP BY suffix")},
{_level("domain", "SELECT domain AS name, sum(named.n) AS n, sum(named.bad) AS bad, any_value(mean) AS prior FROM named JOIN suffixs ON suffixs.name = suffix GROUP BY domain")},
{_level("host", "SELECT host AS name, named.n, named.bad, mean AS prior FROM named JOIN domains ON domains.name = domain")},
judged AS (
  SELECT page_id, host, path, mean, mean - 1.645 * sqrt(mean * (1 - mean) / (s + n + 1)) AS bound FROM urls JOIN hosts ON hosts.name = host)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, round(mean, 4) AS bad_share, round(bound, 4) AS bad_bound FROM judged"""


WARC_SQL = f"""
WITH hashed AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
digested AS (
  SELECT page_id, url, strlen(payload)::BIGINT AS payload_bytes,
         array_to_string(list_transform(range(8), lambda i: translate(to_base(('0x' || substr(h, (i * 5 + 1)::INT, 5))::BIGINT, 32, 4),
           '{warc.DIGITS}', '{warc.BASE32}')), '') AS payload_digest FROM hashed),
ordered AS (
  SELECT *, row_number() OVER w AS turn, first_value(page_id) OVER w AS of
  FROM digested WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN turn = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN turn > 1 THEN of END AS refers_to FROM ordered"""

_STEPS = ", ".join(f"('{order}', {step}, {bit}, {before})" for order, step, _, bit, before in audit.steps())
AUDIT_SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
named AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(min(texts.doc_id) OVER (PARTITION BY t) < texts.doc_id, false)::INT AS mask
  FROM texts LEFT JOIN named ON named.doc_id = texts.doc_id),
counted AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM masked GROUP BY part, mask),
steps(filter_order, step, bit, before) AS (VALUES {_STEPS}),
found AS (
  SELECT part, filter_order, step::INT AS step, bit, sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN g ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN x ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM found"""

#: The other operators - fingerprint components, token merges, fitted models, fuzzy groups, trees, lattices - have
#: no SQL form; the tests hold them against brute force.
SQL: dict[str, str] = {
    "op2_hosts": _hosts_sql(),
    "op8_warc": WARC_SQL,
    "op12_audit": AUDIT_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
