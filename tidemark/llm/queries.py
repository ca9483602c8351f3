"""One query per operator over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, decontaminate, divergence, group_matrix, html_main, mixing, neardup, packing, quality, quality_rules,
    resampling, url_rules, warc,
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation formatted, then read back from the formatted text alone."""
    planted = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'),"
        " (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"
    )
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    template = chat.Template()
    segments = chat.format_turns(turns.unionByName(planted), template)

    def read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        at, held = None, None

        def row() -> tuple:
            n, turns, chars, loss, size, state = held
            return at[0], n, turns.hexdigest(), chars, loss.hexdigest(), size, state in template.finals

        for batch in batches:
            out = []
            ids = batch["conv_id"].astype("object").where(batch["conv_id"].notna(), None)
            for c, s, a, b, state in zip(
                ids, batch["segment"], batch["loss_start"], batch["loss_end"], batch["state"]
            ):
                if at is None or c != at[0]:
                    if at is not None:
                        out.append(row())
                    at, held = (c,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, ""]
                role, text = template.read(s)
                trained = chat.unescape(s[a:b])
                held[0] += 1
                held[1].update(f"{role}\n{text}\n".encode())
                held[2] += len(trained)
                held[3].update(trained.encode())
                held[4] += len(s)
                held[5] = state
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
        if at is not None:
            yield pd.DataFrame([row()], columns=names).astype({"conv_id": "Int64"})

    return segments.mapInPandas(
        read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, valid boolean",
    )


def captures(spark: SparkSession, d: str) -> DataFrame:
    """Crawl records made from ``pages``: per page a response, a later revisit of it, and one record of its site's root."""
    pages = table(spark, d, "pages").filter("url IS NOT NULL").select(
        "page_id",
        "url",
        F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"')).alias("tag"),
        F.concat(F.regexp_extract("url", "^(.*?://[^/?#]*)", 1), F.lit("/")).alias("root"),
        F.concat(F.lit('"'), F.regexp_extract("url", "://[^/]*/([a-z]*)", 1), F.lit('"')).alias("root_tag"),
        F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin("0", "1", "2", "3").alias("first"),
    )
    field = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    record = lambda k, url, kind, status, *fields: F.struct(
        (F.col("page_id") * 3 + k).alias("record_id"),
        url.alias("url"),
        (F.col("page_id") * 3 + k).alias("ts"),
        kind.alias("kind"),
        status.alias("status"),
        F.array(*fields).alias("headers"),
    )
    first = F.col("first")
    records = F.array(
        record(0, F.col("url"), F.lit("response"), F.lit(200), field("ETag", F.col("tag")), field("Date", F.lit("a")), field("Content-Type", F.lit("text/html"))),
        record(1, F.concat("url", F.lit("#x")), F.lit("revisit"), F.lit(304), field("etag", F.concat(F.lit("W/"), "tag")), field("Date", F.lit("b")), field("Content-Type", F.lit("none"))),
        record(2, F.col("root"), F.when(first, "response").otherwise("revisit"), F.when(first, 200).otherwise(304), field("ETag", F.col("root_tag")), field("Age", F.col("page_id").cast("string"))),
    )
    return pages.select(F.explode(records).alias("r")).select("r.*")


def op2_warc_revisits(spark: SparkSession, d: str) -> DataFrame:
    """Revisits of pages and of site roots, each with its original."""
    lines = F.array_join(
        F.transform("headers", lambda h: F.concat(F.lower(h["name"]), F.lit(": "), h["value"])), "\n"
    )
    return warc.resolve_revisits(captures(spark, d)).select(
        "record_id", "canonical_url", "status", "original_id", lines.alias("headers")
    )


OP2_SQL = r"""
WITH p AS (SELECT page_id, url, '"' || md5(coalesce(html, '')) || '"' AS tag,
    regexp_extract(url, '^(.*?://[^/?#]*)', 1) || '/' AS root,
    '"' || regexp_extract(url, '://[^/]*/([a-z]*)', 1) || '"' AS root_tag,
    md5(url)[1] IN ('0', '1', '2', '3') AS first FROM pages WHERE url IS NOT NULL),
r AS (SELECT page_id * 3 AS record_id, url, true AS whole_response, tag AS etag,
    [{'n': 'etag', 'v': tag}, {'n': 'date', 'v': 'a'}, {'n': 'content-type', 'v': 'text/html'}] AS h FROM p
  UNION ALL SELECT page_id * 3 + 1, url || '#x', false, tag,
    [{'n': 'etag', 'v': 'W/' || tag}, {'n': 'date', 'v': 'b'}, {'n': 'content-type', 'v': 'none'}] FROM p
  UNION ALL SELECT page_id * 3 + 2, root, first, root_tag,
    [{'n': 'etag', 'v': root_tag}, {'n': 'age', 'v': CAST(page_id AS VARCHAR)}] FROM p),
w AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM r),
x AS (SELECT *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
    lower(regexp_extract(u, '^[^:/?]+://([^/?]*)', 1)) AS host,
    regexp_extract(u, '^[^:/?]+://[^/?]*([^?]*)', 1) AS path,
    array_to_string(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
      lambda q: NOT starts_with(q, 'utm_') AND q <> ''), '&') AS query FROM w),
c AS (SELECT *, CASE WHEN scheme = '' THEN u ELSE scheme || '://'
    || CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '')
         WHEN 'https' THEN regexp_replace(host, ':443$', '') ELSE host END
    || CASE path WHEN '' THEN '/' ELSE path END
    || CASE query WHEN '' THEN '' ELSE '?' || query END END AS canonical_url FROM x),
o AS (SELECT canonical_url AS page, record_id AS original_id, etag AS old, h AS stored FROM c WHERE whole_response),
m AS (SELECT c.*, o.original_id, o.old, o.stored, list_filter(h, lambda f: f.n <> 'content-type') AS fresh
  FROM c ASOF LEFT JOIN o ON c.canonical_url = o.page AND c.record_id > o.original_id WHERE NOT whole_response)
SELECT record_id, canonical_url,
  CASE WHEN original_id IS NULL THEN 'no_original' WHEN old = etag THEN 'resolved' ELSE 'mismatch' END AS status,
  CASE WHEN old = etag THEN original_id END AS original_id,
  CASE WHEN old = etag THEN array_to_string(list_transform(list_concat(
    list_filter(stored, lambda f: NOT list_contains(list_transform(fresh, lambda g: g.n), f.n)), fresh),
    lambda f: f.n || ': ' || f.v), chr(10)) END AS headers
FROM m
"""

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op3_url_filters(spark: SparkSession, d: str) -> DataFrame:
    """The verdict of the contract's rules on every page."""
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, verdict)")
    pages = table(spark, d, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH r(h, p, v) AS (VALUES {rows}),
u AS (SELECT row_number() OVER () AS k, page_id,
    CASE WHEN url LIKE '%://%' THEN translate(
      regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)
      ELSE '' END AS path FROM pages),
m AS (SELECT k, h || p AS rule, v, row_number() OVER (
      PARTITION BY k ORDER BY length(h) DESC, length(p) DESC) AS n
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (k)
""".replace("{rows}", ", ".join(str(r) for r in RULES))


def op4_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    """The main text of every page."""
    return html_main.extract_main_text(table(spark, d, "pages"))


def op5_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Links and components of vectors with one label and a cosine of 0.98."""
    return neardup.near_duplicates(table(spark, d, "embeddings"))


def op6_sharding(spark: SparkSession, d: str) -> DataFrame:
    """All documents packed into shards of near equal bytes, words and rows."""
    return packing.pack_shards(table(spark, d, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Words that the mix takes of every document, in all and by output shard."""
    shards = 8
    docs, draws = mixing.mix_sources(table(spark, d, "documents"), shards=shards)
    by_shard = [F.sum(F.when(F.col("shard") == k, F.col("words")).otherwise(0)) for k in range(shards)]
    taken = draws.groupBy("row").agg(F.sum("words").alias("words"), F.array(*by_shard).alias("by_shard"))
    return docs.join(taken, "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("by_shard", F.array_repeat(F.lit(0).cast("long"), shards)).alias("taken_by_shard"),
    )


def op8_quality(spark: SparkSession, d: str) -> DataFrame:
    """A quality score for every document, learned from the labels that are not held out."""
    return quality.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


def op9_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of 0.85 of their 4-word shingles."""
    return group_matrix.similar_documents(table(spark, d, "documents"), 4, 85)


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items in documents, up to a fifth of their words edited."""
    return decontaminate.find_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op11_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the documents, drawn by how like the benchmark their words are."""
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


OP11_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS step),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT k, unnest(w) AS word FROM d),
bw AS (SELECT unnest(w) AS word FROM b),
every AS (SELECT word FROM dw UNION SELECT word FROM bw),
hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(word)),
    lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, x: xor(c // 256, step[(xor(c, x) % 256) + 1])), 4294967295) % 10000 AS bucket FROM every, crc),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT range AS bucket FROM range(10000)) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (SELECT k, sum(gain)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY k),
scored AS (SELECT k, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (k)),
ranked AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, n_features, k) AS r
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN r <= (SELECT count(*) FROM ranked) * 10 // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (k)
"""


def op12_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """The base rules, and rules with cutoffs that the labels certify, on every document."""
    return quality_rules.judge_quality(table(spark, d, "documents"), table(spark, d, "labels")).withColumn(
        "failed_rules", F.array_join("failed_rules", " ")
    )


def op12_sql(alpha: float = 0.02, delta: float = 0.05) -> str:
    """Statistics, exact binomial tests and verdicts in SQL, at the given risks."""
    levels = ", ".join(
        f"CASE WHEN {r.denominator} > 0 THEN len(list_filter({list(r.cutoffs)}::BIGINT[], lambda c: "
        f"{r.scale} * {r.numerator} {'<=' if r.below else '>='} c * {r.denominator})) ELSE 0 END"
        for r in quality_rules.RULES
    )
    cutoffs = [(i, j, len(r.cutoffs)) for i, r in enumerate(quality_rules.RULES) for j in range(len(r.cutoffs))]
    part = alpha / len(quality_rules.RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT k, unnest(range(1, len(words) - 6)) AS p, words FROM w WHERE len(words) >= 8),
keyed AS (SELECT k, p, array_to_string(words[p:p + 7], ' ') AS shown FROM windows),
twice AS (SELECT k, p FROM keyed QUALIFY count(*) OVER (PARTITION BY k, shown) > 1),
covered AS (SELECT k, sum(least(8, coalesce(next - p, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT k, p, lead(p) OVER (PARTITION BY k ORDER BY p) AS next FROM twice) GROUP BY k),
s AS (SELECT k, doc_id, stratum, len(words)::BIGINT AS n_words,
    list_sum(list_transform(words, lambda x: length(x)))::BIGINT AS some_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper
  FROM w LEFT JOIN covered USING (k)),
f AS (SELECT * EXCLUDE (some_chars), coalesce(some_chars, 0) AS word_chars,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s),
l AS (SELECT *, [{levels}] AS levels FROM f),
trials AS (SELECT stratum, levels, CASE WHEN quality <> 0 THEN 1 ELSE 0 END AS good FROM l JOIN labels USING (doc_id)
  WHERE NOT base_failed AND quality IS NOT NULL),
c(rule, j, size) AS (VALUES {", ".join(map(str, cutoffs))}),
tried AS (SELECT stratum, rule, j, sum(good)::BIGINT AS g, sum(1 - good)::BIGINT AS b,
    sum(good * hit)::BIGINT AS gr, sum((1 - good) * hit)::BIGINT AS br
  FROM (SELECT stratum, rule, j, good, CASE WHEN levels[rule + 1] >= size - j THEN 1 ELSE 0 END AS hit FROM trials, c)
  GROUP BY ALL),
tested AS (SELECT *, CASE WHEN gr >= {part!r} * g THEN 1 ELSE list_sum(list_transform(range(0, gr + 1), lambda i:
      exp(lgamma(g + 1) - lgamma(i + 1) - lgamma(g - i + 1) + i * ln({part!r}) + (g - i) * ln({1 - part!r})))) END
    <= {delta!r} / ((SELECT count(DISTINCT stratum) FROM trials) * {len(quality_rules.RULES)}) AS passes,
    br::DOUBLE * g - gr::DOUBLE * b AS benefit FROM tried),
certified AS (SELECT stratum, rule, j FROM tested
  QUALIFY bool_and(passes) OVER (PARTITION BY stratum, rule ORDER BY j)),
chosen AS (SELECT stratum, rule, j FROM certified JOIN tested USING (stratum, rule, j) WHERE benefit > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY benefit DESC, j) = 1),
failed AS (SELECT k, string_agg(rule, ' ' ORDER BY rule) AS failed_rules
  FROM l JOIN chosen USING (stratum) JOIN c USING (rule, j) WHERE levels[rule + 1] >= size - j GROUP BY k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(failed_rules, '') AS failed_rules, NOT base_failed AND failed_rules IS NULL AS kept
FROM l LEFT JOIN failed USING (k)
"""


def op13_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    """Terms that set each source apart from its language, and its distance to the other sources."""
    return divergence.audit_sources(table(spark, d, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents),
w AS (SELECT k, lang, source, unnest(list_transform(found, lambda x: translate(x,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total,
    coalesce((SELECT sum(n) FROM held AS h WHERE h.lang = g.lang AND h.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) AS g LEFT JOIN langs USING (lang)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // (total + 5 * v) AS p,
    1 + (1000000000 * (lang_n + 5)::HUGEINT) // (lang_total + 5 * v) AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN held USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum(abs(x.p - y.p)) FROM p AS x JOIN p AS y USING (lang, term)
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source)
SELECT lang, source, 'pair' AS part, item, value,
  (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', term, (p - q)::BIGINT, (row_number() OVER (
    PARTITION BY lang, source ORDER BY p - q DESC, term))::INT AS r
FROM p WHERE n > 0 AND p > q QUALIFY r <= 50
"""


QUERIES = {
    "op1_chat_formatting": (op1_chat_formatting, None),
    "op2_warc_revisits": (op2_warc_revisits, OP2_SQL),
    "op3_url_filters": (op3_url_filters, OP3_SQL),
    "op4_html_extraction": (op4_html_extraction, None),
    "op5_embedding_near_dedup": (op5_embedding_near_dedup, None),
    "op6_sharding": (op6_sharding, None),
    "op7_mixing": (op7_mixing, None),
    "op8_quality": (op8_quality, None),
    "op9_ngram_jaccard": (op9_ngram_jaccard, None),
    "op10_decontamination": (op10_decontamination, None),
    "op11_importance_resampling": (op11_importance_resampling, OP11_SQL),
    "op12_quality_rules": (op12_quality_rules, op12_sql()),
    "op13_source_divergence": (op13_source_divergence, OP13_SQL),
}
