"""The registered queries ``opN_<name>`` of this subpackage and their SQL.

Each query applies its operator to the whole table it is meant for and
derives the columns of its contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tracknet.llm import alignment, bpe, hyperminhash, mixing, quality, quartile, runs, simhash, substring, token_counts, toxicity, url_filter, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ 1: URL filters

URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]
#: A page is reported, and its canonical url listed, with so many ``!!`` in its html.
REPORT_MARKS = 20


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page; the list holds the urls of shouting pages, so
    that every spelling of a listed url is blocked."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(F.regexp_count("html", F.lit("!!")) >= REPORT_MARKS).select("url")
    return url_filter.judge_urls(pages, listed, URL_RULES)


def _op1_sql() -> str:
    rules = sorted(URL_RULES, key=lambda r: -len(r.text))
    fits = "\n".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'" for r in rules)
    verdicts = "\n".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in rules)
    tracking = ", ".join(f"'{t}'" for t in url_filter.TRACKING)
    return f"""
WITH parts AS (
  SELECT page_id, html,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '^.*?://[^?#]*\\?([^#]*)', 1, 's'), '&'),
                               lambda p: p <> '' AND string_split(p, '=')[1] NOT IN ({tracking}))) AS query
  FROM pages),
canon AS (
  SELECT *, CASE WHEN regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') <> '' THEN
           regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
           || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical
  FROM parts),
listed AS (SELECT DISTINCT canonical FROM canon WHERE len(regexp_extract_all(html, '!!')) >= {REPORT_MARKS} AND canonical IS NOT NULL),
ruled AS (SELECT page_id, host, path, canonical, CASE {fits} END AS rule FROM canon)
SELECT page_id, host, path, rule,
       CASE {verdicts} WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict, canonical
FROM ruled
"""


# --------------------------------------------------------- 2: quality rules

def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.round("posterior", 4).alias("posterior"))


def _op2_sql() -> str:
    rules = quality.RULES
    start = quality.start_model()
    stop = ", ".join(f"'{w}'" for x in quality.STOP_WORDS for w in (x, x.capitalize()))
    digits = ", ".join(f"CASE WHEN {r.bad} THEN 0 WHEN {r.good} THEN 1 ELSE 2 END AS d{k}" for k, r in enumerate(rules))
    ds = ", ".join(f"d{k}" for k in range(len(rules)))
    weigh = " + ".join(
        f"CASE d{k} WHEN 0 THEN ln(g{k}0 / b{k}0) WHEN 1 THEN ln(g{k}1 / b{k}1) ELSE ln((1 - g{k}0 - g{k}1) / (1 - b{k}0 - b{k}1)) END"
        for k in range(len(rules)))
    p = f"1 / (1 + exp(-(ln(good / (1 - good)) + {weigh})))"
    first = ", ".join([f"CAST({start.good!r} AS DOUBLE) AS good"] + [
        f"CAST({rates[k][v]!r} AS DOUBLE) AS {side}{k}{v}" for side, rates in (("b", start.bad_rates), ("g", start.good_rates))
        for k in range(len(rules)) for v in (0, 1)])
    prior = quality.PRIOR_VOTES
    again = [f"(sum(n * p) + {prior}) / (sum(n) + {2 * prior}) AS good"]
    for k in range(len(rules)):
        for v in (0, 1):
            again.append(f"(sum(CASE WHEN d{k} = {v} THEN n * (1 - p) ELSE 0 END) + {prior}) / (sum(n * (1 - p)) + {3 * prior}) AS b{k}{v}")
            again.append(f"(sum(CASE WHEN d{k} = {v} THEN n * p ELSE 0 END) + {prior}) / (sum(n * p) + {3 * prior}) AS g{k}{v}")
    models = [f"m0 AS MATERIALIZED (SELECT {first})"]
    for r in range(quality.EM_ROUNDS):
        models.append(f"m{r + 1} AS MATERIALIZED (SELECT {', '.join(again)} FROM (SELECT *, {p} AS p FROM patterns, m{r}))")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]'), lambda x: x <> '') AS words
  FROM documents),
grams AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
repeated AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM (
      SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c >= 2)
  GROUP BY rid),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^ \\t-\\r]') GROUP BY rid),
stats AS (
  SELECT docs.rid, doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words, len(regexp_extract_all(text, '[A-Z]{{2,}}')) AS n_shouts,
         len(regexp_extract_all(text, '!')) AS n_marks, len(regexp_extract_all(text, '[|]')) AS n_bars,
         len(regexp_extract_all(text, '[.?!]')) AS n_stops, len(list_filter(words, lambda w: w IN ({stop}))) AS n_stop,
         len(string_split(text, chr(10))) AS n_lines
  FROM docs LEFT JOIN repeated ON repeated.rid = docs.rid LEFT JOIN lines ON lines.rid = docs.rid),
voted AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {digits} FROM stats),
patterns AS MATERIALIZED (SELECT {ds}, count(*) AS n FROM voted WHERE NOT base_failed GROUP BY {ds}),
{", ".join(models)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND p >= {quality.MIN_POSTERIOR} AS kept, round(p, 4) AS posterior
FROM (SELECT *, {p} AS p FROM voted, m{quality.EM_ROUNDS})
"""


# ------------------------------------------------------ 3: substring dedup

def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP3_SQL = """
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]'), lambda x: x <> '') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS s FROM starts),
repeats AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM repeats),
places AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p FROM docs),
kept AS (
  SELECT places.doc_id, string_agg(w, ' ' ORDER BY places.p) AS words, count(*) AS n
  FROM places ANTI JOIN gone ON gone.doc_id = places.doc_id AND gone.p = places.p GROUP BY places.doc_id)
SELECT docs.doc_id, len(docs.words) AS n_words, len(docs.words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON kept.doc_id = docs.doc_id
"""


# --------------------------------------------------------- 4: token counts

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary() -> tuple[str, str]:
    """Path and split pattern of the registered queries' vocabulary."""
    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), *vocabulary())


# ----------------------------------------------------------------- 5: WARC

def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives all pages, then reads every record back from the bundles."""
    folder, index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_bundles(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS size, sha1(html) AS hex FROM p),
b AS (SELECT *, CAST(unhex(hex) AS BIT)::VARCHAR AS bits, min(page_id) OVER (PARTITION BY hex, size) AS low FROM d)
SELECT page_id, size AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, 5 * i + j + 1, 1) AS INTEGER) * (16 >> j)))::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM b
"""


# ------------------------------------------------ 6: MinHash near-duplicates

def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


OP6_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[ \\t-\\r]'), lambda x: x <> '') AS words FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(CASE WHEN len(words) >= 5 THEN range(1, len(words) - 3) WHEN len(words) > 0 THEN [1] ELSE [] END) AS i FROM docs)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT low.doc_id, coalesce(n, 0) AS n_shingles, component_id, low.doc_id = component_id AS kept
FROM low LEFT JOIN sizes ON sizes.doc_id = low.doc_id
"""


# ------------------------------------------------------- 7: toxicity

def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


# --------------------------------------------------- 8: byte-level BPE

def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), *vocabulary())


# ------------------------------------------------------- 9: fingerprints

def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile.compare_with_next(table(spark, sf_dir, "documents"))


# ------------------------------------------------------- 10: mixing

def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _op10_sql() -> str:
    cap, unit = mixing.CAP, mixing.UNIT
    weight = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % " + str(len(mixing.WEIGHTS)) + " " + " ".join(
        f"WHEN {k} THEN {w}" for k, w in enumerate(mixing.WEIGHTS)) + " END"
    hash32 = lambda x: f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"
    parts = ["l0 AS MATERIALIZED (SELECT CAST(sum(s) AS DOUBLE) / sum(w) AS level FROM sources)"]
    for k in range(1, 31):
        over = f"level * w > {cap} * s"
        parts.append(f"l{k} AS MATERIALIZED (SELECT coalesce(CAST(sum(s) - sum(CASE WHEN {over} THEN {cap} * s ELSE 0 END) AS DOUBLE) "
                     f"/ nullif(sum(CASE WHEN {over} THEN 0 ELSE w END), 0), max(level)) AS level FROM sources, l{k - 1})")
    steps = []
    for k in range(mixing.REPAIRS):
        may = f"((gap > 0 AND copies < {cap}) OR (gap < 0 AND copies > 0)) AND abs(size - abs(gap)) < abs(gap)"
        steps.append(f"""
gaps{k} AS (SELECT source, any_value(target) - sum(copies * size) AS gap FROM mix{k} GROUP BY source),
best{k} AS (
  SELECT rid, gap FROM (SELECT rid, gap, row_number() OVER (PARTITION BY m.source ORDER BY abs(size - abs(gap)), key, doc_id) AS k
  FROM mix{k} m JOIN gaps{k} g ON g.source IS NOT DISTINCT FROM m.source WHERE {may}) WHERE k = 1),
mix{k + 1} AS MATERIALIZED (
  SELECT m.* REPLACE (copies + CASE WHEN b.gap > 0 THEN 1 WHEN b.gap < 0 THEN -1 ELSE 0 END AS copies)
  FROM mix{k} m LEFT JOIN best{k} b ON b.rid = m.rid)""")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]'), lambda x: x <> '')) AS size FROM documents),
sources AS MATERIALIZED (SELECT source, CAST(s AS BIGINT) AS s, n, {weight} AS w FROM (SELECT source, sum(size) AS s, count(*) AS n FROM docs GROUP BY source)),
{", ".join(parts)},
goals AS MATERIALIZED (SELECT source, s, n, least(coalesce(level, 0) * w, CAST({cap} * s AS DOUBLE)) AS target FROM sources, l30),
rated AS (
  SELECT rid, doc_id, docs.source, size, s AS source_size, target, {hash32("coalesce(doc_id::VARCHAR, '')")} AS key,
         CAST(round(CASE WHEN target >= {cap} * s THEN {cap} ELSE target / s END * {unit}) AS BIGINT) AS part,
         {hash32("coalesce(doc_id::VARCHAR, '')")} % CAST(ceil(n / {float(mixing.GROUP)}) AS BIGINT) AS salt
  FROM docs JOIN goals ON goals.source IS NOT DISTINCT FROM docs.source),
summed AS (
  SELECT *, sum(part) OVER (PARTITION BY source, salt ORDER BY size DESC, key, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT
            + {hash32("'start|' || coalesce(source, '') || '|' || salt")} // 4 AS upto FROM rated),
mix0 AS MATERIALIZED (SELECT *, upto // {unit} - (upto - part) // {unit} AS copies FROM summed),
{", ".join(steps)}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mix{mixing.REPAIRS}
"""


# ----------------------------------------- 11: cross-tokenizer alignment

TOKENIZERS = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, TOKENIZERS))
    return aligned.withColumnRenamed("id", "doc_id")


# ------------------------------------------------------- 12: periodic runs

WORDS = r"[^\x20\x09-\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; about a tenth of the texts repeat a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORDS), F.lit(0))
    d = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10)) \
        .withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    a = F.col("g") % F.col("n")
    d = d.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", source(i).cast("int")))
    return d.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                        best["period"].alias("period"), F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# --------------------------------------------- 13: SimHash near-duplicates

def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def queries() -> dict[str, Query]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_quality_rules": op2_quality_rules,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_token_counts": op4_token_counts,
        "op5_warc": op5_warc,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_toxicity": op7_toxicity,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_fingerprints": op9_fingerprints,
        "op10_mixing": op10_mixing,
        "op11_alignment": op11_alignment,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_simhash": op13_simhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": _op1_sql(),
        "op2_quality_rules": _op2_sql(),
        "op3_substring_dedup": OP3_SQL,
        "op5_warc": OP5_SQL,
        "op6_near_duplicates": OP6_SQL,
        "op10_mixing": _op10_sql(),
    }
