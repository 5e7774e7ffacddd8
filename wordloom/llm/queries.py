"""One query per operator of this subpackage, over its whole tables, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import (
    decontaminate,
    hard_negatives,
    line_quality,
    near_dedup,
    personal_data,
    secret_scan,
    source_audit,
    source_mix,
    suffix_dedup,
    token_counts,
    token_planes,
    toxicity,
    url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op2_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.read_digests(*token_planes.write_blocks(table(spark, sf_dir, "documents")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


# The rules of the query: host, path, verdict.
URL_RULES = """
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM ({URL_RULES}) AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs, width=3, percent=85)


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents"))


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = source_mix.copies(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("n_copies")).alias("taken")
    return counted.select("doc_id", "size", "source_size", "target", taken)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label_col=label)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergences(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_benchmark_templates": op2_benchmark_templates,
    "op3_token_planes": op3_token_planes,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxic_segments": op5_toxic_segments,
    "op6_url_filter": op6_url_filter,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_line_quality": op8_line_quality,
    "op9_systematic_mix": op9_systematic_mix,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_personal_data": op13_personal_data,
}

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE: dict[str, str] = {
    "op6_url_filter": r"""
        WITH given AS (
            SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://')
                            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        split AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM given),
        rules(rhost, rpath, verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                   ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        places AS (SELECT DISTINCT host, path FROM split),
        best AS (
            SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                   arg_max(verdict, length(rhost || rpath)) AS verdict
            FROM places JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM split LEFT JOIN best USING (host, path)
    """,
    "op8_line_quality": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, 'null') AS host, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS tokens,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
        windows AS (
            SELECT row, i, tokens[i] || ' ' || tokens[i + 1] || ' ' || tokens[i + 2] AS w
            FROM (SELECT row, tokens, unnest(range(1, len(tokens) - 1)) AS i FROM d WHERE len(tokens) >= 3)),
        again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1),
        covered AS (
            SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY row),
        exploded AS (
            SELECT row, host, regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g') AS line,
                   len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
            FROM (SELECT row, host, unnest(lines) AS x FROM d)),
        common AS (SELECT host, line FROM exploded GROUP BY host, line HAVING count(DISTINCT row) > 20),
        lost AS (SELECT row, count(*) AS lines_lost, sum(words) AS words_lost FROM exploded JOIN common USING (host, line) GROUP BY row),
        counted AS (
            SELECT doc_id, len(tokens) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
                   len(lines) AS n_lines, coalesce(lines_lost, 0) AS n_boilerplate_lines,
                   (len(tokens) - coalesce(words_lost, 0))::BIGINT AS left_words
            FROM d LEFT JOIN covered USING (row) LEFT JOIN lost USING (row))
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND left_words >= 25 AND left_words >= 0.25::DOUBLE * n_words AS kept
        FROM counted
    """.replace("\\\\", "\\"),
    "op9_systematic_mix": f"""
        WITH sized AS (
            SELECT doc_id, source, {WORDS} AS size FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
            FROM sized GROUP BY source),
        capped AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM sources),
        levels AS (
            SELECT *, cap / weight AS ratio,
                   (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
                       ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (
                       ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM capped),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN level >= ratio THEN cap ELSE least(cap, weight * (
                       SELECT arg_min(level, ratio) FROM levels WHERE level < ratio)) END AS target
            FROM levels),
        ranked AS (
            SELECT doc_id, size, s.source, source_size, target, row_number() OVER (
                PARTITION BY s.source ORDER BY length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::INT,
                substr(md5(doc_id::VARCHAR), 1, 1), size, doc_id) AS rank,
                ('0x' || substr(md5('mix-1:' || coalesce('=' || s.source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               size::BIGINT * CASE WHEN source_size > 0 THEN floor(start + target / source_size * rank)
               - floor(start + target / source_size * (rank - 1)) ELSE 0 END::BIGINT AS taken
        FROM ranked
    """,
    "op12_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        e AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS total FROM e GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
        langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS size FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM e SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        sizes AS (
            SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS size FROM groups LEFT JOIN c USING (lang, source) GROUP BY ALL),
        whole AS (
            SELECT s.lang, s.source, term, coalesce(n, 0) AS n, total, langs.size AS lang_size, v,
                   1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (s.size + v) AS p
            FROM sizes s JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM whole a JOIN whole b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        every AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM (
                SELECT *, 1 + 1000000000::HUGEINT * (total + 1) // (lang_size + v) AS q FROM whole)
            WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value::BIGINT AS value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
        FROM every QUALIFY part = 'pair' OR rank <= 200
    """.replace("\\\\", "\\"),
}
