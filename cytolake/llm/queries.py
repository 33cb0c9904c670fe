"""The queries op1 to op13 with their production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids, one row per piece."""
    from .packing import pack_documents

    return pack_documents(documents(spark, sf_dir), vocabulary())


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards of 2048-id records in a keyed order, one row per record."""
    from .shards import materialise_order

    return materialise_order(documents(spark, sf_dir), vocabulary())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document; fitted on at most 4000 labelled ones."""
    from .toxicity import judge

    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a benchmark item in a document."""
    from .decontamination import find_leaks

    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a document near a licence template."""
    from .licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model of six in seven of them."""
    from .language_model import score_corpus

    return score_corpus(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that a document shares with one of a smaller id."""
    from .substring_dedup import repeated_passages

    return repeated_passages(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    from .near_dedup import near_duplicates

    return near_duplicates(documents(spark, sf_dir))


#: The contract's rules (fixed values): verdict, host and path prefix. No block list comes with the tables; hosts with these labels make one.
URL_RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page."""
    from .url_filter import filter_urls, hosts_named

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages, URL_RULES, hosts_named(pages, BLOCKED_NAMES))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from each other one of its language, and its 200 most over-used terms."""
    from .divergence import audit_sources

    return audit_sources(documents(spark, sf_dir))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language among those found 100 times or more."""
    from .phrases import strongest_phrases

    return strongest_phrases(documents(spark, sf_dir))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by a byte-level vocabulary and the text behind them, as counts and hashes."""
    import public_tokenizers

    from .bpe import digests, round_trip

    return digests(round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line labels and base rules for every document; fitted on at most 3000 labelled ones."""
    from .quality import judge_quality, train_field

    docs = documents(spark, sf_dir)
    return judge_quality(docs, train_field(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")))


def _op8_sql() -> str:
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES)
    names = ", ".join(f"'{n}'" for n in BLOCKED_NAMES)
    return f"""
        WITH parts AS (
            SELECT page_id, url,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        rules (verdict, rule, rule_host, rule_path) AS (VALUES {rules}),
        judged AS (
            SELECT page_id, host, path, len(list_intersect(string_split(host, '.'), [{names}])) > 0 AS listed,
                   (SELECT arg_max(struct_pack(rule := rule, verdict := verdict), length(rule)) FROM rules
                    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS found
            FROM parts)
        SELECT page_id, host, path, found.rule AS rule, coalesce(found.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
        FROM judged"""


def _op11_sql() -> str:
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    chance = "CAST(1 + (1000000000 * (CAST({c} AS HUGEINT) + 1)) // ({n} + v) AS HUGEINT)"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        hits AS (SELECT d, lang, source, unnest(regexp_extract_all(translate(text, {lower}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS c FROM hits GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
        langs AS (SELECT lang, count(term) AS v, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
        found AS (SELECT lang, source, term, count(*) AS c FROM hits JOIN kept USING (lang, term) GROUP BY lang, source, term),
        groups AS (SELECT lang, source, v, n AS lang_n, coalesce(m, 0) AS m FROM (SELECT DISTINCT lang, source FROM docs) JOIN langs USING (lang)
                   LEFT JOIN (SELECT lang, source, sum(c) AS m FROM found GROUP BY lang, source) USING (lang, source)),
        cells AS (SELECT lang, source, term, coalesce(found.c, 0) AS c, {chance.format(c="coalesce(found.c, 0)", n="m")} AS p, {chance.format(c="kept.c", n="lang_n")} AS q
                  FROM groups JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
        pairs AS (SELECT x.lang, x.source, y.source AS item, coalesce(s, 0) AS value FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
                  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS s FROM cells a JOIN cells b USING (lang, term) GROUP BY ALL) t
                  ON t.lang = x.lang AND t.source = x.source AND t.item = y.source),
        terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM cells WHERE c > 0 AND p > q),
        ranked AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
        WHERE part = 'pair' OR rank <= 200"""


def _op12_sql() -> str:
    return """
        WITH pieces AS (
            SELECT lang, row_number() OVER () AS piece, words FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       unnest(list_transform(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'), lambda x: regexp_extract_all(x, '[^ \t]+'))) AS words
                FROM documents)
            WHERE len(words) > 0),
        counts AS (
            SELECT lang, phrase, count(*) AS f FROM (
                SELECT lang, unnest(list_transform(generate_series(1, CAST(len(words) - m + 1 AS BIGINT)), lambda i: list_slice(words, i, i + m - 1))) AS phrase
                FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS sizes (m) WHERE len(words) >= m)
            GROUP BY lang, phrase HAVING count(*) >= 100),
        totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
        candidates AS (SELECT lang, phrase, f AS a FROM counts WHERE len(phrase) >= 2),
        inner_phrases AS (
            SELECT lang, a, unnest(flatten(list_transform(generate_series(2, CAST(len(phrase) - 1 AS BIGINT)), lambda m: list_transform(generate_series(1, CAST(len(phrase) - m + 1 AS BIGINT)), lambda i: list_slice(phrase, i, i + m - 1))))) AS phrase
            FROM candidates WHERE len(phrase) > 2),
        longer AS (SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY lang, phrase),
        kept AS (SELECT lang, phrase, a FROM candidates LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
        cuts AS (SELECT lang, phrase, a, unnest(generate_series(1, CAST(len(phrase) - 1 AS BIGINT))) AS k FROM kept),
        scored AS (
            SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n, (1000 * CAST(c.a AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
            FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[:c.k] JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[c.k + 1:]
            JOIN totals t ON t.lang = c.lang),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score,
                     row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank FROM weakest)
        WHERE rank <= 2000"""


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filter": _op8_sql(), "op11_divergence": _op11_sql(), "op12_phrases": _op12_sql()}
