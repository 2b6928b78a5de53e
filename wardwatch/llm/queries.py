"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_work_dir
from .common import table
from . import embedding_dedup
from .decontaminate import contaminations
from .license_scan import TEMPLATES, scan_licenses
from .periodic_runs import WORD, greatest_run, periodic_runs
from .quality import score_documents
from .secret_scan import secret_report
from .sentencepiece_codec import encode_and_decode
from .shuffle_shards import read_shards as read_shuffled, write_shards as write_shuffled
from .simhash import near_duplicates
from .substring_dedup import dedup_substrings
from .token_shards import document_index, read_shards, write_shards
from .url_filter import judge_urls
from .whitening import whiten

# fixed values of the url rules: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's vocabulary on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` have no paths and no licence files: the digits of the id are taken as
    directories below the source, and every document that states a licence declares it."""
    digits = F.array_join(F.split(F.col("doc_id").cast("string"), ""), "/")
    files = table(spark, sf_dir, "documents").withColumn("path", F.concat_ws("/", "source", digits))
    return scan_licenses(files, all_declare=True)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_dir(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return document_index(read_shards(spark, path))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_substrings(table(spark, sf_dir, "documents"), window=13)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text in ten, by h = crc32 of the id, has its words from a on replaced by repetitions of p words.

    g = h div 10, a = g mod n, p = 1 + (n - a) div (3 + g mod 8) of its n words; a NULL id has no h, and nothing is replaced.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    a = F.pmod("g", n).cast("int")
    p = F.floor((n - F.col("a")) / (F.pmod("g", F.lit(8)) + 3)).cast("int") + 1
    rows = rows.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), n - F.col("a"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                               r["period"].cast("string")), F.lit("\n")))
    best = greatest_run(F.col("runs"))
    found = found.select("doc_id", "kept", F.size("runs").cast("long").alias("n_runs"), F.array_join(lines, "").alias("lines"), best.alias("best"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
                        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), new_work_dir(spark, "shuffled-shards")
    write_shuffled(docs, path, shards=16)
    return read_shuffled(spark, path, docs).select("doc.doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_quality": op5_quality,
    "op6_token_shards": op6_token_shards,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_sharding": op13_sharding,
}


def _spans_sql(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """The spans of one kind: lengths of the text between matches and of the matches add up to positions."""
    p = pattern.replace("'", "''")
    return f"""
        SELECT uid, {order} AS ord, '{kind}' AS kind, stop - len(m) AS start, stop
        FROM (SELECT uid, m, part, sum(len(b) + len(m)) OVER (PARTITION BY uid ORDER BY i) AS stop
              FROM (SELECT uid, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(ps) AS part, unnest(bs[:len(ms)]) AS b
                    FROM (SELECT uid, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {group}) AS ps,
                                 string_split_regex(t, '{p}') AS bs
                          FROM d WHERE regexp_matches(t, '{p}')))
        ) WHERE len(part) >= {least}"""


# fixed values of the secret rules, restated: kind, pattern, group, least length
_WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                  for w in ("password", "passwd", "secret", "token", "api_?key"))
_SECRETS = [("assign", "(" + _WORDS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24),
            ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40), ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1)]
_ALL_SPANS = "\n        UNION ALL".join(_spans_sql(k, i, p, g, n) for i, (k, p, g, n) in enumerate(_SECRETS))

# fixed values: the licence notices, restated
_NOTICES = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))

ORACLES: dict[str, str] = {
    "op4_license_scan": f"""
        WITH templates(k, license, notice) AS (VALUES {_NOTICES}),
        d AS (SELECT row_number() OVER () AS uid, doc_id, concat_ws('/', source, array_to_string(string_split(CAST(doc_id AS VARCHAR), ''), '/')) AS path,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        lines AS (SELECT row_number() OVER () AS unit, uid, x FROM (SELECT uid, unnest(string_split(t, chr(10))) AS x FROM d)),
        units AS (SELECT unit, uid, x FROM lines UNION ALL
                  SELECT -row_number() OVER (), uid, x FROM (SELECT uid, unnest(string_split_regex(t, '\\n[ \\t\\r]*\\n')) AS x FROM d)),
        template_terms AS (SELECT k, term, count(*) AS tf FROM (
            SELECT k, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+')) AS term FROM templates) GROUP BY k, term),
        unit_terms AS (SELECT unit, uid, term, count(*) AS tf FROM (
            SELECT unit, uid, unnest(regexp_extract_all(x, '[a-z0-9]+')) AS term FROM units) GROUP BY unit, uid, term),
        n AS (SELECT count(*) AS n FROM lines),
        lines_with AS (SELECT term, count(*) AS held FROM unit_terms WHERE unit > 0 GROUP BY term),
        idf AS (SELECT term, ln((1 + n) / (1 + coalesce(held, 0))) + 1 AS idf
                FROM (SELECT term FROM template_terms UNION SELECT term FROM lines_with) LEFT JOIN lines_with USING (term) CROSS JOIN n),
        unit_weights AS (SELECT unit, uid, term, tf * idf AS w FROM unit_terms JOIN idf USING (term)),
        template_weights AS (SELECT k, term, tf * idf AS w FROM template_terms JOIN idf USING (term)),
        cosines AS (
          SELECT uid, k, round(sum(u.w * t.w) / sqrt(any_value(nu.s) * any_value(nt.s)), 9) AS score
          FROM unit_weights u JOIN template_weights t USING (term)
          JOIN (SELECT unit, sum(w * w) AS s FROM unit_weights GROUP BY unit) nu USING (unit)
          JOIN (SELECT k, sum(w * w) AS s FROM template_weights GROUP BY k) nt USING (k)
          GROUP BY uid, unit, k),
        best AS (SELECT uid, k, score FROM cosines WHERE score >= 0.6
                 QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, k) = 1),
        own AS (SELECT d.doc_id, path, license, coalesce(score, 0.0) AS score, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir
                FROM d LEFT JOIN best USING (uid) LEFT JOIN templates USING (k)),
        declared AS (SELECT dir AS declared_in, license AS inherited FROM own WHERE license IS NOT NULL GROUP BY dir, license
                     QUALIFY row_number() OVER (PARTITION BY dir ORDER BY count(*) DESC, license) = 1),
        nearest AS (SELECT dir, declared_in, inherited FROM (SELECT DISTINCT dir FROM own)
                    JOIN declared ON (dir = declared_in OR declared_in = '' OR starts_with(dir, declared_in || '/'))
                    QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(declared_in) DESC) = 1)
        SELECT doc_id, path, coalesce(license, inherited) AS license, score,
               CASE WHEN license IS NULL THEN declared_in END AS declared_in
        FROM own LEFT JOIN nearest USING (dir)
    """,
    "op2_secret_scan": f"""
        WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t FROM documents),
        spans AS ({_ALL_SPANS}),
        per AS (
          SELECT uid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 3) AS base,
                 string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
          FROM spans GROUP BY uid)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN per USING (uid)
    """,
    "op10_url_filter": r"""
        WITH rules(rule_host, rule_path, rule, rule_verdict) AS (
          VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
                 ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
        cut AS (
          SELECT page_id, row_number() OVER () AS uid,
                 CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
          FROM pages),
        parts AS (
          SELECT page_id, uid,
                 translate(regexp_extract(rest, '^([^/?#]*)', 1),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM cut),
        fits AS (
          SELECT uid, rule, rule_verdict,
                 row_number() OVER (PARTITION BY uid ORDER BY length(rule_host || rule_path) DESC) AS place
          FROM parts JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM parts LEFT JOIN fits ON fits.uid = parts.uid AND place = 1
    """,
}
