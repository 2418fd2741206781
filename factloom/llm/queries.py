"""The corpus operators over the test tables: one query each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.session import table

from .decontaminate import contaminated
from .lines import dedup_lines
from .neighbours import nearest
from .packing import pack_documents
from .pseudonyms import pseudonymise_documents
from .quality import fit_quality, score_quality
from .sharding import shuffle_into_shards
from .simhash import simhash_groups
from .suffixes import repeated_passages
from .urls import judge_urls

#: (verdict, host, path) as the URL contract states them.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_shard_hypergeometric(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """All documents in shards 0 to 7 by the law ``rows``: counts are at most one apart."""
    placed = shuffle_into_shards(table(spark, sf_dir, "documents"), shards)
    text = F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_pack_best_fit(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary or public_vocabulary())


def op3_neighbours_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all embeddings for every fiftieth one."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_repeats_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that another document holds too."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op5_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learnt from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


def op6_decontaminate_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item; other documents have no row."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict for every page's url."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_pii_feistel(spark: SparkSession, sf_dir: str, key: bytes = b"factloom test key") -> DataFrame:
    """Every document with its pseudonymised text; a deployment sets its own key as ``spark.factloom.pseudonymKey``."""
    key = spark.conf.get("spark.factloom.pseudonymKey", "").encode() or key
    done = pseudonymise_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return done.select("doc_id", "text", (F.size("found") > 0).alias("changed"), F.size("found").cast("int").alias("n_found"))


def op9_line_dedup_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one, and the numbers of those lines."""
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), least_equal=1)
    return done.select("doc_id", "text", "removed", F.size("removed").cast("int").alias("n_removed"))


def op10_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def url_oracle() -> str:
    """The same rules as plain string comparisons."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return rf"""
WITH rules(verdict, rhost, rpath) AS (VALUES {rules}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parts, rules WHERE (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)"""


QUERIES = {
    "op1_shard_hypergeometric": op1_shard_hypergeometric,
    "op2_pack_best_fit": op2_pack_best_fit,
    "op3_neighbours_additive": op3_neighbours_additive,
    "op4_repeats_suffix_array": op4_repeats_suffix_array,
    "op5_quality_neighbours": op5_quality_neighbours,
    "op6_decontaminate_templates": op6_decontaminate_templates,
    "op7_url_automaton": op7_url_automaton,
    "op8_pii_feistel": op8_pii_feistel,
    "op9_line_dedup_segments": op9_line_dedup_segments,
    "op10_simhash_pigeonhole": op10_simhash_pigeonhole,
}

ORACLES = {"op7_url_automaton": url_oracle()}
