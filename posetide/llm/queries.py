"""The registered queries of this subpackage, one an operator."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kd_shards as shards
from . import (language_filters, masked_lm, near_dups, piece_encoding, quality_lines, quartile_digest, repeated_passages, secret_scan,
               slack_packing, token_alignment, url_rules, word_runs)
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_line_frequency")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.quality(documents(spark, sf_dir))


@query("op2_quartile_digest")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.edit_check(documents(spark, sf_dir))


@query("op4_slack_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack_packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]

OP5_SQL = """
with rules(rhost, rpath, rverdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts as (select page_id, url,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
sites as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
best as (select host, path, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(rverdict, length(rhost || rpath)) as verdict
  from (select distinct host, path from sites) s join rules
    on (s.host = rhost or ends_with(s.host, '.' || rhost)) and starts_with(s.path, rpath) group by host, path)
select s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') as verdict
from sites s left join best b on s.host = b.host and s.path = b.path
"""


@query("op5_url_rules", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op6_piece_encoding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = piece_encoding.encoded(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                      F.sha2(F.concat_ws("|", F.array_join("starts", ","), F.array_join("ends", ",")).cast("binary"), 256).alias("spans_sha256"))


@query("op7_kd_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.kd_shards(documents(spark, sf_dir), ["source", "lang", "n_chars"], shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir))


@query("op9_bottom_k_near_dups")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(documents(spark, sf_dir))


@query("op10_repeated_passages")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.removals(documents(spark, sf_dir))


@query("op3_masked_lm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.scores(documents(spark, sf_dir))


@query("op11_language_filters")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_filters.identified(documents(spark, sf_dir))


@query("op12_diagonal_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.alignments(documents(spark, sf_dir).select("doc_id", "text"),
                                         tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    out = token_alignment.link_counts(aligned.select("doc_id", "n_a", "n_b", digest.alias("groups_sha256"), "links", "times"))
    return out.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; each tenth text (by the checksum of its id) repeats a
    stretch of its words up to its end. A null id counts as none of these."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def plant(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, code in enumerate(batch.column(2).to_pylist()):
                words = (texts[i] or "").encode().split() if code is not None and code % 10 == 0 else []
                if words:
                    g = code // 10
                    a = g % len(words)
                    p = 1 + (len(words) - a) // (3 + g % 8)
                    words[a:] = [words[a + k % p] for k in range(len(words) - a)]
                    texts[i] = b" ".join(words).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", "text", h.alias("_code")).mapInArrow(plant, f"doc_id {dict(docs.dtypes)['doc_id']}, text string")


@query("op13_word_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    # runs come by start and period, so the first of equal exponents is the one asked for
    best = F.reduce("runs", F.expr("cast(null as struct<start: bigint, length: bigint, period: bigint>)"),
                    lambda old, new: F.when(old.isNull() | (new["length"] * old["period"] > old["length"] * new["period"]), new).otherwise(old))
    written = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(written, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
