"""Registered queries of the corpus operators, one per operator, each over
its whole table with production parameters. Where DuckDB can say the same,
``ORACLE`` has the SQL; the others are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bitplanes, decontam, langid, licenses, linededup,
               mainhtml, oddsketch, orc_ids, packing, pii, quality, sharding)
from .common import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PACK_TOKENIZER = "byte_bpe_50k.json"
ORC_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
SHARDS, SHARD_SEED = 16, 2026


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return keep


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("op1_packing")
def op1(spark, sf_dir):
    """Power-of-two pieces of every document."""
    pieces = packing.pack(documents(spark, sf_dir),
                          public_tokenizers.path(PACK_TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


@query("op5_sharding", f"""
SELECT documents.doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size,
  crc AS text_crc32, 'rows' AS law, shard, slot,
  CAST(NULL AS INTEGER) AS grown_shard, row_number
FROM documents
JOIN ({sharding.crc_sql("documents")}) USING (doc_id)
JOIN ({sharding.assign_sql("documents", SHARDS, SHARD_SEED)}) USING (doc_id)""")
def op5(spark, sf_dir):
    """Feistel shuffle of the row numbers into 16 shards."""
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
        .alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
        .alias("text_crc32"))
    return sharding.assign(
        docs, SHARDS, SHARD_SEED,
        [F.col("doc_id"), F.col("size"), F.col("text_crc32")]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


@query("op9_orc_ids")
def op9(spark, sf_dir):
    """Ids written as ORC in document order, then read back."""
    docs = documents(spark, sf_dir)
    path = orc_ids.write_ids(docs, scratch_path(spark, "token-orc"),
                             public_tokenizers.path(ORC_TOKENIZER))
    return orc_ids.positions(orc_ids.read_ids(
        spark, path, docs.schema["doc_id"].dataType))


@query("op6_line_dedup", linededup.drop_lines_sql("documents"))
def op6(spark, sf_dir):
    """Documents without the boilerplate lines of their source."""
    return linededup.drop_lines(documents(spark, sf_dir)).select(
        "doc_id", "source", "text", "n_lines", "n_dropped")


@query("op7_license_scan", licenses.scan_sql("documents"))
def op7(spark, sf_dir):
    """License phrases and lines that contain a template."""
    return licenses.scan(documents(spark, sf_dir))


@query("op8_quality_ledger", f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & {quality.mask(quality.BASE)} <> 0 AS base_failed,
  failed & {quality.mask(quality.STRICT)} = 0 AS kept, failed
FROM ({quality.ledger_sql("documents")})""")
def op8(spark, sf_dir):
    """Rule ledger of every document and the verdict of the strict policy."""
    book = quality.ledger(documents(spark, sf_dir))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", (~quality.verdict(quality.BASE))
        .alias("base_failed"), quality.verdict(quality.STRICT).alias("kept"),
        "failed")


@query("op4_language_id")
def op4(spark, sf_dir):
    """Language of every document, learned from the other three folds."""
    docs = documents(spark, sf_dir)
    model = langid.train(docs, ~langid.held_out())
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"))


@query("op3_pii")
def op3(spark, sf_dir):
    """Personal data of every document, with the words that disclose it."""
    found = pii.find(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    counts = [F.size(F.filter("spans", _is_kind(k))).cast("long")
              .alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts[:4],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"), counts[4])


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


@query("op2_decontamination")
def op2(spark, sf_dir):
    """Documents that hold a benchmark item within its edit budget."""
    return decontam.leaks(documents(spark, sf_dir),
                          table(spark, sf_dir, "benchmark"))


@query("op10_near_duplicates", oddsketch.near_duplicates_sql("documents"))
def op10(spark, sf_dir):
    """Components of near-duplicate documents."""
    return oddsketch.near_duplicates(documents(spark, sf_dir))


@query("op12_centroid_clusters", bitplanes.cluster_sql("embeddings"))
def op12(spark, sf_dir):
    """Clusters of all usable embeddings."""
    return bitplanes.cluster(table(spark, sf_dir, "embeddings"))


# The given pages have one template, which SQL can take apart by its tags.
_TEMPLATE = r"""
SELECT page_id, url, text, length(text) AS n_chars FROM (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(
    string_split_regex(replace(regexp_extract(html,
      '(?s)<article>(.*)</article>', 1), '<br>', ' '), '</?(?:p|h1)>'),
    lambda p: trim(regexp_replace(replace(regexp_replace(regexp_replace(
      regexp_replace(p, '<[^>]+>', '', 'g'), '&quot;?', '"', 'g'),
      '&amp;?', '&', 'g'), chr(160), ' '), '\s+', ' ', 'g'))),
    lambda p: p <> ''), chr(10)), '') AS text
  FROM pages)"""


@query("op13_html_extraction", _TEMPLATE)
def op13(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return mainhtml.extract(pages, mainhtml.train(pages))


@query("op11_token_alignment")
def op11(spark, sf_dir):
    """Groups and links of two tokenizers' ids in every document."""
    return alignment.align(documents(spark, sf_dir),
                           public_tokenizers.path(PACK_TOKENIZER),
                           public_tokenizers.path(PIECE_TOKENIZER)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256")
