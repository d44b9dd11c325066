"""From raw documents to packed training sequences.

``STAGES`` are (name, function) in order. Each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents; all but the last return the columns they get.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm import decontam, langid, linededup, oddsketch, packing
from loadstar.llm.common import drop_staged, stage, table
from loadstar.llm.queries import PACK_TOKENIZER

# Words whose ids a worker of the last stage keeps: executors still hold the
# memory of the stages before.
PACK_KEEP = 100_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels in ``docs`` teach (a
    bounded sample, without the held-out fold): those whose predicted language
    scores at least the model's floor, which one in a thousand
    (``langid.MAX_LOSS``) of the labelled texts stays under. What has no
    letter, or no text, goes. One language alone has nothing to be told from,
    so with one label, as with none, only the letterless go.

    Null labels are not learned from; an empty table gives no rows."""
    model = langid.train(docs, ~langid.held_out(), calibrate=True)
    if not model.families:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return langid.identify(docs, model, lang_out="__lang",
                           score_out="__score").filter(
        (F.col("__lang") != langid.UNKNOWN)
        & (F.col("__score") >= F.lit(model.floor))).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; ``n_chars``
    follows the text. A document that is boilerplate throughout stays whole.

    Null sources are one source; null texts stay null."""
    out = linededup.drop_lines(docs, counts=("__lines", "__dropped"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("__dropped") > 0, F.length("text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str
                    ) -> DataFrame:
    """One document of each group of near-duplicates (that of the smallest
    id); texts without words are in no group and stay."""
    return oddsketch.dedupe(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str
                  ) -> DataFrame:
    """Documents that hold no item of the benchmark within its edit budget.
    Null and empty texts hold none and stay; repeated rows go or stay
    together; items without words are in no document."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two token sequences of the remaining documents; a null or
    empty text is the end id alone, a repeated row a document of its own."""
    return packing.pack(docs, public_tokenizers.path(PACK_TOKENIZER),
                        keep=PACK_KEEP)


STAGES = [("language_id", language), ("line_dedup", lines),
          ("near_dedup", near_duplicates), ("decontamination", decontaminate),
          ("packing", pack)]

# Support vector machines and tokenizers are beyond SQL; the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the checkpoint
    folder and read again; a stage's table goes when the next one is
    written."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        before, docs = docs, stage(step(spark, docs, sf_dir), name)
        drop_staged(before)
    return docs
