"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps the measurements
and one integer with a bit for each failed rule. A policy is a version name
and a mask of the rules that reject; applying one, or asking what each rule
changes, reads the integers and not the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let

WORD_BREAK = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurement columns."""
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails any of ``rules``."""
    version: str
    rules: tuple[str, ...]


# Bit i of the ledger belongs to rule i; append new rules at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines",
         "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", "100 * n_capitals > 30 * word_chars"),
)
BASE = Policy("base-1", ("few_words", "repeated_words"))
STRICT = Policy("strict-1", tuple(r.name for r in RULES))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_capitals")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in the text.

    Windows are sorted with their places; equal neighbours are repeats, and
    the places they cover are counted once."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.concat_ws(" ", words[i], words[i + 1], words[i + 2]))

    def covered(w: Column) -> Column:
        ranked = F.sort_array(F.transform(
            w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: F.when(
                (k > 0) & (s[F.greatest(k - 1, F.lit(0))]["w"] == x["w"]),
                F.lit(True)).otherwise(
                (k + 1 < F.size(s)) & (F.coalesce(
                    F.get(s, k + 1)["w"], F.lit("")) == x["w"])))
            return F.size(F.array_distinct(F.flatten(F.transform(
                twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(
            let(ranked, places))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, covered))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
            ) -> DataFrame:
    """``id_col`` and the measurements of every text (``MEASURES``)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim(F.col("__t"), F.lit(SPACE))
    split = docs.select(F.col(id_col), text.alias("__t")).select(
        id_col, "__t", F.when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, WORD_BREAK)).alias("__w"),
        F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        .alias("__l"))
    return split.select(
        id_col, F.size("__w").alias("n_words"),
        F.length(F.array_join("__w", "")).alias("word_chars"),
        F.regexp_count("__t", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.size("__l").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        let(F.col("__w"), _repeat_words).alias("n_repeat_words"),
        F.regexp_count("__t", F.lit("[A-Z]")).alias("n_capitals")).select(
        id_col, *[F.col(m).cast("long").alias(m) for m in MEASURES])


def mask(policy: Policy, rules=RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in set(policy.rules))


def ledger(docs: DataFrame, rules=RULES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col``, the measurements and ``failed`` (long, a bit per rule).

    * null text counts as empty: it has no words and fails ``few_words``
    * null ids and repeated rows: one ledger row each
    * very long texts are measured whole, inside their own row
    * other columns are ignored; an empty table gives an empty ledger"""
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0))
                .cast("long") for i, r in enumerate(rules)),
               F.lit(0).cast("long"))
    return measure(docs, id_col, text_col).withColumn("failed", bits)


def verdict(policy: Policy, rules=RULES) -> Column:
    """True where the ledger row passes the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules))) == 0


def apply_policies(book: DataFrame, policies, rules=RULES) -> DataFrame:
    """The ledger with one boolean per policy version."""
    return book.withColumns({f"kept_{p.version}": verdict(p, rules)
                             for p in policies})


def ablation(book: DataFrame, policies, rules=RULES) -> DataFrame:
    """What each rule of each policy does: ``policy``, ``rule``, ``failing``
    (documents that fail it), ``only_by`` (rejected by this rule alone: they
    would stay without it), ``kept`` (by the policy) and ``documents``.

    The ledger is first counted per bit pattern (at most 2**rules rows), so
    only patterns are shuffled."""
    patterns = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.explode(F.array(*[F.struct(
        F.lit(p.version).alias("policy"), F.lit(r).alias("rule"),
        F.lit(mask(Policy("", (r,)), rules)).cast("long").alias("bit"),
        F.lit(mask(p, rules)).cast("long").alias("mask"))
        for p in policies for r in p.rules]))
    both = patterns.select("failed", "n", pairs.alias("__p")).select(
        "failed", "n", "__p.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))),
                                 F.lit(0)).cast("long")
    return both.groupBy("policy", "rule").agg(
        total(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(hit == F.col("bit")).alias("only_by"),
        total(hit == 0).alias("kept"),
        F.sum("n").cast("long").alias("documents"))


def ledger_sql(rel: str, rules=RULES) -> str:
    """DuckDB SQL for the ledger (``doc_id`` unique)."""
    word = r"[^\x20\x09-\x0D]+"
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END"
                      for i, r in enumerate(rules))
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM {rel}),
arr AS (SELECT doc_id, t, regexp_extract_all(t, '{word}') AS w FROM docs),
wd AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM arr),
tri AS (SELECT a.doc_id, a.i, a.w || ' ' || b.w || ' ' || c.w AS g FROM wd a
  JOIN wd b ON a.doc_id = b.doc_id AND b.i = a.i + 1
  JOIN wd c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
twice AS (SELECT doc_id, g FROM tri GROUP BY doc_id, g HAVING count(*) > 1),
cover AS (SELECT DISTINCT doc_id, i + o AS p FROM tri JOIN twice
  USING (doc_id, g) CROSS JOIN (VALUES (0), (1), (2)) x(o)),
rep AS (SELECT doc_id, count(*) AS n FROM cover GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS d FROM
  (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '{word}') GROUP BY doc_id),
m AS (SELECT arr.doc_id, len(w) AS n_words,
  length(array_to_string(w, '')) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  coalesce(ln.n, 0) AS n_lines, coalesce(ln.d, 0) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words,
  len(regexp_extract_all(t, '[A-Z]')) AS n_capitals
  FROM arr LEFT JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT *, {bits} AS failed FROM m"""
