"""Benchmark decontamination by pigeonhole edit matching.

Texts are sequences of lower-case words; in scripts that put no spaces between
words each character is one. A test item of n words may be met
with up to k = n * budget word edits (insertions, deletions, replacements).
Cut into k + 1 pieces, at least one piece of it then stands unchanged in any
such passage. All pieces of all items are searched at once (Aho-Corasick),
and around every hit the edit distance of the item to the best passage is
computed by Myers' bit-parallel method.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, python_ready, worker_cache
from .packing import _arrow

# Items of MIN_WORDS words are searched with edits; shorter ones as they are, if
# they have MIN_CHARS characters.
BUDGET, MIN_WORDS, MIN_CHARS = 0.15, 8, 20
# Characters of benchmark text that one scan of the documents searches for.
BLOCK_CHARS = 1 << 20
_BREAK = re.compile(r"[\W_]+")
# Thai, Lao, Myanmar, Khmer, kana, Han (with extensions and compatibility).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff"
                       "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                       "\U00020000-\U0003ffff]")


def plain(text: str | None) -> str:
    """Lower-case words with single spaces between them."""
    text = (text or "").lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", text)
    return _BREAK.sub(" ", text).strip()


def edits(n: int, budget: float) -> int:
    """Edits that an item of ``n`` words may be met with."""
    return int(n * budget + 1e-9)


def searched(item: str, min_words: int, min_chars: int) -> bool:
    """Whether an item (plain text) is evidence of a leak where it stands."""
    words = item.count(" ") + 1 if item else 0
    return words >= min_words > 0 or \
        len(item) - item.count(" ") >= max(1, min_chars)


def pieces(words: list[str], k: int) -> list[tuple[int, list[str]]]:
    """``k + 1`` consecutive pieces of nearly equal length, with offsets."""
    n = len(words)
    cuts = [i * n // (k + 1) for i in range(k + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: list[str], text: list[str]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a part of ``text`` and the (first)
    place where such a part ends (exclusive). One bit per pattern word."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        eq = at.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Searcher:
    """All items of a block of the benchmark: ``find(text)`` gives (item,
    distance, first word, end word) of each item's best passage."""

    def __init__(self, items: list[tuple[int, list[str]]], budget: float,
                 min_words: int = MIN_WORDS):
        self.items = [(i, w, edits(len(w), budget)
                       if len(w) >= min_words else 0) for i, w in items]
        self.auto = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for n, (_, words, k) in enumerate(self.items):
            for offset, piece in pieces(words, k):
                at.setdefault(f" {' '.join(piece)} ", []).append((n, offset))
        for key, value in at.items():
            self.auto.add_word(key, (len(key), value))
        self.any = bool(at)
        if self.any:
            self.auto.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        if not self.any or not text:
            return []
        line = f" {plain(text)} "
        starts: dict[int, set[int]] = {}
        words, spaces = None, None
        for end, (size, places) in self.auto.iter(line):
            if words is None:
                words = line.split()
                spaces = [i for i, c in enumerate(line) if c == " "]
            at = bisect_left(spaces, end - size + 1)
            for n, offset in places:
                starts.setdefault(n, set()).add(at - offset)
        found = []
        for n, where in starts.items():
            item, pattern, k = self.items[n]
            best = None
            done = float("-inf")
            for s in sorted(where):
                # starts up to k apart share one stretch of text, which
                # holds every passage that begins within k words of them
                if s <= done:
                    continue
                done = s + k
                lo, hi = max(0, s - k), s + len(pattern) + 3 * k
                distance, stop = myers(pattern, words[lo:hi])
                if distance <= k and (best is None or distance < best[0]):
                    back, length = myers(pattern[::-1],
                                         words[lo:lo + stop][::-1])
                    best = (distance, lo + stop - length, lo + stop)
                    if distance == 0:
                        break
            if best:
                found.append((item, *best))
        return sorted(found)


_SEARCHERS: dict = worker_cache()


def _searcher(items, budget, min_words) -> Searcher:
    """One automaton per worker and block."""
    only(_SEARCHERS)
    key = (hash(items), len(items), budget, min_words)
    if key not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[key] = Searcher([(i, t.split()) for i, t in items], budget,
                                   min_words)
    return _SEARCHERS[key]


def blocks(benchmark: DataFrame, item_col: str, text_col: str,
           min_words: int, min_chars: int, block_chars: int):
    """The benchmark's distinct items in blocks of about ``block_chars``
    characters, one at a time: (position in the block, plain text), and the
    items' own ids."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.col(text_col).cast("string")
        .alias("text")).distinct()
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // block_chars))
    for b in range(n):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect()
        kept = [(r["item"], p) for r in part
                if searched(p := plain(r["text"]), min_words, min_chars)]
        kept.sort(key=lambda x: (x[1], str(x[0])))
        if kept:
            yield tuple((i, p) for i, (_, p) in enumerate(kept)), \
                [item for item, _ in kept]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", budget: float = BUDGET,
          min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(``id_col``, ``item_col``, ``edits``, ``first_word``, ``last_word``)
    for every document and item that it holds within the item's budget; the
    words are those of the best passage, counted from 0.

    * null or empty texts hold nothing; null items are skipped
    * items under ``min_words`` words are searched without edits; those that
      also have under ``min_chars`` characters (spaces apart) are not: so
      short a text is no evidence of a leak
    * in scripts without spaces between words a character is a word
    * equal items are reported each; repeated document rows give a row each
    * very long texts are searched whole
    * other columns are ignored; an empty table on either side gives no rows

    The benchmark is taken in blocks of bounded size; each block costs one
    scan of the documents, without a shuffle."""
    spark = docs.sparkSession
    python_ready(spark)
    ids, items = docs.schema[id_col].dataType, benchmark.schema[item_col] \
        .dataType
    schema = T.StructType([
        T.StructField("__d", ids), T.StructField("__i", items),
        T.StructField("edits", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType())])
    arrow = pa.schema([("__d", _arrow(ids)), ("__i", _arrow(items)),
                       ("edits", pa.int64()), ("first_word", pa.int64()),
                       ("last_word", pa.int64())])
    texts = docs.select(F.col(id_col).alias("__d"),
                        F.col(text_col).cast("string").alias("__t"))
    found = [texts.mapInArrow(_leaks(block, names, budget, min_words, arrow),
                              schema)
             for block, names in blocks(benchmark, item_col, item_text_col,
                                        min_words, min_chars, block_chars)]
    out = reduce(DataFrame.unionByName, found,
                 spark.createDataFrame([], schema)) if len(found) != 1 \
        else found[0]
    return out.select(F.col("__d").alias(id_col),
                      F.col("__i").alias(item_col), "edits", "first_word",
                      "last_word")


def _leaks(block, names, budget, min_words, schema: pa.Schema):
    def run(batches):
        search = _searcher(block, budget, min_words)
        for b in batches:
            rows = []
            for i, t in enumerate(b.column(1)):
                rows += [(i, names[n], d, s, e - 1)
                         for n, d, s, e in search.find(t.as_py())]
            if rows:
                at, *cols = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at, pa.int64())), *[
                        pa.array(c, f.type)
                        for c, f in zip(cols, list(schema)[1:])]],
                    schema=schema)
    return run


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text",
          budget: float = BUDGET, min_words: int = MIN_WORDS,
          min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS
          ) -> DataFrame:
    """The rows of ``docs`` that hold no item (as :func:`leaks` has it), with
    all their columns. Rows are filtered where they are read."""
    python_ready(docs.sparkSession)
    at = docs.columns.index(text_col)
    for block, _ in blocks(benchmark, item_col, item_text_col, min_words,
                           min_chars, block_chars):
        docs = docs.mapInArrow(_clean(block, budget, min_words, at),
                               docs.schema)
    return docs


def _clean(block, budget, min_words, at):
    def run(batches):
        search = _searcher(block, budget, min_words)
        for b in batches:
            yield b.filter(pa.array([not search.find(t.as_py())
                                     for t in b.column(at)], pa.bool_()))
    return run


__all__ = ["plain", "edits", "pieces", "myers", "Searcher", "leaks", "clean"]
