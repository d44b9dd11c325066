"""Language identification in two steps.

A linear one-versus-rest support vector machine picks the language family;
within the family, a linear support vector machine for each pair of languages
votes. Features are hashed character bigrams and trigrams of the whole text,
as square roots of their relative frequencies (vectors of length one).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, only, python_ready

# Families of languages that are easily confused. A label that
# is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic",
    "da": "germanic", "no": "germanic", "fr": "romance", "es": "romance",
    "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic",
    "sk": "slavic", "bg": "slavic", "hr": "slavic", "sr": "slavic",
}
UNKNOWN = "und"
DIMS = 4096
# Bounds of the labelled sample that the machines are fitted on.
SAMPLE_PER_LANGUAGE, MAX_LANGUAGES = 500, 100
# A calibrated model's floor is the score that this share of labelled texts
# stays under when each is scored by machines fitted without its part of the
# sample.
MAX_LOSS, PARTS = 0.001, 3
# Characters of a text held as numbers at a time.
_CHUNK = 1 << 20
# Rows whose squares are held at a time.
_SQUARES = 256
_TABLE: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Code point → code point in lower case, or a space if no letter."""
    if not _TABLE:
        t = np.full(0x110000, 32, dtype="u4")
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                t[c] = ord(s.lower()[0])
        _TABLE.append(t)
    return _TABLE[0]


def vector(text: str | None) -> np.ndarray | None:
    """Feature vector of a text; None if it has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    counts = np.zeros(DIMS)
    letters, tail = False, np.array([32], dtype="u4")
    for at in range(0, len(codes), _CHUNK):
        c = _table()[codes[at:at + _CHUNK]]
        letters = letters or bool((c != 32).any())
        end = [32] if at + _CHUNK >= len(codes) else []
        c = np.concatenate((tail, c, end)).astype("u4")
        c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
        two = (c[:-1] * np.uint32(0x9E3779B1)) ^ (c[1:] * np.uint32(0x85EBCA6B))
        three = (two[:-1] * np.uint32(0xC2B2AE35)) ^ (
            c[2:] * np.uint32(0x27D4EB2F))
        # a tail of two holds a bigram that was counted with its stretch
        for h in (two[len(tail) - 1:], three):
            h = h * np.uint32(0x2C1B3C6D)
            counts += np.bincount(h >> np.uint32(32 - 12), minlength=DIMS)
        tail = c[-2:]
    if not letters:
        return None
    return np.sqrt(counts / counts.sum()).astype("f4")


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0,
            rounds: int = 30, seed: int = 1,
            rows: np.ndarray | None = None) -> np.ndarray:
    """Linear SVM with hinge loss by dual coordinate descent; ``y`` is ±1 and
    the last weight is the bias. Classes weigh the same. ``rows``: those of
    ``x`` that ``y`` stands for, all if None. One row at a time is widened, so
    no copy of ``x`` is made."""
    rows = np.arange(len(x)) if rows is None else rows
    share = {s: max(1, int((y == s).sum())) for s in (-1, 1)}
    top = np.array([cost * len(y) / (2 * share[int(v)]) for v in y])
    one = np.ones(x.shape[1] + 1)

    def squares(part):
        wide = np.ones((len(part), len(one)))
        wide[:, :-1] = x[part]
        return (wide * wide).sum(1)

    norm = np.concatenate([squares(rows[k:k + _SQUARES]) for k in range(
        0, len(rows), _SQUARES)]) if len(rows) else np.zeros(0)
    alpha = np.zeros(len(y))
    w, rng = np.zeros(len(one)), np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            one[:-1] = x[rows[i]]
            g = y[i] * (one @ w) - 1
            a = min(max(alpha[i] - g / norm[i], 0.0), top[i])
            if a != alpha[i]:
                w += (a - alpha[i]) * y[i] * one
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-4:
            break
    return w


@dataclass
class Model:
    """Families, one machine per family, one per pair of a family's
    languages. A score below ``floor`` says that a text is in none of them."""
    families: dict[str, list[str]] = field(default_factory=dict)
    family_w: np.ndarray | None = None
    pairs: dict[str, list[tuple[int, int]]] = field(default_factory=dict)
    pair_w: dict[str, np.ndarray] = field(default_factory=dict)
    floor: float = 0.0

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Labels and scores (0 to 1) of feature rows."""
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        names = list(self.families)
        if len(names) > 1:
            m = x @ self.family_w.T
            best = m.argmax(1)
            rest = np.sort(m, axis=1)
            sure = _squash(rest[:, -1] - rest[:, -2])
        else:
            best, sure = np.zeros(len(x), int), np.ones(len(x))
        labels, score = [""] * len(x), sure.copy()
        for f, name in enumerate(names):
            rows = np.flatnonzero(best == f)
            langs = self.families[name]
            if not len(rows):
                continue
            if len(langs) == 1:
                for r in rows:
                    labels[r] = langs[0]
                continue
            m = x[rows] @ self.pair_w[name].T
            votes = np.zeros((len(rows), len(langs)))
            margin = np.zeros_like(votes)
            for k, (a, b) in enumerate(self.pairs[name]):
                won = m[:, k] >= 0
                votes[:, a] += won
                votes[:, b] += ~won
                margin[:, a] += m[:, k]
                margin[:, b] -= m[:, k]
            # most votes, then the largest sum of margins
            rank = votes + 0.5 * np.tanh(margin)
            top = rank.argmax(1)
            for r, t, g in zip(rows, top, margin[np.arange(len(rows)), top]):
                labels[r] = langs[t]
                score[r] *= _squash(2 * g / (len(langs) - 1))
        return labels, np.clip(score, 0.0, 1.0)


def _squash(margin):
    return 1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -30, 30)))


def fit(x: np.ndarray, labels: list[str], families=FAMILIES,
        rows: np.ndarray | None = None) -> Model:
    """The hierarchical model of labelled feature rows, of ``rows`` if
    given."""
    model, y = Model(), np.array(labels, dtype=object)
    rows = np.arange(len(x)) if rows is None else rows
    y = y[rows]
    for lang in sorted(set(y)):
        model.families.setdefault(families.get(lang, lang), []).append(lang)
    model.families = dict(sorted(model.families.items()))
    of = np.array([families.get(v, v) for v in y], dtype=object)
    if len(model.families) > 1:
        model.family_w = np.stack([
            fit_svm(x, np.where(of == f, 1, -1), rows=rows)
            for f in model.families]
        ).astype("f4")
    for f, langs in model.families.items():
        model.pairs[f] = [(a, b) for a in range(len(langs))
                          for b in range(a + 1, len(langs))]
        if model.pairs[f]:
            ws = []
            for a, b in model.pairs[f]:
                own = np.flatnonzero((y == langs[a]) | (y == langs[b]))
                ws.append(fit_svm(x, np.where(y[own] == langs[a], 1, -1),
                                  rows=rows[own]))
            model.pair_w[f] = np.stack(ws).astype("f4")
    return model


def score_floor(x: np.ndarray, labels: list[str], families=FAMILIES,
                max_loss: float = MAX_LOSS, parts: int = PARTS) -> float:
    """The ``max_loss`` quantile of the scores that correctly identified rows
    get from machines fitted on the other parts. Equal rows are in one part;
    0 if no part can be scored."""
    part = np.array([zlib.crc32(v.tobytes()) % parts for v in x])
    y, right = np.array(labels, dtype=object), []
    for p in range(parts):
        rest, own = part != p, part == p
        if rest.any() and own.any():
            got, score = fit(x, labels, families, np.flatnonzero(
                rest)).predict(x[own])
            right.append(score[np.array(got, dtype=object) == y[own]])
    right = np.concatenate(right) if right else np.zeros(0)
    return float(np.quantile(right, max_loss)) if len(right) else 0.0


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
           learn: Column, per_language: int, max_languages: int
           ) -> DataFrame:
    """At most ``per_language`` labelled texts of each of the (at most)
    ``max_languages`` most frequent labels, chosen by a hash of the id. The
    labels' counts set how small a hash must be, so about twice as many ids
    as are wanted are ranked, however many rows there are."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull()
                       & F.col(text_col).isNotNull()
                       & F.col(id_col).isNotNull())
    common = rows.groupBy(F.col(lang_col).alias("__lang")).agg(
        F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), "__lang") \
        .limit(max_languages)
    share = (F.xxhash64("__id") / F.lit(2.0 ** 64) + 0.5) * F.col("__n")
    w = Window.partitionBy("__lang").orderBy(F.xxhash64("__id"), "__id")
    ids = rows.select(F.col(id_col).alias("__id"),
                      F.col(lang_col).alias("__lang")) \
        .join(F.broadcast(common), "__lang") \
        .filter(share < 2 * per_language + 100) \
        .withColumn("__nth", F.row_number().over(w)) \
        .filter(F.col("__nth") <= per_language).select("__id", "__lang")
    # at most per_language * max_languages ids
    return rows.select(F.col(id_col).alias("__id"),
                       F.col(lang_col).alias("__lang"),
                       F.col(text_col).cast("string").alias("__text")).join(
        F.broadcast(ids.distinct()), ["__id", "__lang"]).dropDuplicates(
        ["__id", "__lang"])


def _vectors(batches):
    for b in batches:
        vs = [vector(t.as_py()) for t in b.column(1)]
        keep = [i for i, v in enumerate(vs) if v is not None]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(keep, pa.int64())).cast(pa.string()),
             pa.array([vs[i].tobytes() for i in keep], pa.binary())],
            names=["lang", "x"])


def train(docs: DataFrame, learn: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE,
          max_languages: int = MAX_LANGUAGES, families=FAMILIES,
          calibrate: bool = False) -> Model:
    """Fit on a bounded sample of labelled rows where ``learn`` holds. The
    sample's vectors (16 KB each) are made by the executors. ``calibrate``
    sets the model's floor from the same sample."""
    python_ready(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    rows = sample(docs, id_col, text_col, lang_col, learn, per_language,
                  max_languages).select(F.col("__lang").alias("lang"),
                                        F.col("__text").alias("text"))
    got = rows.mapInArrow(_vectors, "lang string, x binary").toArrow()
    labels, x = got.column("lang").to_pylist(), [
        np.frombuffer(v.as_buffer(), dtype="f4") for v in got.column("x")]
    if not labels:
        return Model()
    order = sorted(range(len(x)), key=lambda k: (labels[k], x[k].tobytes()))
    labels, x = [labels[k] for k in order], np.stack([x[k] for k in order])
    del got
    model = fit(x, labels, families)
    if calibrate:
        model.floor = score_floor(x, labels, families)
    del x
    give_back()
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text",
             lang_out: str = "lang_pred", score_out: str = "lang_score"
             ) -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1.

    Only the text is looked at, all of it.

    * null, empty or letterless text: ``und``, score 0 (so is every text if
      nothing was learned)
    * very long texts are read in stretches of a million characters
    * repeated rows are predicted alike; other columns are passed through,
      and ones named like the two outputs are replaced
    * an empty table gives no rows"""
    python_ready(docs.sparkSession)
    kept = docs.drop(lang_out, score_out)
    schema = T.StructType(kept.schema.fields + [
        T.StructField(lang_out, T.StringType()),
        T.StructField(score_out, T.DoubleType())])
    at = kept.columns.index(text_col)
    names = schema.names

    def run(batches):
        only()
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                vs = [vector(t.as_py()) if model.families else None
                      for t in part.column(at)]
                rows = [i for i, v in enumerate(vs) if v is not None]
                labels, scores = [UNKNOWN] * len(vs), [0.0] * len(vs)
                if rows:
                    ls, ss = model.predict(np.stack([vs[i] for i in rows]))
                    for i, lang, s in zip(rows, ls, ss):
                        labels[i], scores[i] = lang, float(s)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(labels, pa.string()),
                     pa.array(scores, pa.float64())], names=names)
    return kept.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Fold of a document by the CRC-32 of its id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
                      == 2, F.lit(False))


__all__ = ["FAMILIES", "UNKNOWN", "Model", "vector", "fit", "fit_svm",
           "score_floor", "train", "identify", "held_out"]
