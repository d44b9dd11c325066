"""Personal data: patterns, and words that give a person away.

Patterns find the protected entities (email, ip, card and phone spans). For
the words on their lines, the corpus tells how strongly each reveals its
entity. With p(.) the share of the corpus' distinct lines that contain
something, a word t discloses entity c if

    PMI(c, t) = log(p(c, t) / (p(c) p(t)))  >=  ratio * IC(c) = -ratio log p(c)

and t stands with c in at least ``min_support`` distinct lines, so copies of
one line prove nothing. Most entities are met once or twice, so c is also what
an entity shares with others: its kind, and the domain of an email. Such words get spans of their own, wherever they stand
in the documents that hold the entity; ``redact`` generalises entities to
their kind and removes the words.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, small, stage

KINDS = ("email", "ip", "card", "phone", "term")
MIN_SUPPORT, RATIO = 3, 0.8
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
                         "0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
# Words of fewer letters are no terms, but in the scripts without spaces every
# two neighbouring characters are a word (a single one that stands alone is).
_LEAST_LETTERS = 3
_DENSE = ("\u0e01-\u0e30\u0e32-\u0e33\u0e40-\u0e46\u3041-\u3096\u30a1-\u30fa\u30fc"
          "\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0002a6df")
_RUNS = re.compile(f"[{_DENSE}]+|[^{_DENSE}]+")
_DENSE_CHAR = re.compile(f"[{_DENSE}]")
_PAIR = f"(?=([{_DENSE}]{{2}}))"
_ALONE = f"(?<![{_DENSE}])([{_DENSE}])(?![{_DENSE}])"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping matches. The part before an @ is the whole
    run of its characters since the last match, so runs are read once."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, m.end()
                end = m.end()
        at = text.find("@", max(at + 1, end))


def ips(text: str):
    """Four dotted numbers at a time from each run of dotted numbers."""
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield at, end
            at = end + 1


def cards(text: str):
    for m in _RUN.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern spans by start, then kind."""
    found = []
    if "@" in text:
        found += [(s, e, 0) for s, e in emails(text)]
    if _DIGIT.search(text):
        found += [(s, e, 1) for s, e in ips(text)]
        found += [(s, e, 2) for s, e in cards(text)]
        if "+" in text:
            found += [(s, e, 3) for s, e in phones(text)]
    found.sort(key=lambda x: (x[0], x[2]))
    return [(s, e, KINDS[k]) for s, e, k in found]


def words(text: str):
    """(word, start, end) of the runs of letters, in lower case; of a run in a
    script without spaces, every two neighbours."""
    for m in _WORD.finditer(text):
        whole = m.group().isalpha()
        # other number signs are no letters
        for w, s, e in [(m.group(), 0, m.end() - m.start())] if whole \
                else _letter_runs(m.group()):
            s, e = s + m.start(), e + m.start()
            if w.isascii():
                yield w.lower(), s, e
                continue
            for r in _RUNS.finditer(w):
                run, at = r.group(), s + r.start()
                if not _DENSE_CHAR.match(run):
                    yield run.lower(), at, at + len(run)
                elif len(run) == 1:
                    yield run, at, at + 1
                else:
                    for i in range(len(run) - 1):
                        yield run[i:i + 2], at + i, at + i + 2


def _letter_runs(text: str):
    start = None
    for i, c in enumerate(text + " "):
        if c.isalpha():
            start = i if start is None else start
        elif start is not None:
            yield text[start:i], start, i
            start = None


def terms(text: Column) -> Column:
    """The distinct words of a text, as ``words`` finds them."""
    spaced = F.filter(F.transform(
        F.split(text, rf"[^\p{{L}}]+|[{_DENSE}]+"), F.lower),
        lambda w: F.length(w) >= _LEAST_LETTERS)
    dense = F.when(text.rlike(f"[{_DENSE}]"), F.concat(
        F.regexp_extract_all(text, F.lit(_PAIR), 1),
        F.regexp_extract_all(text, F.lit(_ALONE), 1))).otherwise(
        F.array().cast("array<string>"))
    return F.array_distinct(F.concat(spaced, dense))


def names(kind: str, text: str) -> list[str]:
    """What an entity's words may disclose: the entity (however it is
    written), the domain of an email, the kind."""
    if kind in ("card", "phone"):
        return [f"{kind}:{''.join(_DIGIT.findall(text))}", kind]
    if kind == "ip":
        return [f"ip:{'.'.join(str(int(p)) for p in text.split('.'))}", kind]
    text = text.lower()
    return [f"{kind}:{text}", f"domain:{text[text.index('@') + 1:]}", kind]


def entity_lines(text: str, spans):
    """(names, line, rest) of each line with entities: what they are called,
    a hash of the line, and the line without what any span covers."""
    i = 0
    while i < len(spans):
        lo = text.rfind("\n", 0, spans[i][0]) + 1
        hi = text.find("\n", spans[i][1])
        hi = len(text) if hi < 0 else hi
        called, rest, at = {}, [], lo
        while i < len(spans) and spans[i][0] < hi:
            s, e, kind = spans[i]
            called.update(dict.fromkeys(names(kind, text[s:e])))
            rest.append(text[at:s])
            at = max(at, e)
            i += 1
        line = hashlib.blake2b(text[lo:hi].encode("utf-8", "replace"),
                               digest_size=8).digest()
        yield (list(called), int.from_bytes(line, "little", signed=True),
               " ".join([*rest, text[at:hi]]))


_LINES = pa.list_(pa.struct([("names", pa.list_(pa.string())),
                             ("line", pa.int64()), ("rest", pa.string())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                             ("kind", pa.string())]))
SPAN_TYPE = "array<struct<start:bigint,end:bigint,kind:string>>"
_LINES_TYPE = "array<struct<names:array<string>,line:bigint,rest:string>>"


def _read(columns: list[str]):
    def run(batches):
        for b in batches:
            spans, lines, held = [], [], []
            for t in b.column(2):
                text = t.as_py() or ""
                found = entities(text)
                spans.append([{"start": s, "end": e, "kind": k}
                              for s, e, k in found])
                lines.append([dict(zip(("names", "line", "rest"), x))
                              for x in entity_lines(text, found)])
                held.append(text if found else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(spans, _SPANS),
                 pa.array(lines, _LINES), pa.array(held, pa.string())],
                names=columns)
    return run


def _mark(batches):
    """Every place of a document's terms outside its pattern spans."""
    for b in batches:
        out = []
        for text, spans, told in zip(b.column(1), b.column(2), b.column(3)):
            text, told, places = text.as_py(), set(told.as_py()), []
            spans = [(s["start"], s["end"]) for s in spans.as_py()]
            i = reach = 0
            for w, s, e in words(text):
                # by start; ``reach`` is the furthest end of those before e
                while i < len(spans) and spans[i][0] < e:
                    reach = max(reach, spans[i][1])
                    i += 1
                if w in told and reach <= s:
                    places.append({"start": s, "end": e, "kind": "term"})
            out.append(places)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(out, _SPANS)], names=["__row", "__terms"])


def disclosing(docs: DataFrame, lines: DataFrame, text_col: str,
               min_support: int, ratio: float) -> DataFrame:
    """(``name``, ``term``) pairs over the thresholds.

    ``lines`` has names, line and rest, in any number of copies. Counts are of
    distinct lines over the whole corpus; the corpus is read once more for the
    candidate terms only, and not at all where there is none. An entity on
    fewer than ``min_support`` lines has no pair, so its words are not
    counted."""
    spark = docs.sparkSession
    once = stage(lines.dropDuplicates(["line"]), "pii-lines")
    n_c = stage(once.select(F.explode("names").alias("name")).groupBy(
        "name").agg(F.count(F.lit(1)).alias("n_c")).filter(
        F.col("n_c") >= min_support), "pii-names")
    n_names = n_c.count()
    if not n_names:
        return spark.createDataFrame([], "name string, term string")
    named = once.select("rest", F.explode("names").alias("name")).join(
        small(n_c.select("name"), n_names), "name")
    pairs = stage(named.select("name", F.explode(terms(F.col("rest")))
                               .alias("term")).groupBy("name", "term").agg(
        F.count(F.lit(1)).alias("n_ct")).filter(
        F.col("n_ct") >= min_support), "pii-pairs")
    if pairs.isEmpty():
        return pairs.select("name", "term")
    corpus = docs.select(F.explode(F.split(
        F.col(text_col).cast("string"), "\n")).alias("l")).withColumn(
        "f", F.xxhash64("l"))
    total = float(corpus.select("f").distinct().count())
    # PMI >= ratio * IC says n_t <= n_ct * (total / n_c) ** (1 - ratio). The
    # lines with entities are some of the term's lines, so a term that stands
    # in more of them than that is out before the corpus is read for it.
    near_t = once.select(F.explode(terms(F.col("rest"))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n_near"))
    most = F.col("n_ct") * F.pow(F.lit(total) / F.col("n_c"),
                                 F.lit(1.0 - ratio)) * (1 + 1e-9)
    pairs = stage(pairs.join(small(n_c, n_names), "name").join(
        near_t, "term").filter((F.col("n_c") < total)
                               & (F.col("n_near") <= most)), "pii-candidates")
    wanted = stage(pairs.select("term").distinct(), "pii-terms")
    # equal lines meet as their distinct words, which are shorter than the line
    known = corpus.select("f", F.array_join(terms(F.col("l")), " ").alias(
        "ws")).dropDuplicates(["f"]).select(F.explode(F.split("ws", " "))
                                            .alias("term")).join(
        small(wanted, wanted.count()), "term").groupBy("term").agg(
        F.count(F.lit(1)).alias("n_t"))
    pmi = F.log(F.col("n_ct") * F.lit(total) / (F.col("n_c") * F.col("n_t")))
    ic = F.log(F.lit(total) / F.col("n_c"))
    return pairs.join(known, "term").filter(
        pmi >= F.lit(ratio) * ic).select("name", "term")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         min_support: int = MIN_SUPPORT, ratio: float = RATIO) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and ``spans`` (structs of
    start, end and kind; code points, end exclusive; by start, then kind as
    in ``KINDS``). Pattern spans are always there; words that disclose an
    entity of the document are added as kind ``term``, at every place in the
    document outside its pattern spans.

    * null or empty text: no spans
    * null ids and repeated rows: one result row each; equal lines count once
      in the corpus statistics
    * very long texts are read whole; patterns read each run once
    * other columns are ignored; an empty table gives no rows"""
    python_ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("__row", T.LongType()), T.StructField("__id", kind),
        T.StructField("spans", T._parse_datatype_string(SPAN_TYPE)),
        T.StructField("lines", T._parse_datatype_string(_LINES_TYPE)),
        # texts with entities only
        T.StructField("text", T.StringType())])
    held = stage(docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.col(id_col).alias("__id"), F.col(text_col).cast("string")
        .alias("__text")).mapInArrow(_read(schema.names), schema),
        "pii")
    told = stage(disclosing(docs, held.select(F.inline("lines")), text_col,
                            min_support, ratio), "pii-told")
    owners = held.filter(F.col("text").isNotNull())
    own = owners.select("__row", F.flatten("lines.names").alias("names"),
                        F.explode(terms(F.col("text"))).alias("term")).join(
        small(told, told.count()), "term").filter(
        F.array_contains("names", F.col("name"))).groupBy("__row").agg(
        F.collect_set("term").alias("told"))
    extra = owners.join(own, "__row").select(
        "__row", "text", "spans", "told").mapInArrow(
        _mark, f"__row bigint, __terms {SPAN_TYPE}")
    rank = {k: i for i, k in enumerate(KINDS)}
    order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    joined = F.concat("spans", F.coalesce("__terms", F.array().cast(SPAN_TYPE)))
    ranked = F.array_sort(F.transform(joined, lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return held.select("__row", "__id", "spans").join(
        extra, "__row", "left").select(
        F.col("__id").alias(id_col), F.transform(ranked, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind"))).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",")


def _redacted(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, ss in zip(text, spans):
        if t is None:
            out.append(None)
            continue
        parts, at = [], 0
        for s in ss if ss is not None else []:
            if s["start"] >= at:
                parts.append(t[at:s["start"]])
                parts.append("" if s["kind"] == "term"
                             else f"<{s['kind'].upper()}>")
            at = max(at, s["end"])
        out.append("".join(parts) + t[at:])
    return pd.Series(out, dtype=object)


def redact(text: Column, spans: Column) -> Column:
    """Texts with entities generalised to ``<KIND>`` and disclosing words
    removed (overlapping spans become one, named after the first)."""
    return F.pandas_udf(_redacted, T.StringType())(text, spans)
