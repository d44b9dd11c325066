import random
import re

from pyspark.sql import functions as F

from loadstar.llm import pii

from .helpers import docs

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plainly(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text)
              if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
              if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
              if 10 <= len(digits(m)) <= 15]
    return [(s, e, pii.KINDS[k]) for s, k, e in sorted(found)]


def test_patterns_against_plain_regexes():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "x-1", ".", " ", "-", "+", "1", "23", "255", "256",
             "4111 1111 1111 1111", "4242424242424242", "+1 (555) 123-4567",
             "me@ex.org", "10.0.0.1", "\n", "é", "(", ")", "0012.1.1.1", "%"]
    for _ in range(4000):
        t = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert pii.entities(t) == plainly(t), t
    assert pii.entities("a" * 50_000 + "@" + "1" * 50_000) == []


def _spans(df):
    return {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in df.collect()}


def test_spans_and_disclosing_words(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    for i in range(300):
        rows.append((i, " ".join(word() for _ in range(20)) + f"\nthe {word()}"))
    for i in range(300, 306):
        rows.append((i, f"{word()} {word()} Zorblax the ceo@firm.example wrote "
                        f"the {word()} {word()}"))
    # one line many times proves nothing
    rows += [(i, "copy of Quixly mail to other@firm.example here")
             for i in range(400, 420)]
    rows += [(500, None), (501, ""), (502, "x " * 40000 + "10.0.0.1"),
             (None, "a@b.cc")]
    df = docs(spark, rows, extra=("spans", "near"))
    out = pii.find(df)
    got = _spans(out)
    assert out.count() == len(rows)
    for d, t in rows:
        base = [s for s in got[d] if s[2] != "term"]
        assert base == plainly(t or "")
    text = dict(rows)
    for i in range(300, 306):
        terms = {text[i][s:e].lower() for s, e, k in got[i] if k == "term"}
        assert terms == {"zorblax", "wrote"}
    assert not any(k == "term" for i in range(400, 420) for _, _, k in got[i])
    shown = out.join(df.select("doc_id", "text"), "doc_id").filter(
        "doc_id = 300").select(pii.redact(F.col("text"), F.col("spans"))).first()[0]
    assert "<EMAIL>" in shown and "Zorblax" not in shown and "the" in shown


def test_disclosing_words_are_marked_in_the_whole_document(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("klmnopqrst", k=6))
    many = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, many(60)) for i in range(280)]
    rows += [(1000 + i, many(9)) for i in range(400)]
    # 40 words from the entity on its line, and on another line
    rows += [(300 + i, f"Zorblax {many(40)} ceo@firm.example {many(3)}\n"
              f"{many(2)} zorblax² {many(2)}") for i in range(6)]
    rows += [(400, "zorblax alone")]
    df = docs(spark, rows)
    got, text = _spans(pii.find(df)), dict(rows)
    for i in range(300, 306):
        marked = [text[i][s:e] for s, e, k in got[i] if k == "term"]
        assert marked == ["Zorblax", "zorblax"]
    assert got[400] == []


def test_term_spans_on_the_given_tables(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = pii.find(given).select(
        F.size(F.filter("spans", lambda s: s["kind"] == "term")).alias("n"))
    assert out.filter("n > 0").count() > 0


def test_entities_met_once_disclose_by_domain_and_kind(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("klmnopqrst", k=6))
    rows = [(i, f"{word()} {word()} 天气很好 {word()}") for i in range(900)]
    rows += [(1000 + i, f"{word()} Acmecorp p{i}@acme.example {word()}")
             for i in range(4)]
    rows += [(1100 + i, f"请联系王伟{word()} q{i}@{word()}.example")
             for i in range(5)]
    got, text = _spans(pii.find(docs(spark, rows))), dict(rows)
    marked = {d: "".join(sorted({text[d][s:e] for s, e, k in got[d]
                                 if k == "term"})) for d in text}
    assert all(marked[1000 + i] == "Acmecorp" for i in range(4))
    assert all("王伟" in marked[1100 + i] for i in range(5))
    assert not any(marked[i] for i in range(900))


def test_words_are_found_alike_by_both_readers(spark):
    rng = random.Random(6)
    parts = ["a", "Bcd", "É", "王", "伟", "の", "ก", "า", "²", "1", "_", " ",
             "-", "\n", "ß", "word", "Ⅳ", "한국어"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(1, 15))))
            for i in range(500)]
    got = docs(spark, rows).select("doc_id", pii.terms(F.col("text"))).collect()
    for d, found in got:
        want = {w for w, _, _ in pii.words(rows[d][1])
                if len(w) >= 3 or pii._DENSE_CHAR.match(w)}
        assert set(found) == want, rows[d][1]


def test_empty_table(spark):
    assert pii.find(docs(spark, [])).count() == 0
