import random

from pyspark.sql import types as T

from loadstar.llm import decontam

from .helpers import docs

ITEMS = T.StructType([T.StructField("item_id", T.LongType()),
                      T.StructField("text", T.StringType())])


def least(pattern, text):
    """Least edit distance of pattern to any part of text, by the table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_myers_against_the_table():
    rng = random.Random(5)
    for _ in range(600):
        p = [rng.choice("abcd") for _ in range(rng.randrange(1, 90))]
        t = [rng.choice("abcd") for _ in range(rng.randrange(0, 40))]
        d, end = decontam.myers(p, t)
        assert d == least(p, t)
        assert not end or least(p, t[:end]) == d


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = "zz" + str(rng.randrange(9))
        elif kind == 1 and len(words) > 1:
            del words[i]
        else:
            words.insert(i, "yy" + str(rng.randrange(9)))
    return words


def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, [rng.choice(vocab) for _ in range(rng.randrange(5, 45))])
             for i in range(30)]
    rows = []
    for i in range(250):
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        if rng.random() < .7:
            _, w = rng.choice(items)
            k = decontam.edits(len(w), decontam.BUDGET)
            at = rng.randrange(len(body) + 1)
            body[at:at] = _edited(rng, w, rng.randrange(0, k + 3))
        rows.append((i, (", ".join(body)).title()))
    rows += [(900, None), (901, ""), (902, "w1 " * 20000 + " ".join(items[0][1])),
             (3, rows[3][1]), (None, " ".join(items[7][1]))]
    bench = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in items] + [(99, None), (98, "w1 w2")], ITEMS)
    df = docs(spark, rows, extra=("item_id", "edits"))
    want = []
    for d, t in rows:
        ws = decontam.plain(t).split()
        if d == 902:
            ws = ws[-200:]
        for i, w in items:
            long = len(w) >= decontam.MIN_WORDS
            if long or len("".join(w)) >= decontam.MIN_CHARS:
                n = least(w, ws)
                if n <= (decontam.edits(len(w), decontam.BUDGET)
                         if long else 0):
                    want.append((d, i, n))
    for size in (decontam.BLOCK_CHARS, 700):
        got = decontam.leaks(df, bench, block_chars=size).collect()
        assert sorted((r["doc_id"] or -1, r["item_id"], r["edits"])
                      for r in got) == sorted((d or -1, i, n) for d, i, n in want)
        for r in got:
            ws = decontam.plain(dict(rows)[r["doc_id"]]).split()
            w = dict(items)[r["item_id"]]
            part = ws[r["first_word"]:r["last_word"] + 1]
            assert least(w, part) == r["edits"]
        kept = decontam.clean(df, bench, block_chars=size)
        bad = {d for d, _, _ in want}
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
            d for d, _ in rows if d not in bad)
        assert kept.columns == df.columns
    assert len(want) > 80


def test_short_items_and_scripts_without_spaces(spark):
    han = "".join(chr(0x4e00 + 37 * i) for i in range(60))
    thai = "\u0e20\u0e32\u0e29\u0e32\u0e44\u0e17\u0e22\u0e19\u0e32\u0e19"
    items = [(1, "Which river flows through Vienna?"), (2, han), (3, "yes, it is"),
             (4, thai), (5, "\u4e00\u4e8c"), (6, "")]
    bench = spark.createDataFrame(items, ITEMS)
    rows = [(10, "Q: which river flows through vienna? A: the Danube"),
            (11, "Which wide river flows through Vienna?"),
            (12, "\u524d" + han + "\u540e" * 5), (13, han[:20] + "\u4e01" + han[21:]),
            (14, han[:30]), (15, "yes, it is \u4e00\u4e8c"),
            (16, "x " + thai + "\u0e01"), (17, None)]
    got = decontam.leaks(docs(spark, rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got) == [
        (10, 1, 0), (12, 2, 0), (13, 2, 1), (16, 4, 0)]
    assert {r["doc_id"] for r in decontam.clean(docs(spark, rows), bench)
            .collect()} == {11, 14, 15, 17}


def test_empty_sides(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, " ".join("abcdefghij"))], ITEMS)
    assert decontam.leaks(docs(spark, [(1, "x")]), none).count() == 0
    assert decontam.clean(docs(spark, [(1, "x")]), none).count() == 1
    assert decontam.leaks(docs(spark, []), some).count() == 0
