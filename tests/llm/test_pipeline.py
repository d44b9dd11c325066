import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from loadstar.llm import decontam, packing

from .helpers import docs
from .test_oddsketch import brute
from .test_packing import truth

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _tables(spark, folder):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("the", "and", "thing", "house", "over")
             for b in ("ing", "ed", "s", "ly", "ness", "ful")]
    text = lambda n: " ".join(rng.choice(words, n))
    leak = text(30)
    rows = [(i, "Home | About\n" + text(60) + "\n" + text(40), "en", f"s{i % 2}")
            for i in range(40)]
    rows += [(100, rows[3][1], "en", "x"), (101, rows[4][1] + " end", "en", "x"),
             (102, text(20) + " " + leak + " " + text(20), None, "x"),
             (103, "1234 5678", "en", "x"), (104, None, "en", "x"),
             (105, "", None, None), (None, text(50), "en", "x"),
             (106, text(6000), "en", "x")]
    docs(spark, rows).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string") \
        .write.parquet(folder + "/benchmark.parquet")
    return rows, leak


def test_stages_against_brute_force(spark, tmp):
    rows, leak = _tables(spark, tmp)
    df = spark.read.parquet(tmp + "/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    first = steps["language_id"](spark, df, tmp)
    want = [r for r in rows if r[0] not in (103, 104, 105)]
    assert first.columns == df.columns
    ids = lambda d: sorted(-1 if r[0] is None else r[0] for r in d)
    assert ids(first.collect()) == ids(want)

    second = steps["line_dedup"](spark, df, tmp)
    texts = {r["doc_id"]: r for r in second.collect()}
    assert second.columns == df.columns and len(texts) == len(rows)
    for d, t, _, s in rows:
        cut = t and s in ("s0", "s1")
        assert texts[d]["text"] == (t.split("\n", 1)[1] if cut else t)
        assert texts[d]["n_chars"] == (
            None if t is None else len(texts[d]["text"]))

    third = steps["near_dedup"](spark, df, tmp)
    groups = brute([(d, t) for d, t, _, _ in rows])
    keep = [d for d, n, c in groups if c is None or c == d]
    assert third.columns == df.columns
    assert ids(third.select("doc_id").collect()) == ids([(d,) for d in keep])

    fourth = steps["decontamination"](spark, df, tmp)
    assert ids(fourth.collect()) == ids([r for r in rows if r[0] != 102])
    assert leak in decontam.plain(dict((r[0], r[1]) for r in rows)[102])


def test_language_stage_decides_by_the_prediction(spark):
    step = dict(corpus_pipeline.STAGES)["language_id"]
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") \
        .select("doc_id", "text", "lang", "source")
    rng = np.random.default_rng(5)
    junk = [" ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 6))
                     for _ in range(80)) for _ in range(10)]
    junk += ["<td>{{x}}</td> " * 50, "0x4f 9zq " * 50,
             "的一是了我不人在他有这个上们来到时 " * 30]
    rows = [(-1 - i, t, None, "j") for i, t in enumerate(junk)]
    kept = {r[0] for r in step(spark, given.unionByName(docs(
        spark, rows).select(given.columns)), "").select("doc_id").collect()}
    assert not [r for r in rows if r[0] in kept]
    ids = {r[0] for r in given.select("doc_id").collect()}
    assert len(ids - kept) <= 0.005 * len(ids)


def test_language_stage_without_labels(spark):
    step = dict(corpus_pipeline.STAGES)["language_id"]
    df = docs(spark, [(1, "some text", None, "s"), (2, "日本", None, "s"),
                      (3, "12 ?", None, "s"), (4, None, None, "s")])
    assert {r[0] for r in step(spark, df, "").collect()} == {1, 2}


def test_run_packs_what_is_left(spark, tmp):
    rows, _ = _tables(spark, tmp)
    out = corpus_pipeline.run(spark, tmp)
    got = {}
    for r in out.orderBy("start").collect():
        got.setdefault(r["doc_id"], []).extend(packing.unpack(r["tokens"]).tolist())
    gone = {100, 101, 102, 103, 104, 105}
    want = {d: t.split("\n", 1)[1] if s in ("s0", "s1") else t
            for d, t, _, s in rows if d not in gone}
    assert got == {d: truth(PATH, t) + [1] for d, t in want.items()}


def test_empty_documents(spark, tmp):
    docs(spark, []).write.parquet(tmp + "/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        tmp + "/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0


def test_clashing_extra_columns(spark, tmp):
    _tables(spark, tmp)
    df = spark.read.parquet(tmp + "/documents.parquet").withColumns(
        {c: F.lit(3).cast("long") for c in (
            "n_lines", "n_dropped", "v", "root", "kept", "tokens", "length",
            "lang_pred", "edits")})
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, df, tmp)
        assert out.columns == df.columns, name
        assert out.select("n_lines").distinct().collect() == [(3,)]
