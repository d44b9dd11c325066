import zlib

import numpy as np

from loadstar.llm import langid, queries

from .helpers import docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_language_id"](
        spark, SF).collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(
        SF + "/documents.parquet").select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [d for d in got if got[d]["held_out"] and truth[d]]
    right = sum(got[d]["lang_pred"] == truth[d] for d in held)
    assert right / len(held) >= 0.97, (right, len(held))


def _corpus():
    words = {"en": "the and thing with house", "de": "und der nicht haus für",
             "fr": "le des être maison où", "es": "el los señor casa año",
             "xx": "qqq zzq qzq zqz"}
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        lang = list(words)[i % 5]
        rows.append((i, " ".join(rng.choice(words[lang].split(), 30)), lang, "s"))
    return rows


def test_families_and_edge_cases(spark):
    rows = _corpus()
    df = docs(spark, rows)
    model = langid.train(df, per_language=30)
    assert set(model.families) == {"germanic", "romance", "xx"}
    assert model.pairs["germanic"] == [(0, 1)]
    odd = [(1000, None), (1001, ""), (1002, "123 !? \n"),
           (1003, "der und nicht " * 100_000), (None, "los señor casa"),
           (1, rows[1][1])]
    out = langid.identify(docs(spark, rows + [(*r, None, None) for r in odd],
                               extra=("lang_pred", "lang_score")), model)
    got = out.collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in got}
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0)
    assert by[1003][0] == "de" and by[None][0] == "es"
    wrong = [d for d, _, lang, _ in rows if by[d][0] != lang]
    assert not wrong


def test_nothing_learned_and_empty(spark):
    model = langid.train(docs(spark, [(1, "text", None, None)]))
    got = langid.identify(docs(spark, [(1, "text")]), model).first()
    assert got["lang_pred"] == "und"
    assert langid.identify(docs(spark, []), model).count() == 0
    one = langid.train(docs(spark, [(1, "only one"), (2, "language here")]))
    assert langid.identify(docs(spark, [(3, "x")]), one).first()[
        "lang_pred"] == "en"


def test_long_texts_are_read_whole(monkeypatch):
    text = "abc  défg 12 " * 50 + "\n "
    whole = langid.vector(text)
    for size in (1, 2, 3, 7, 100):
        monkeypatch.setattr(langid, "_CHUNK", size)
        assert np.array_equal(whole, langid.vector(text)), size


def test_floor_tells_junk_from_labelled_text(spark):
    model = langid.train(docs(spark, _corpus()), calibrate=True)
    assert 0 < model.floor < 1
    assert langid.train(docs(spark, _corpus())).floor == 0
    one = langid.train(docs(spark, [(1, "only one"), (2, "language here")]),
                       calibrate=True)
    assert one.floor == 1 and langid.identify(
        docs(spark, [(3, "x")]), one).first()["lang_score"] == 1


def _two_steps(model, text):
    """The prediction spelled out for one text: the family whose machine gives
    the most, then a vote of each pair of its languages."""
    x = langid.vector(text)
    if x is None:
        return "und", 0.0
    x = np.append(x, 1).astype("f8")
    names = list(model.families)
    scores = sorted(((float(np.dot(w, x)), n) for w, n in
                     zip(model.family_w, names)), reverse=True)
    name = scores[0][1]
    langs = model.families[name]
    if len(langs) == 1:
        return langs[0], None
    votes, margin = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
    for (a, b), w in zip(model.pairs[name], model.pair_w[name]):
        m = float(np.dot(w, x))
        votes[langs[a] if m >= 0 else langs[b]] += 1
        margin[langs[a]] += m
        margin[langs[b]] -= m
    return max(langs, key=lambda k: (votes[k], margin[k])), None


def test_predictions_against_the_two_steps_spelled_out(spark):
    given = spark.read.parquet(SF + "/documents.parquet")
    corpora = [(given, langid.train(given, ~langid.held_out()))]
    df = docs(spark, _corpus())
    corpora.append((df, langid.train(df, per_language=30)))
    for table, model in corpora:
        out = langid.identify(table, model).collect()
        assert len(out) >= 400
        for r in out:
            want, score = _two_steps(model, r["text"])
            assert r["lang_pred"] == want, r["doc_id"]
            assert score is None or r["lang_score"] == score


def test_pairs_are_machines_of_their_two_languages(spark):
    df = docs(spark, _corpus())
    model = langid.train(df, per_language=30)
    for name, langs in model.families.items():
        assert model.pairs.get(name, []) == [
            (a, b) for a in range(len(langs)) for b in range(a + 1, len(langs))]


def test_fit_makes_no_copy_of_the_sample():
    import tracemalloc
    rng = np.random.default_rng(3)
    x = rng.random((2000, 512)).astype("f4")
    y = np.where(rng.random(2000) < 0.5, 1, -1)
    tracemalloc.start()
    w = langid.fit_svm(x, y, rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes, peak
    rows = np.flatnonzero(np.arange(2000) % 3)
    assert (langid.fit_svm(x, y[rows], rounds=1, rows=rows)
            == langid.fit_svm(x[rows], y[rows], rounds=1)).all()
    assert len(w) == 513
