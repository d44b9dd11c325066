"""Line dedup, license scan and quality ledger."""

import random
import re
from collections import Counter

from loadstar.llm import licenses, linededup, quality

from .helpers import docs, plain


def _no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


# --- line dedup ---------------------------------------------------------

def _drop(rows, ratio, least):
    """rows: (id, text, source) → id → (text, lines, dropped)."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r")
    pages, count = Counter(s for _, _, s in rows), Counter()
    for _, t, s in rows:
        count.update({(s, key(x)) for x in (t or "").split("\n") if key(x)})
    bad = {k for k, n in count.items()
           if n >= least and n / pages[k[0]] >= ratio}
    out = {}
    for d, t, s in rows:
        lines = (t or "").split("\n")
        have = [x for x in lines if key(x)]
        gone = [x for x in have if (s, key(x)) in bad]
        if gone and len(gone) < len(have):
            out[d] = ("\n".join(x for x in lines if (s, key(x)) not in bad),
                      len(have), len(gone))
        else:
            out[d] = (t, len(have), 0)
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        src = rng.choice(["hot"] * 6 + ["a", "b", None])
        lines = [f"own {i} {k}" for k in range(rng.randrange(4))]
        if rng.random() < .5:
            lines.insert(0, "  menu home about")
        if rng.random() < .08:
            lines.append("rare line")
        if rng.random() < .3:
            lines.append("")
        rows.append((i, "\n".join(lines), src))
    rows += [(1000, None, "hot"), (1001, "", "a"),
             (1002, "x\n" * 20000 + "menu home about", "hot")]
    df = docs(spark, [(d, t, "en", s) for d, t, s in rows],
              extra=("n_lines", "n_dropped"))
    got = linededup.drop_lines(df)
    assert _no_python(got)
    want = _drop(rows, linededup.MAX_RATIO, linededup.MIN_PAGES)
    res = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"])
           for r in got.collect()}
    assert res == want
    assert any(v[2] for v in want.values())
    assert set(got.columns) == set(df.columns)


def test_line_dedup_leaves_boilerplate_pages_whole(spark):
    rows = [(i, "only\nmenu", "en", "s") for i in range(20)]
    got = linededup.drop_lines(docs(spark, rows)).collect()
    assert {(r["text"], r["n_dropped"]) for r in got} == {("only\nmenu", 0)}
    assert linededup.drop_lines(docs(spark, [])).count() == 0


def test_a_line_on_one_page_in_twenty_goes_from_every_host(spark):
    rows = [(h * 1000 + i, f"own {h} {i}" + ("\n share this" if i % 20 == 3
                                            else ""), "en", f"h{h}")
            for h, n in ((1, 100), (2, 140), (3, 500)) for i in range(n)]
    got = linededup.drop_lines(docs(spark, rows)).collect()
    assert not any("share" in r["text"] for r in got)
    assert sum(r["n_dropped"] for r in got) == 37
    # a line below that stays, and so does one on few pages of a small host
    rows = [(i, f"own {i}" + ("\nnow" if i < 9 else ""), "en", "h")
            for i in range(200)] + [
        (900 + i, f"small {i}\nfour", "en", "s") for i in range(4)]
    assert sum(r["n_dropped"] for r in linededup.drop_lines(
        docs(spark, rows)).collect()) == 0


# --- license scan -------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOWN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _scan(text):
    t = (text or "").translate(DOWN)
    words = WORD.findall(t)
    places, base = [], set()
    for p, label in licenses.PHRASES:
        p = p.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    labels, score = set(base), 0.0
    lines = [w for w in map(WORD.findall, t.split("\n")) if w]
    reach = max(len(t.split()) for t, _ in licenses.TEMPLATES)
    for i, line in enumerate(lines):
        have, after = set(line), 0
        for more in lines[i + 1:]:
            if after >= reach:
                break
            have.update(more)
            after += len(more)
        for body, label in licenses.TEMPLATES:
            want = set(body.split())
            both = len(want & have)
            if both >= licenses.needed(len(want), licenses.THRESHOLD):
                labels.add(label)
                score = max(score, both / len(want))
    return (len(words), len(places), min(places, default=None),
            max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), 1.0 if base else score)


def test_license_scan_against_brute_force(spark):
    rng = random.Random(8)
    vocab = sorted({w for t, _ in licenses.TEMPLATES for w in t.split()})
    texts = [None, "", "...", "Under the MIT license\nunder the mit license",
             "under the under the mit license", "UNDER\nTHE mit, LICENSE!",
             "Licensed under CC BY-NC 4.0.", "All rights reserved.",
             "Kelvin under the mit licenſe", "É under the MIT License é",
             "cc by " * 5000 + "nc", "x " * 30000 + "All Rights Reserved"]
    for _ in range(300):
        body, _ = rng.choice(licenses.TEMPLATES)
        ws = [w for w in body.split() if rng.random() < .9]
        ws += rng.choices(vocab + ["zz", "qq"], k=rng.randrange(5))
        rng.shuffle(ws)
        texts.append(rng.choice(["", "intro\n"]) + " ".join(ws).title()
                     + rng.choice(["", "\nthe end"]))
    for k in range(60):      # wrapped at some width, with text around it
        ws = ["zz"] * rng.randrange(6) + rng.choice(
            licenses.TEMPLATES)[0].split() + ["qq"] * rng.randrange(40)
        n = rng.randrange(1, 9)
        texts.append(rng.choice(["\n", "\n # ", "\n\n"]).join(
            " ".join(ws[i:i + n]) for i in range(0, len(ws), n)))
    texts.append("all\n" + "zz\n" * 30 + "rights reserved")
    texts.append("the of\n" * 3000 + "this software is\nfree of charge")
    rows = list(enumerate(texts)) + [(None, "All rights reserved"), (3, texts[3])]
    got = licenses.scan(docs(spark, rows, extra=("n_words", "labels", "score")))
    assert _no_python(got)
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word",
            "base_labels", "labels", "score"]
    res = sorted(map(repr, plain(got.select(cols).collect())))
    assert res == sorted(repr((d, *_scan(t))) for d, t in rows)
    assert sum(1 for r in got.collect() if r["labels"]) > 50
    assert licenses.scan(docs(spark, [])).count() == 0


def test_wrapped_license(spark):
    text = licenses.TEMPLATES[1][0].replace("person obtaining",
                                            "person\n obtaining")
    got = licenses.scan(docs(spark, [(1, "Copyright\n" + text),
                                     (2, text.split("\n")[0])])).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got} == {
        1: ("mit", 1.0), 2: ("", 0.0)}


# --- quality ledger -----------------------------------------------------

def _measure(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice, cover = Counter(tri), set()
    for i, g in enumerate(tri):
        if twice[g] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)),
            len(lines), len(lines) - len(set(lines)), len(cover),
            len(re.findall("[A-Z]", t)))


def test_ledger_against_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t ", "a", "a b c", "a b c a b c", "a a a a a",
             "x y #*$%&|<>", "é" * 9, "l\nl\n l\nl", "\x0b\x0ca\rb",
             "one two three " * 9000, "A B. C! " * 30]
    for _ in range(200):
        n = rng.randrange(120)
        texts.append("".join(rng.choice("abcdeé") + rng.choice([" ", " ", "\n"])
                             for _ in range(n)))
    rows = list(enumerate(texts)) + [(None, "no id"), (5, texts[5])]
    book = quality.ledger(docs(spark, rows, extra=("n_words", "failed")))
    assert _no_python(book)
    got = sorted(map(repr, plain(book.select(
        "doc_id", *quality.MEASURES).collect())))
    assert got == sorted(repr((d, *_measure(t))) for d, t in rows)
    by = {r["doc_id"]: r for r in book.collect()}
    assert by[0]["failed"] & 1 and by[11]["failed"] & 2


def test_policies_and_ablation(spark):
    texts = ["word " + " ".join(f"w{i}x{k}" for i in range(60)) for k in range(5)]
    texts += ["few words", texts[0] + " #" * 30, "few # # words"]
    book = quality.ledger(docs(spark, list(enumerate(texts))))
    policies = [quality.BASE, quality.STRICT]
    kept = quality.apply_policies(book, policies).collect()
    assert [r["kept_strict-1"] for r in kept].count(True) == 5
    assert [r["kept_base-1"] for r in kept].count(True) == 6
    ab = {(r["policy"], r["rule"]): r
          for r in quality.ablation(book, policies).collect()}
    assert _no_python(quality.ablation(book, policies))
    assert len(ab) == len(quality.BASE.rules) + len(quality.STRICT.rules)
    symbols = ab["strict-1", "symbols"]
    assert (symbols["failing"], symbols["only_by"], symbols["kept"],
            symbols["documents"]) == (2, 1, 5, 8)
    assert quality.ablation(quality.ledger(docs(spark, [])), policies).count() == 0
