import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadstar.llm import oddsketch
from loadstar.llm.common import Scratch

from .helpers import docs

DOWN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(DOWN))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """id → (set size, component id) over all pairs."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(s), least.get(top(i))) for i, (d, s) in enumerate(sets)]


def _edit(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return words


def corpus():
    rng = random.Random(12)
    rows = []
    add = lambda ws: rows.append((len(rows) * 3 % 1009, " ".join(ws)))
    for n in (1, 3, 5, 8, 40, 200, 3000):
        base = [f"b{n}x{rng.randrange(10 ** 6)}" for _ in range(n)]
        for k in range(12):
            add(_edit(rng, base, rng.randrange(0, max(2, n // 40))))
        add(w.upper() for w in base)
    # a chain: neighbours are close, its ends are not
    base = [f"c{i}" for i in range(300)]
    for k in range(12):
        add(base)
        base = _edit(rng, base, 4)
    # a hub between variants that are no duplicates of each other
    base = [f"h{i}" for i in range(200)]
    for k in range(60):
        add(_edit(rng, base, 5))
    add(base)
    # passages shared by texts that are otherwise their own
    passage = [f"p{i}" for i in range(60)]
    for k in range(60):
        own = [f"o{rng.randrange(10 ** 6)}" for _ in range(rng.choice((15, 90)))]
        add(own + passage)
    for k in range(150):
        add(f"r{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(1, 60)))
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "That it."),
             (2004, "that  IT."), (2005, "é É"), (2006, "É É")]
    return rows


@pytest.mark.parametrize("block, wide", [
    (oddsketch.BLOCK, oddsketch.WIDE), (7, oddsketch.WIDE), (16, 3)])
def test_components_against_brute_force(spark, monkeypatch, block, wide):
    monkeypatch.setattr(oddsketch, "BLOCK", block)
    monkeypatch.setattr(oddsketch, "WIDE", wide)
    rows = corpus()
    df = docs(spark, rows, extra=("n_shingles", "kept")).repartition(5)
    df = df.drop("n_shingles") if block == 7 else df
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                 for r in oddsketch.near_duplicates(df).collect())
    assert got == sorted((d, n, c, d == c) for d, n, c in brute(rows))


def test_block_rows_of_a_shared_passage_grow_with_the_texts(
        spark, monkeypatch):
    monkeypatch.setattr(oddsketch, "BLOCK", 8)
    monkeypatch.setattr(oddsketch, "WIDE", 16)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]

    def rows_of(n):
        given = [(i, " ".join([f"o{rng.randrange(10 ** 6)}" for _ in range(90)]
                              + passage)) for i in range(n)]
        scratch = Scratch()
        _, held = oddsketch.sketched(
            docs(spark, given).select("doc_id", "text"), "doc_id", "text",
            scratch)
        members = held.select(F.col("__row").alias("v"), F.posexplode(
            "__bands").alias("band", "key"))
        shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")) \
            .filter("n > 1")
        none = spark.createDataFrame([], "v long, root long")
        out = oddsketch._spread(
            members.join(shared, "key"), none, held.withColumnRenamed(
                "__row", "v").select("v", "__n", "__sketch", "__bands"),
            scratch).count()
        scratch.drop()
        return out
    few, many = rows_of(1000), rows_of(4000)
    # squares would be 16 times as many
    assert many < 6 * few, (few, many)


def test_repeated_rows_null_ids_and_dedupe(spark):
    same = " ".join(f"w{i}" for i in range(40))
    near = same + " more"
    rows = [(5, same), (5, same), (5, near), (3, near), (None, same),
            (None, "only null ids here today"), (None, "only null ids here today"),
            (7, ""), (7, None), (9, "quite another text than all the rest")]
    df = docs(spark, rows, extra=("v", "root", "component_id"))
    got = sorted(map(repr, ((r["doc_id"], r["component_id"], r["kept"])
                            for r in oddsketch.near_duplicates(df).collect())))
    assert got == sorted(map(repr, [
        (5, 3, False), (5, 3, False), (5, 3, False), (3, 3, True),
        (None, 3, False), (None, None, True), (None, None, True),
        (7, 7, True), (7, 7, True), (9, 9, True)]))
    kept = oddsketch.dedupe(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))
                  ) == sorted(map(repr, [
                      (3, near), (None, "only null ids here today"), (7, ""),
                      (7, None), (9, rows[9][1])]))


def test_empty_table(spark):
    assert oddsketch.near_duplicates(docs(spark, [])).count() == 0
    assert oddsketch.dedupe(docs(spark, [])).count() == 0


def test_sketches_reject_no_pair_at_the_threshold():
    rng = np.random.default_rng(3)
    most = oddsketch.most_bits(oddsketch.THRESHOLD)
    for n in (20, 400):
        for _ in range(400):
            base = rng.integers(0, 1 << 63, 8 * n, dtype="u8")
            # 7 n shared and n of each own: 7 / 9 = 0.78
            a, b = base[:8 * n], np.concatenate(
                [base[:7 * n], rng.integers(0, 1 << 63, n, dtype="u8")])
            x, y = (oddsketch.odd_sketch(oddsketch.samples(s)).view("u8")
                    for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= most
    a, b = (oddsketch.odd_sketch(oddsketch.samples(
        rng.integers(0, 1 << 63, 500, dtype="u8"))).view("u8") for _ in "ab")
    assert np.bitwise_count(a ^ b).sum() > most


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, 300), (500, 400)]
    links = spark.createDataFrame(edges, "a long, b long").orderBy(F.rand(1))
    got = {r["v"]: r["root"] for r in oddsketch.components(
        links, Scratch()).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 500: 300, 400: 300}


@pytest.mark.parametrize("wide", [3, 1000])
def test_pairs_of_one_bucket_do_not_depend_on_its_size(
        spark, monkeypatch, wide):
    monkeypatch.setattr(oddsketch, "WIDE", wide)
    monkeypatch.setattr(oddsketch, "BLOCK", 4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"o{i}x{k}" for k in range(90)) + " " + passage)
            for i in range(20)]
    rows += [(20 + i, t + f" end{i}") for i, (_, t) in enumerate(rows[:3])]
    scratch = Scratch()
    _, held = oddsketch.sketched(docs(spark, rows).select("doc_id", "text"),
                                 "doc_id", "text", scratch)
    # all members share the first band and no other
    sketches = held.select(
        F.col("__row").alias("v"), "doc_id", "__n", "__sketch",
        F.concat(F.array(F.lit(1).cast("long")), F.transform(
            F.sequence(F.lit(1), F.lit(oddsketch.BANDS - 1)),
            lambda i: F.xxhash64("__row", i))).alias("__bands"))
    buckets = sketches.select("v", F.posexplode("__bands").alias(
        "band", "key")).filter("key = 1").withColumn(
        "n", F.lit(len(rows)).cast("long"))
    of = {r["v"]: r["doc_id"] for r in sketches.collect()}
    found = oddsketch._across(
        buckets, spark.createDataFrame([], "v long, root long"),
        sketches.drop("doc_id"), 75, oddsketch.most_bits(75), False, scratch)
    assert {frozenset((of[r["v"]], of[r["p"]])) for r in found.collect()} == {
        frozenset((i, 20 + i)) for i in range(3)}
    scratch.drop()
