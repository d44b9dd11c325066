"""Near-duplicate documents by MinHash bands and odd sketches.

1. Every text becomes a set of hashed word shingles, MinHash samples, hashes
   of bands of samples, and an odd sketch: a bitmap in which each (place,
   sample) flips one bit. Texts with equal sets are one class from here on.
2. Classes that share a band are candidates. The population count of the XOR
   of two odd sketches estimates their similarity; what may reach the
   threshold is confirmed on the full sets, and confirmed links form
   components. In each band bucket one hub, the member that shares most
   buckets, is compared with all members; each member's best hub is confirmed.
3. In buckets that still hold more than one component, members of different
   components are compared, in blocks of bounded size, and each member's best
   partner is confirmed. Of a bucket of very many members, such as those of
   one shared passage, members are compared where they share one of the rarest
   shingles of both: texts that reach the threshold always do, so this leaves
   out no pair that would be confirmed.
4. In buckets that even then hold more than one component, every remaining
   pair across components that the sketches admit is confirmed. Members of
   one component need no comparison, so a large group of copies costs a few
   confirmations per member, and no link between components is left out.

Two texts at the threshold miss each other in all bands with a probability of
(1 - t**rows)**bands: 2.5e-7 at t = 0.75 with 40 bands of 4 samples; the
sketch rejects a pair at the threshold by chance less often than that. The
size of a bucket changes the way to its links, not the links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, only, python_ready, small

WORDS, THRESHOLD = 5, 75
BANDS, ROWS, SAMPLES, BITS = 40, 4, 1024, 4096
# Members of a bucket that are compared in one block.
BLOCK = 512
# Members from which on a bucket's pairs are sought by their rarest shingles.
WIDE = 2048
# Standard deviations of the sketch's estimate below the threshold that are
# still confirmed on the full sets.
SIGMAS = 5.0

_UP = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RNG = np.random.default_rng(20260117)
_A = _RNG.integers(0, 1 << 31, SAMPLES, dtype="u4") * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, SAMPLES, dtype="u4")
_PLACE = _RNG.integers(0, 1 << 63, SAMPLES, dtype="u8")
_BAND = _RNG.integers(0, 1 << 63, (BANDS, ROWS), dtype="u8") | np.uint64(1)
_POW = [pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WORDS)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a text (A-Z in
    lower case, words between ASCII white space); fewer words are one
    shingle, no words none."""
    words = (text or "").encode("utf-8", "replace").translate(_UP).split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype="u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", n)
    size = min(n, WORDS)
    s = np.full(n - size + 1, size, dtype="u8")
    for i in range(size):
        s += h[i:n - size + 1 + i] * np.uint64(_POW[i])
    return np.unique(_mix(s))


def samples(sh: np.ndarray) -> np.ndarray:
    """MinHash samples of a set."""
    x = (sh >> np.uint64(32)).astype("u4")
    out = np.full(SAMPLES, 0xFFFFFFFF, dtype="u4")
    for i in range(0, len(x), 256):
        part = x[i:i + 256, None] * _A
        part += _B
        np.minimum(out, part.min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig[:BANDS * ROWS].reshape(BANDS, ROWS).astype("u8")
    return _mix((rows * _BAND).sum(axis=1, dtype="u8")).view("i8")


def odd_sketch(sig: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as signed 64-bit words."""
    at = _mix(sig.astype("u8") * np.uint64(0x9E3779B97F4A7C15) ^ _PLACE)
    odd = np.bincount((at >> np.uint64(40)).astype("i8") % BITS,
                      minlength=BITS) & 1
    return np.packbits(odd.astype("u1")).view("<i8")


def most_bits(threshold: int, sigmas: float = SIGMAS) -> int:
    """Differing sketch bits up to which a pair is confirmed: the expectation
    at the threshold, plus ``sigmas`` deviations (of the share of differing
    samples, and of flips that cancel)."""
    t = threshold / 100
    mean = 2 * SAMPLES * (1 - t)
    bits = BITS / 2 * (1 - math.exp(-2 * mean / BITS))
    slope = math.exp(-2 * mean / BITS)
    by_sample = slope * 2 * math.sqrt(SAMPLES * t * (1 - t))
    by_flip = 2 * math.sqrt(mean * mean / (2 * BITS))
    return math.ceil(bits + sigmas * math.hypot(by_sample, by_flip))


_SKETCH = [("__n", "bigint"), ("__fa", "bigint"), ("__fb", "bigint"),
           ("__bands", "array<bigint>"), ("__sketch", "array<bigint>")]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
          pa.list_(pa.int64())]


def _fingerprint(sh: np.ndarray) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(sh.tobytes(), digest_size=16)
                         .digest(), dtype="<i8")


def _sketched(batches):
    """(row, id, text) → (row, id, sketch columns)."""
    only()
    for whole in batches:
        for b in (whole.slice(i, 1024)
                  for i in range(0, whole.num_rows, 1024)):
            n, fa, fb, bands, sketch = [], [], [], [], []
            for t in b.column(2):
                sh = shingles(t.as_py())
                n.append(len(sh))
                if not len(sh):
                    fa.append(None)
                    fb.append(None)
                    bands.append([])
                    sketch.append([])
                    continue
                a, c = _fingerprint(sh)
                sig = samples(sh)
                fa.append(int(a))
                fb.append(int(c))
                bands.append(band_keys(sig))
                sketch.append(odd_sketch(sig))
            cols = [pa.array(v, k) for v, k in
                    zip((n, fa, fb, bands, sketch), _KINDS)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *cols],
                names=b.schema.names[:2] + [c for c, _ in _SKETCH])


def _confirmed(threshold: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x = np.frombuffer(x.as_buffer(), dtype="<u8")
                y = np.frombuffer(y.as_buffer(), dtype="<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(keep), b.column(1).filter(keep)],
                names=["a", "b"])
    return run


def _matrix(col: pa.Array, rows: int, width: int) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    first = col.offsets[0].as_py()
    return col.values.to_numpy()[first:first + rows * width].reshape(
        rows, width)


def _block_pairs(threshold: int, bits: int, best: bool):
    """Rows sorted by (key, i, j): key, i, j, band, blk, v, c, n, sketch,
    bands → pairs (v, p, bits) of different components in one block (i = j) or
    across two. A pair that shares several buckets is found in the first one;
    in a bucket of one shingle (``band`` is ``BANDS``), if it shares any.
    With ``best`` only the closest partner of each member, counted for the
    member whose component has the larger name."""
    def pairs(rows):
        i, j, band, blk, v, c, n, x, keys = rows
        one = np.arange(len(v)) if i == j else np.flatnonzero(blk == i)
        two = one if i == j else np.flatnonzero(blk == j)
        near: dict[int, tuple[int, int]] = {}
        for k in one:
            other = two[two > k] if i == j else two
            other = other[c[other] != c[k]]
            if not len(other):
                continue
            apart = np.bitwise_count(x[other] ^ x[k]).sum(axis=1)
            fits = ((apart <= bits)
                    & (100 * np.minimum(n[other], n[k])
                       >= threshold * np.maximum(n[other], n[k])))
            other, apart = other[fits], apart[fits]
            new = (keys[other, :band] == keys[k, :band]).any(axis=1)
            if band < BANDS:
                new = ~new
            for o, d in zip(other[new], apart[new]):
                if not best:
                    yield v[k], v[o], d
                    continue
                a, z = (k, o) if c[k] > c[o] else (o, k)
                if a not in near or (d, v[z]) < near[a]:
                    near[a] = (d, v[z])
        for k, (d, p) in near.items():
            yield v[k], p, d

    def run(batches):
        only()
        held: list[tuple] = []
        held_key = None

        def flush():
            found = list(pairs((*held_key[1:], *(
                np.concatenate(z) for z in zip(*held)))))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(p[k]) for p in found], pa.int64())
                 for k in range(3)], names=["v", "p", "bits"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(k).to_numpy() for k in range(8)]
            x = _matrix(b.column(8), b.num_rows, BITS // 64).view("u8")
            keys = _matrix(b.column(9), b.num_rows, BANDS)
            new = np.flatnonzero((np.diff(cols[0]) != 0)
                                 | (np.diff(cols[1]) != 0)
                                 | (np.diff(cols[2]) != 0)) + 1
            cuts = [0, *new, b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                key = tuple(cols[k][s] for k in range(4))
                if held and key != held_key:
                    yield flush()
                    held = []
                held_key = key
                held.append((*(cols[k][s:e] for k in range(4, 8)), x[s:e],
                             keys[s:e]))
        if held:
            yield flush()
    return run


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(``v``, ``root``): the smallest member reachable over ``links`` (a, b),
    for every v that is not its own root. Large-star and small-star rounds,
    each written before the next; the number of rounds grows with the
    logarithm of the graph."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(edges.select(F.col("b").alias("u"),
                                                 F.col("a").alias("v")))
        else:
            both = edges.select(F.greatest("a", "b").alias("u"),
                                F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("m", "u").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.filter(F.col("v") > F.col("u")).select(
                F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")) \
                .unionByName(least.select(F.col("u").alias("a"),
                                          F.col("m").alias("b")))
        return out.filter(F.col("a") != F.col("b")).distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b")
                         .cast("decimal(38,0)"))).first()

    edges = scratch.stage(links.select("a", "b").distinct(), "links")
    before = None
    while (now := mark(edges)) != before:
        before = now
        edges = scratch.stage(star(star(edges, True), False), "links")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))


def _xor_bits(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
                for i in range(BITS // 64)), F.lit(0))


def _set_rows(batches):
    only()
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([shingles(t.as_py()).tobytes()
                                    for t in b.column(1)], pa.binary())],
            names=["v", "__set"])


def _sets(texts: DataFrame, text_col: str, nodes: DataFrame,
          scratch: Scratch) -> DataFrame:
    """(``v``, ``__set``) of the given nodes, made again from their texts."""
    of = texts.select(F.col("__row").alias("v"),
                      F.col(text_col).cast("string").alias("__t"))
    return scratch.stage(of.join(small(nodes, nodes.count()), "v").mapInArrow(
        _set_rows, "v bigint, __set binary"), "sets")


def _links(texts: DataFrame, text_col: str, pairs: DataFrame, threshold: int,
           scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    pairs = scratch.stage(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    own = Scratch()
    nodes = own.stage(pairs.select(F.col("a").alias("v")).distinct()
                      .unionByName(pairs.select(F.col("b").alias("v"))
                                   .distinct()).distinct(), "nodes")
    sets = _sets(texts, text_col, nodes, own)
    full = pairs.join(sets.select(F.col("v").alias("b"), F.col("__set")
                                  .alias("__sb")), "b") \
        .join(sets.select(F.col("v").alias("a"), F.col("__set")
                          .alias("__sa")), "a").select("a", "b", "__sa", "__sb")
    out = scratch.stage(full.mapInArrow(
        _confirmed(threshold), "a bigint, b bigint"), "confirmed")
    own.drop()
    return out


def _alike(pairs: DataFrame, sketches: DataFrame, threshold: int, bits: int
           ) -> DataFrame:
    """The pairs (v, p) that sizes and sketches let reach the threshold, with
    the ``bits`` in which their sketches differ."""
    def side(x: str) -> DataFrame:
        return sketches.select(F.col("v").alias(x), F.col("__n").alias(f"n{x}"),
                               F.col("__sketch").alias(f"s{x}"))
    return pairs.join(side("v"), "v").join(side("p"), "p").filter(
        100 * F.least("nv", "np") >= threshold * F.greatest("nv", "np")) \
        .select("v", "p", _xor_bits("sv", "sp").alias("bits")).filter(
        F.col("bits") <= bits)


def _closest(pairs: DataFrame) -> DataFrame:
    """Of the pairs (v, p, bits) the closest p of each v, as pairs (a, b)."""
    return pairs.groupBy("v").agg(F.min(F.struct("bits", "p")).alias("m")) \
        .select(F.least("v", "m.p").alias("a"),
                F.greatest("v", "m.p").alias("b")).distinct()


def sketched(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch
             ) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a row number, written once, and (row, id, sketch
    columns); only ids and texts go to Python, and no text comes back.
    ``scratch`` keeps where the texts are."""
    python_ready(docs.sparkSession)
    texts = scratch.stage(docs.select(
        F.monotonically_increasing_id().alias("__row"), "*"), "texts")
    scratch.source = (texts, text_col)
    given = texts.select("__row", F.col(id_col),
                         F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType(given.schema.fields[:2] + [
        T.StructField(c, T._parse_datatype_string(t)) for c, t in _SKETCH])
    return texts, scratch.stage(given.mapInArrow(_sketched, schema),
                                "sketched")


def _classes(held: DataFrame, texts: DataFrame, id_col: str, text_col: str,
             threshold: int, scratch: Scratch) -> DataFrame:
    """One row per class of equal sets: ``__fa``, ``__fb``, ``v`` (a row that
    stands for it), ``root`` (of its component), ``__least`` (smallest id)."""
    stage = scratch.stage
    bits = most_bits(threshold)
    # null ids sort last, so a class with any id has one
    classes = stage(held.filter("__n > 0").groupBy("__fa", "__fb").agg(
        F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), "__row"))
        .alias("r")).select("__fa", "__fb", F.col("r.__row").alias("v"),
                            F.col(f"r.{id_col}").alias("__least")), "classes")
    reps = held.select(F.col("__row").alias("v"), "__bands").join(
        classes.select("v"), "v")
    members = reps.select("v", F.posexplode("__bands").alias("band", "key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > 1)
    buckets = stage(members.join(shared, "key"), "buckets")
    sketches = held.select(F.col("__row").alias("v"), "__n", "__sketch",
                           "__bands").join(
        stage(buckets.select("v").distinct(), "members"), "v")
    sketches = stage(sketches, "member-sketches")

    weight = buckets.groupBy("v").agg(F.sum("n").alias("w"))
    hubs = buckets.join(weight, "v").groupBy("key").agg(
        F.max(F.struct("w", -F.col("v"))).alias("h")).select(
        "key", (-F.col("h")["col2"]).alias("p"))
    stars = buckets.join(hubs, "key").filter(F.col("v") != F.col("p")).select(
        "v", "p").distinct()
    tested = stage(_closest(_alike(stars, sketches, threshold, bits)), "stars")
    roots = components(_links(texts, text_col, tested, threshold, scratch),
                       scratch)

    near = stage(_closest(_across(buckets, roots, sketches, threshold, bits,
                                  True, scratch)).join(
        tested, ["a", "b"], "left_anti"), "partners")
    tested = tested.unionByName(near)
    roots = _extended(roots, _links(texts, text_col, near, threshold, scratch),
                      scratch)

    rest = _across(buckets, roots, sketches, threshold, bits, False, scratch
                   ).select(
        F.least("v", "p").alias("a"), F.greatest("v", "p").alias("b")) \
        .distinct().join(tested, ["a", "b"], "left_anti")
    roots = _extended(roots, _links(texts, text_col, rest, threshold, scratch),
                      scratch)
    return stage(_rooted(classes, roots).withColumnRenamed("c", "root"),
                 "rooted")


def _extended(roots: DataFrame, links: DataFrame, scratch: Scratch
              ) -> DataFrame:
    """The components of ``roots`` joined by further links."""
    if links.isEmpty():
        return roots
    return components(roots.select(
        F.col("v").alias("a"), F.col("root").alias("b")).unionByName(links),
        scratch)


def _rooted(df: DataFrame, roots: DataFrame) -> DataFrame:
    """``df`` (with ``v``) with the component ``c`` of each v."""
    return df.join(roots, "v", "left").withColumn(
        "c", F.coalesce("root", "v")).drop("root")


def _mixed(members: DataFrame) -> DataFrame:
    """The rows of ``members`` (key, c) whose bucket holds several components,
    with the number ``n`` of its members."""
    return members.join(members.groupBy("key").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"),
        F.count(F.lit(1)).alias("n")).filter("lo <> hi")
        .select("key", "n"), "key")


def _items(batches):
    """(v, set) → (v, shingle)."""
    only()
    for b in batches:
        for v, held in zip(b.column(0).to_pylist(), b.column(1)):
            sh = np.frombuffer(held.as_buffer(), dtype="<i8")
            for at in range(0, len(sh), 1 << 16):
                part = sh[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), v, "i8")), pa.array(part)],
                    names=["v", "s"])


def _by_shingle(wide: DataFrame, threshold: int, scratch: Scratch
                ) -> DataFrame:
    """Members (v, c) of wide buckets → buckets (``key``) of those that share
    a shingle among the rarest of each, ``band`` = ``BANDS``.

    At the threshold t two sets share at least ceil(t * n) of the n shingles
    of either. In any one order of shingles the first of these is therefore
    among the first n - ceil(t * n) + 1 of both sets, so no such pair is left
    out. The order is by the number of members that hold a shingle: what many
    share comes last, and shingles of one member alone make no bucket."""
    own = Scratch()
    members = own.stage(wide.select("v", "c").distinct(), "wide-members")
    sets = _sets(*scratch.source, members.select("v"), own)
    items = sets.mapInArrow(_items, "v bigint, s bigint")
    often = own.stage(items.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
                      .filter("n > 1"), "shared-shingles")
    ranked = items.join(often, "s", "left").groupBy("v").agg(F.array_sort(
        F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "s")))
        .alias("x"))
    first = F.expr(f"slice(x, 1, cast(size(x) - (cast(size(x) as long) * "
                   f"{threshold} + 99) div 100 + 1 as int))")
    out = scratch.stage(_mixed(ranked.select("v", F.explode(first).alias("x"))
                               .filter("x.n > 1").join(members, "v").select(
        F.col("x.s").alias("key"), F.lit(BANDS).alias("band"), "v", "c")),
        "by-shingle")
    own.drop()
    return out


def _spread(buckets: DataFrame, roots: DataFrame, sketches: DataFrame,
            scratch: Scratch, threshold: int = THRESHOLD) -> DataFrame:
    """The members of every bucket that holds several components, once per
    pair of blocks (``key``, ``i``, ``j``) that they are compared in.

    A bucket of n members in b blocks has b (b + 1) / 2 pairs of blocks; each
    member goes to the b pairs that hold its block, so a task's share of a
    bucket is two blocks however large the bucket is. The members of buckets
    of more than ``WIDE`` are compared in buckets of their rarest shingles
    instead (:func:`_by_shingle`): texts that share a passage and little else
    meet in none of them."""
    rest = scratch.stage(_mixed(_rooted(buckets.drop("n"), roots)), "mixed")
    wide = rest.filter(F.col("n") > WIDE)
    if not wide.isEmpty():
        rest = rest.filter(F.col("n") <= WIDE).unionByName(
            _by_shingle(wide, threshold, scratch))
    return rest.withColumn(
        "blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")).withColumn(
        "blk", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).join(
        sketches, "v").select(
        "key", "band", "blk", "v", "c", "__n", "__sketch", "__bands",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")) \
        .select("key", F.least("blk", "o").alias("i"), F.greatest("blk", "o")
                .alias("j"), "band", "blk", "v", "c", "__n", "__sketch",
                "__bands")


def _across(buckets: DataFrame, roots: DataFrame, sketches: DataFrame,
            threshold: int, bits: int, best: bool, scratch: Scratch
            ) -> DataFrame:
    """(v, p, bits) for members of different components in one bucket that
    sizes and sketches let reach the threshold (see :func:`_block_pairs`)."""
    where = ["key", "i", "j"]
    return _spread(buckets, roots, sketches, scratch, threshold) \
        .repartition(*where) \
        .sortWithinPartitions(*where).mapInArrow(
        _block_pairs(threshold, bits, best), "v bigint, p bigint, bits bigint")


def _resolved(held: DataFrame, texts: DataFrame, id_col: str, text_col: str,
              threshold: int, scratch: Scratch) -> DataFrame:
    """``held`` with ``__component`` (its smallest id) and ``__root``."""
    classes = _classes(held, texts, id_col, text_col, threshold, scratch)
    least = classes.groupBy("root").agg(F.min("__least").alias("__component"))
    named = scratch.stage(classes.join(least, "root").select(
        "__fa", "__fb", F.col("root").alias("__root"), "__component"),
        "components")
    full = held.filter("__n > 0").join(named, ["__fa", "__fb"])
    return full.unionByName(held.filter("__n = 0").withColumns({
        "__root": F.col("__row"), "__component": F.col(id_col)}))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", threshold: int = THRESHOLD
                    ) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles`` (size of its
    set), ``component_id`` (the smallest id reachable over links of at least
    ``threshold`` percent similarity), ``kept`` (whether that is its own).

    * null, empty or blank text: an empty set, linked with nothing
    * texts with fewer than five words: the whole sequence is one shingle
    * repeated rows: in one component; each is kept if its id is the smallest
    * null ids: linked by their texts, but never the smallest id; a component
      without any id has a null ``component_id`` and its rows are kept
    * very long texts: whole sets
    * other columns are ignored; an empty table gives no rows"""
    scratch = Scratch()
    texts, held = sketched(docs.select(id_col, text_col), id_col, text_col,
                           scratch)
    out = _resolved(held, texts, id_col, text_col, threshold, scratch)
    out = scratch.stage(out.select(
        id_col, F.col("__n").alias("n_shingles"),
        F.col("__component").alias("component_id"), F.coalesce(
            F.col(id_col) == F.col("__component"),
            F.col("__component").isNull()).alias("kept")), "near-duplicates")
    scratch.drop(out)
    return out


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component (that of the smallest id, of
    equal ids one row), and every row without words."""
    scratch = Scratch()
    texts, held = sketched(docs, id_col, text_col, scratch)
    out = _resolved(held, texts, id_col, text_col, threshold, scratch)
    first = scratch.stage(out.groupBy("__root").agg(F.min(F.struct(
        F.col(id_col).isNull(), F.col(id_col), "__row")).alias("r"))
        .select(F.col("r.__row").alias("__row")), "kept-rows")
    rows = first.count()
    scratch.drop(texts, first)
    return texts.join(small(first, rows), "__row").select(*docs.columns)


def near_duplicates_sql(rel: str, threshold: int = THRESHOLD) -> str:
    """DuckDB SQL for :func:`near_duplicates` (unique ``doc_id``): every pair
    of different sets that shares a shingle is compared in full."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(
    coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS w FROM {rel}),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {WORDS - 2}),
      lambda i: array_to_string(list_slice(w, i, i + {WORDS - 1}), ' ')) END))
    AS s FROM words),
classes AS (SELECT md5(array_to_string(s, chr(10))) AS f, len(s) AS n,
    min(doc_id) AS v, any_value(s) AS s FROM sets WHERE len(s) > 0
    GROUP BY md5(array_to_string(s, chr(10))), len(s)),
sh AS (SELECT v, n, unnest(s) AS g FROM classes),
links AS (SELECT a.v AS a, b.v AS b FROM sh a JOIN sh b ON a.g = b.g
    AND a.v < b.v GROUP BY a.v, b.v
    HAVING 100 * count(*) >= {threshold}
      * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(v, r) AS (SELECT v, v FROM classes
    UNION SELECT reach.v, edges.b FROM reach JOIN edges ON reach.r = edges.a),
roots AS (SELECT v, min(r) AS root FROM reach GROUP BY v),
named AS (SELECT f, n, root FROM classes JOIN roots USING (v))
SELECT sets.doc_id, len(s) AS n_shingles,
  coalesce(root, sets.doc_id) AS component_id,
  sets.doc_id = coalesce(root, sets.doc_id) AS kept
FROM sets LEFT JOIN named ON md5(array_to_string(s, chr(10))) = named.f
  AND len(s) = named.n"""
