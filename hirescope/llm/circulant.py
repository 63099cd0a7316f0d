"""Near duplicates by circulant MinHash.

A document is the set of its hashed 4-word shingles. A first permutation of the
hash universe (a 64-bit finaliser, cut to 32 bits) breaks up the tokens' own
structure; a second one, circularly shifted by ``k``, gives signature
coordinate ``k`` - the smallest of ``pi(sigma(token) + k mod 2^32)``. So two
permutations make all ``BANDS * ROWS`` coordinates.

Sets that agree in a band of ``ROWS`` coordinates meet in a bucket. A link
(Jaccard similarity ``PERCENT``) misses every bucket with a probability of
(1 - 0.8^5)^40, about 1e-7 at the threshold and less above it. All pairs that
meet are decided by their whole sets.

Groups of copies meet in the same buckets. Equal sets are one class. In every
bucket each class is first compared with one member only, that of the most
company over all buckets (the text that others are copies of has more than the
copies); connected components follow, and only classes of different components
that still share a bucket are paired. What no other of these classes has of a
class's shingles is in no intersection, which rules most pairs out by two
numbers. In buckets of more than ``CROWD`` classes, so are the rare shingles,
which at most ``CROWD`` of these classes have: two classes that share none of
them have at most their other shingles in common, and classes that share some
meet in the rare shingles' own lists, which are short. So the pairs grow with a
group, not with its square.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, semi_by_bloom, ship, split_by_bloom, stored
from .jaccard import word_hashes

ship(__name__)

PERCENT = 80  # Jaccard similarity of a link, in hundredths
SHINGLE = 4  # words
BANDS, ROWS = 40, 5
CROWD = 32  # classes of a bucket that are paired at once
_BLOCK = 2048  # tokens in one block of the signature's table

_U = np.uint64
_PLACE = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]  # a factor for each word


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multiplications."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingles(text: str | None) -> np.ndarray:
    """The set of hashed shingles, sorted. Fewer words than a shingle: the
    whole sequence is one; no words: none."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(len(w), SHINGLE)
    with np.errstate(over="ignore"):
        out = np.full(len(w) - k + 1, _U(k), dtype=np.uint64)
        for i in range(k):
            out += w[i:len(w) - k + 1 + i] * _PLACE[i]
    return np.unique(_mixed(out))


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the whole set."""
    with np.errstate(over="ignore"):
        return tuple(int(_mixed(s + seed).sum(dtype=np.uint64).astype(np.int64)) for seed in (_U(29), _U(0xA24BAED4963EE407)))


def sigma(s: np.ndarray) -> np.ndarray:
    """First permutation: the tokens' places in the universe of 2^32."""
    return (_mixed(s ^ _U(0x5851F42D4C957F2D)) >> _U(32)).astype(np.uint32)


def pi(x: np.ndarray) -> np.ndarray:
    """Second permutation of the universe (a bijection of 32-bit numbers)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]


def signature(s: np.ndarray) -> np.ndarray:
    """All coordinates: the least value of the second permutation at every
    circular shift of the first one's places."""
    at, least = sigma(s), np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(at), _BLOCK):
        np.minimum(least, pi(at[start:start + _BLOCK] + _SHIFTS).min(axis=1), out=least)
    return least


_BAND = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
_ROW = _mixed(np.arange(101, 101 + ROWS, dtype=np.uint64)) | _U(1)


def buckets(s: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band."""
    rows = signature(s).astype(np.uint64).reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        return _mixed((rows * _ROW).sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


# ------------------------------------------------------------ Spark passes --

def _digests(docs: DataFrame) -> DataFrame:
    """Two 64-bit digests of the text beside it: rows of equal digests have
    equal texts, whatever their doc_id is."""
    return docs.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})


def _signed(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, text digests, set size, set key; the bucket
    keys with the first document of a set that a task meets."""

    def run(batches):
        seen = set()
        for pdf in batches:
            rows = []
            for doc, text, d1, d2 in zip(pdf["doc_id"], pdf["text"], pdf["d1"], pdf["d2"]):
                s = shingles(text)
                k1, k2 = set_key(s)
                fresh = len(s) > 0 and (k1, k2) not in seen
                if fresh:
                    seen.add((k1, k2))
                rows.append((doc, d1, d2, len(s), k1, k2, buckets(s) if fresh else None))
            yield pd.DataFrame(rows, columns=["doc_id", "d1", "d2", "n", "k1", "k2", "buckets"]).astype({"doc_id": "Int64"})

    kind = "doc_id long, d1 long, d2 long, n int, k1 long, k2 long, buckets array<long>"
    return stored(_digests(docs).mapInPandas(run, kind), "circulant-signed")


def _class() -> Column:
    return F.struct("k1", "k2")


def _posts(signed: DataFrame) -> DataFrame:
    """(bucket, k1, k2, n, size) of buckets that hold two classes or more. These
    buckets are found by two numbers each, combined before the shuffle; of all
    other entries only what a bounded bitmap lets through is moved."""
    entries = signed.select(F.explode("buckets").alias("bucket"), "k1", "k2", "n")
    full = entries.groupBy("bucket").agg(F.min("k1").alias("x"), F.max("k1").alias("y")).where("x <> y").select("bucket")
    met = stored(semi_by_bloom(entries, "bucket", stored(full, "circulant-buckets"), "circulant-bloom").distinct(), "circulant-posts")
    return stored(met.join(met.groupBy("bucket").agg(F.count("*").alias("size")), "bucket"), "circulant-met")


def _sets(docs: DataFrame, signed: DataFrame, posts: DataFrame) -> DataFrame:
    """(k1, k2, set) of every class in ``posts``, read from one text of each."""
    wanted = posts.select("k1", "k2").distinct()
    texts = signed.join(wanted, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.min(F.struct("d1", "d2")).alias("d"))
    texts = stored(texts.select("d.d1", "d.d2").distinct(), "circulant-texts")

    def run(batches):
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                s = shingles(text)
                rows.append((*set_key(s), s.view(np.int64)))
            yield pd.DataFrame(rows, columns=["k1", "k2", "set"])

    found = semi_by_bloom(_digests(docs.select("text")), "d1", texts, "circulant-bloom")
    one = found.groupBy("d1", "d2").agg(F.first("text").alias("text")).select("text")  # one text of a class: one row a class
    return stored(one.mapInPandas(run, "k1 long, k2 long, set array<long>"), "circulant-sets")


def _similar(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, an, bn) that are links, by their whole sets."""
    a, b = (sets.select(F.struct("k1", "k2").alias(e), F.col("set").alias(f"{e}set")) for e in "ab")
    few = stored(pairs.select("a").distinct(), "circulant-ends")  # one text is the first of many pairs
    pairs = pairs.join(b, "b").join(a.join(few, "a", "left_semi"), "a")
    both = F.size(F.array_intersect("aset", "bset"))
    return stored(pairs.where(100 * both >= PERCENT * (F.col("an") + F.col("bn") - both)).select("a", "b"), "circulant-links")


def _placed(held: DataFrame) -> DataFrame:
    """``held`` with ``where``: all buckets in which it has the class, in order
    (``BANDS`` at most)."""
    return held.join(held.groupBy("c").agg(F.sort_array(F.collect_set("bucket")).alias("where")), "c")


def _pairs(held: DataFrame, at: str, *, shared: bool) -> DataFrame:
    """(a, an, b, bn): classes of different components that meet in a list of
    ``held`` (``at``, c, n, comp, most) and may have enough in common: what is
    not rare in either (``most``) and, where the lists are those of rare
    shingles (``shared``), those that they meet in."""
    own = [c for c in ("c", "n", "comp", "most", "main", "where") if c in held.columns]
    a, b = (held.select(at, *[F.col(c).alias(e + c) for c in own]) for e in "ab")
    least = F.least("amost", "bmost")

    def enough(common: Column) -> Column:
        return 100 * common >= PERCENT * (F.col("an") + F.col("bn") - common)

    apart = (F.col("acomp") != F.col("bcomp")) & _similar(F.col("an"), F.col("bn"))
    ends = [F.col("ac").alias("a"), F.col("an"), F.col("bc").alias("b"), F.col("bn")]
    if shared:
        met = a.join(b, at).where((F.col("ac") < F.col("bc")) & apart).groupBy(*ends, least.alias("least")).agg(F.count("*").alias("votes"))
        return met.where(enough(F.col("least") + F.col("votes"))).drop("least", "votes")
    # classes outside a bucket's main component against all others; in long lists
    # each pair in the first bucket that it has in common, and only there
    once = (F.col("bmain") | (F.col("ac") < F.col("bc"))) & apart & enough(least)
    if "where" in own:
        once &= F.get(F.array_intersect("awhere", "bwhere"), 0) == F.col(at)
    return a.where("not amain").join(b, at).where(once).select(*ends)


def _rest(known: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, an, b, bn): the pairs that may still be links between components."""
    held = known.select("bucket", F.struct("rank.k1", "rank.k2").alias("c"), "n", "rank.company").join(groups.select(F.col("id").alias("c"), "comp"), "c", "left")
    held = stored(held.withColumn("comp", F.coalesce("comp", "c")), "circulant-labelled")
    mixed = held.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("members"),
                                       F.max(F.struct("company", "comp")).alias("main")).where("x <> y")
    held = held.drop("company").join(mixed.select("bucket", "members", F.col("main.comp").alias("maincomp")), "bucket")
    held = stored(held.withColumn("main", F.col("comp") == F.col("maincomp")).drop("maincomp"), "circulant-mixed")
    # shingles that no other class of any mixed bucket has (told by k1 alone)
    # (a set that the bitmap lets through besides makes fewer shingles count as alone, so nothing is lost, and no set is moved)
    ends = stored(held.select("c").distinct(), "circulant-mixed-classes")
    tokens = split_by_bloom(sets.select(_class().alias("c"), "set"), "c", ends, "circulant-mixed-bloom")[0].select(
        F.col("c.k1").alias("k"), F.explode("set").alias("token"))
    alone = tokens.groupBy("token").agg(F.min("k").alias("k"), F.max("k").alias("z")).where("k = z")
    alone = stored(alone.groupBy("k").agg(F.count("*").cast("int").alias("alone")), "circulant-alone")
    held = held.withColumn("k", F.col("c.k1")).join(alone, "k", "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0))).drop("k", "alone")
    held = stored(held.where(100 * F.col("most") >= PERCENT * F.col("n")), "circulant-left")
    few = held.where(F.col("members") <= CROWD)
    many = held.where(F.col("members") > CROWD).drop("most")
    crowd = stored(many.select("c", "n", "comp").distinct(), "circulant-crowd")
    # shingles that few of the crowd have
    tokens = crowd.join(sets.select(_class().alias("c"), "set"), "c").select(F.explode("set").alias("token"), "c", "n", "comp")
    tokens = stored(tokens, "circulant-tokens")
    rare = tokens.groupBy("token").agg(F.count("*").alias("members")).where(F.col("members") <= CROWD)
    rare = stored(tokens.join(rare, "token"), "circulant-rare")
    own = stored(rare.groupBy("c").agg(F.count("*").cast("int").alias("own")), "circulant-own")

    def bounded(df: DataFrame) -> DataFrame:
        return df.join(own, "c", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0)))

    many = stored(bounded(many).where(100 * F.col("most") >= PERCENT * F.col("n")), "circulant-many")
    rare = stored(bounded(rare.where("members > 1")), "circulant-rare-lists")
    within = _pairs(few, "bucket", shared=False).distinct().union(_pairs(_placed(many), "bucket", shared=False))
    return within.union(_pairs(rare, "token", shared=True)).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Null and wordless texts have no shingles and are their own component. Texts
    of fewer words than a shingle have one. A row that repeats a doc_id is a
    document of its own with that id; a null doc_id links like any other, counts
    as no smaller id, and stays null where no document of its component has an
    id. An empty table gives no rows. Further columns are ignored.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = _signed(docs)
    posts = _posts(signed)
    sets = _sets(docs, signed, posts)

    # each class against the member of the most company in its bucket
    company = stored(posts.groupBy("k1", "k2").agg(F.sum("size").alias("company")), "circulant-company")
    known = stored(posts.join(company, ["k1", "k2"]).select("bucket", "n", F.struct("company", "k1", "k2").alias("rank")), "circulant-ranked")
    centres = stored(known.groupBy("bucket").agg(F.max(F.struct("rank", "n")).alias("centre")), "circulant-centres")
    stars = known.join(centres, "bucket").select(
        F.struct("centre.rank.k1", "centre.rank.k2").alias("a"), F.col("centre.n").alias("an"),
        F.struct("rank.k1", "rank.k2").alias("b"), F.col("n").alias("bn"))
    stars = stars.where((F.col("a") != F.col("b")) & _similar(F.col("an"), F.col("bn"))).distinct()
    links = _verified(stored(stars, "circulant-stars"), sets)
    groups = components(links, "circulant-groups")

    rest = stored(_rest(known, groups, sets), "circulant-rest")
    if not rest.isEmpty():
        links = links.union(_verified(rest, sets))
        groups = components(links, "circulant-groups")

    label = groups.select("id.k1", "id.k2", "comp")
    first = signed.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    named = first.join(label, ["k1", "k2"], "left").where("copies > 1 or comp is not null").withColumn("comp", F.coalesce("comp", _class()))
    named = stored(named, "circulant-named")
    smallest = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = stored(named.join(smallest, "comp").select("k1", "k2", "component_id"), "circulant-components")
    return signed.join(named, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def kept_first(groups: DataFrame) -> DataFrame:
    """``groups`` with ``kept``: the documents that stand for their component
    (without an id: if no document of it has one)."""
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
