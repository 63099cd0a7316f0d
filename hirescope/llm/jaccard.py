"""N-gram Jaccard join with several global token orders.

Documents are sets of hashed 5-word shingles; equal sets are one class. Two
sets of a Jaccard similarity of ``T`` or more share at least ``l`` tokens among
the first ``|x| - ceil(T |x|) + l`` of either, under *any* global order of the
tokens (``l`` grows with the set). The first order generates candidates: the
tokens of these prefixes are shuffled, classes that meet are counted. Pairs
must then share as many prefix tokens under two more orders - the filters are
intersected - before their whole sets are compared.

Every order is by heat, then by a hash of its own. Heat is how far a token's
count in a sketch of fixed size over all documents stands above the sketch's
noise, so that passages which many documents hold come last in every order
and are rarely in a prefix. Any order is right; heat only keeps posting lists
short.

Big groups of near copies share nearly all their prefix tokens. Each posting
list's members are first compared with one member only - on lists of hot
tokens the one with the fewest cold shingles, which is the text that the
others are copies of, or close to it; connected components follow; and only
pairs that are still in different components are generated from posting lists
that hold more than one. No link between components can be missed, and a group
of ``g`` near copies costs about ``g`` comparisons instead of ``g * g / 2``.

Members of long lists that are copies of one text, but too far from it and from
each other to be linked, would still make a pair each. They are told by their
rare shingles, which at most ``CROWD`` members of long lists have. Two members
that share none of these have at most their other shingles in common, which
rules most pairs out by a few numbers (how many of these each has in ``PARTS``
parts of all shingles: copies that lack different shingles of the text have
less in common than either has); members that do share some meet in the
rare shingles' own lists, which are short, and are bounded there by how many
they share. So pairs grow with a group, not with its square.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import arrow_batches, components, discard, semi_by_bloom, ship, stored

ship(__name__)

PERCENT = 80  # Jaccard similarity of a link, in hundredths
SHINGLE = 5  # words
SKETCH = 1 << 22  # counters; 16 MB in a task, 4 MB (one byte each) on the driver
CROWD = 32  # members of a long list
PARTS = 16  # counts of a class's shingles that are not rare, by a hash of the shingle
_CHUNK = 1 << 16  # counters in a row of the sketch table
_PIECES = 64  # rows of the sketch table that are summed at a time (16 MB)

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multiplications."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64))  # a random value for each byte
_PLACE = _mixed(np.arange(1000, 1000 + SHINGLE, dtype=np.uint64)) | _U(1)  # a factor for each word of a shingle
_BASE = _U(0x9E3779B97F4A7C15)
_SEEDS = [_U(0), _U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25)]  # one order each


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([[_U(1)], np.full(max(n - 1, 0), _BASE, dtype=np.uint64)]))


_POWERS = _powers(256)


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash for each word of ``text``: A-Z lower-cased, words end at
    the six ASCII white-space characters and nowhere else."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").lower(), dtype=np.uint8)
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    offset = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(offset, lengths)
    with np.errstate(over="ignore"):
        return _mixed(np.add.reduceat(_BYTE[raw[word]] * powers[place], offset) + lengths.astype(np.uint64))


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


def signature(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the whole set."""
    with np.errstate(over="ignore"):
        return tuple(int(_mixed(s + seed).sum(dtype=np.uint64).astype(np.int64)) for seed in (_U(11), _U(0xC2B2AE3D27D4EB4F)))


def least_shared(n):
    """Prefix tokens that two linked sets share at least (of the smaller's)."""
    return 1 + n // 20


def prefix(s: np.ndarray, heat: np.ndarray, order: int) -> np.ndarray:
    """The tokens of ``s`` that come first under the order."""
    n = len(s)
    size = min(n, n - (PERCENT * n + 99) // 100 + least_shared(n))
    key = (heat[s & _U(SKETCH - 1)].astype(np.uint64) << _U(56)) | (_mixed(s ^ _SEEDS[order]) >> _U(8))
    return s if size == n else s[np.argpartition(key, size - 1)[:size]]


def _packed(counts: np.ndarray) -> bytes:
    """Counters in the narrowest unsigned integers that hold them all."""
    return counts.astype(np.min_scalar_type(counts.max())).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"u{len(raw) // _CHUNK}")


# ------------------------------------------------------------ Spark passes --

def _digested(docs: DataFrame) -> DataFrame:
    """Two 64-bit digests of the text beside it: rows of equal digests have
    equal texts, whatever their doc_id is."""
    return docs.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})


def _signed(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text digests d1 and d2, n, s1, s2), and the
    sketch of the tokens of all distinct sets of each task, in rows of ``_CHUNK``
    counters."""

    def run(batches):
        counts, seen = np.zeros(SKETCH, dtype=np.int32), set()
        for pdf in batches:
            rows, fresh = [], []
            for doc, text, d1, d2 in zip(pdf["doc_id"], pdf["text"], pdf["d1"], pdf["d2"]):
                s = shingles(text)
                s1, s2 = signature(s)
                rows.append((doc, d1, d2, len(s), s1, s2))
                if (s1, s2) not in seen:
                    seen.add((s1, s2))
                    fresh.append(s)
            if fresh:
                np.add.at(counts, (np.concatenate(fresh) & _U(SKETCH - 1)).astype(np.int64), 1)
            yield pd.DataFrame(rows, columns=["doc_id", "d1", "d2", "n", "s1", "s2"]).astype({"doc_id": "Int64"}).assign(chunk=-1, counts=None)
        for c in range(SKETCH // _CHUNK):
            part = counts[c * _CHUNK:(c + 1) * _CHUNK]
            if part.any():
                yield pd.DataFrame({"doc_id": pd.array([None], dtype="Int64"), "d1": 0, "d2": 0, "n": 0, "s1": 0, "s2": 0,
                                    "chunk": c, "counts": [_packed(part)]})

    kind = "doc_id long, d1 long, d2 long, n int, s1 long, s2 long, chunk int, counts binary"
    return stored(_digested(docs).mapInPandas(run, kind), "jaccard-signed")


def _heat(signed: DataFrame) -> np.ndarray:
    """Heat of each counter: 0 up to two standard deviations (and two) above the
    mean, then in half-octaves of the excess. Task sketches are summed chunk by
    chunk, some ``_PIECES`` at a time until one is left, so a group is bounded
    however many tasks there were; one byte a counter reaches the driver."""

    def total(key, pdf):
        out = np.zeros(_CHUNK, dtype=np.int64)
        for raw in pdf["counts"]:
            out += _unpacked(raw).astype(np.int64)
        return pd.DataFrame({"chunk": [key[0]], "counts": [_packed(out)]})

    sums = signed.where("chunk >= 0").select("chunk", "counts")
    most = sums.groupBy("chunk").count().agg(F.max("count")).first()[0] or 0
    while most:
        salts = most // _PIECES  # 0: all that is left of a chunk is one group
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2 * salts + 1)).cast("int").alias("part")
        sums = stored(sums.select("chunk", part, "counts").groupBy("chunk", "part").applyInPandas(total, "chunk int, counts binary"), "jaccard-sketch")
        most = 2 * salts + 1 if salts else 0
    n = signed.where("chunk < 0").agg(F.sum("n")).first()[0] or 0
    mean = n / SKETCH

    def bits(batches):
        for pdf in batches:
            out = []
            for raw in pdf["counts"]:
                over = (_unpacked(raw).astype(np.int64) - mean) / (2 * np.sqrt(mean) + 2)
                out.append(np.where(over <= 1, 0, np.minimum(1 + 2 * np.log2(np.maximum(over, 1)), 255)).astype(np.uint8).tobytes())
            yield pd.DataFrame({"chunk": pdf["chunk"], "heat": out})

    heat = np.zeros(SKETCH, dtype=np.uint8)
    for row in sums.mapInPandas(bits, "chunk int, heat binary").collect():  # SKETCH / _CHUNK rows
        heat[row["chunk"] * _CHUNK:(row["chunk"] + 1) * _CHUNK] = np.frombuffer(row["heat"], dtype=np.uint8)
    return heat


def _prefixes(docs: DataFrame, heat) -> DataFrame:
    """(s1, n, rank, cold, hot): the first order's prefix of every set, its cold and
    its hot tokens, written once; sets that a task meets again are left out.
    ``rank`` is, where there are hot tokens, the set's cold shingles in
    thousandths."""

    def run(batches):
        seen = set()
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                s = shingles(text)
                if not len(s):
                    continue
                sign = signature(s)
                if sign in seen:
                    continue
                seen.add(sign)
                p = prefix(s, heat.value, 0)
                hot = heat.value[p & _U(SKETCH - 1)] > 0
                rank = 1000 * np.count_nonzero(heat.value[s & _U(SKETCH - 1)] == 0) // len(s) if hot.any() else 0
                p = p.view(np.int64)
                rows.append((sign[0], len(s), rank, p[~hot], p[hot]))
            if rows:
                yield pd.DataFrame(rows, columns=["s1", "n", "rank", "cold", "hot"])

    return stored(docs.select("text").mapInPandas(run, "s1 long, n int, rank int, cold array<long>, hot array<long>"), "jaccard-prefixes")


def _shared_posts(docs: DataFrame, heat, sets: DataFrame | None = None) -> DataFrame:
    """Posts of the tokens that two or more classes hold, each with the first
    class of its list (by rank, then by signature). Lists of cold tokens are
    short, about the sketch's mean at most, and are read where they meet; hot
    ones are aggregated before they move, and joined. ``sets``: the prefixes,
    where they are cut already."""
    me = F.struct("s1", "n")
    same = Window.partitionBy("token")
    sets = _prefixes(docs, heat) if sets is None else sets
    cold = sets.select(F.explode("cold").alias("token"), "s1", "n")
    cold = cold.select("token", "s1", "n", F.min(me).over(same).alias("p"), F.max(me).over(same).alias("q"))
    cold = cold.where("p <> q").dropDuplicates(["token", "s1", "n"]).select("token", "s1", "n", "p")
    hot = sets.select(F.explode("hot").alias("token"), "rank", "s1", "n").distinct()
    first = F.min(F.struct("rank", "s1", "n"))
    ends = hot.groupBy("token").agg(first.alias("first"), F.min(me).alias("p"), F.max(me).alias("q")).where("p <> q")
    ends = stored(ends.select("token", F.struct("first.s1", "first.n").alias("p")), "jaccard-hot-lists")
    posts = stored(cold.unionByName(hot.join(ends, "token").select("token", "s1", "n", "p")), "jaccard-posts")
    discard(ends)
    return posts


def _able(held: DataFrame) -> DataFrame:
    """The rows of ``held`` (token, s1, n, comp) whose class has as many as a link of
    its takes votes at least. The votes of a pair are lists that both are in, so
    most classes whose texts only have some common shingles fall away here, in
    long lists too."""
    partner = f"({PERCENT} * cast(n as bigint) + 99) div 100"  # shingles of the smallest that it can be linked to
    able = held.groupBy("s1", "n").agg(F.count("*").alias("lists")).where(f"lists >= 1 + ({partner}) div 20").select("s1", "n")
    return held.join(able, ["s1", "n"], "left_semi")


_SIMILAR = f"100 * least(an, bn) >= {PERCENT} * greatest(an, bn)"
_ENOUGH = "votes >= 1 + least(an, bn) div 20"


def _texts_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each class (s1, n) in ``wanted``, by the digests of its text: a
    bounded bitmap thins the scan before the exact join."""
    reps = stored(wanted.join(classes, ["s1", "n"]).select("rep.d1", "rep.d2").distinct(), "jaccard-wanted")
    found = semi_by_bloom(_digested(docs.select("text")), "d1", reps, "jaccard-bloom")
    return found.groupBy("d1", "d2").agg(F.first("text").alias("text")).select("text")


def _tokens_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(token, s1, n): all shingles of the classes in ``wanted``."""

    def run(batches):
        for pdf in batches:
            sets = [s for s in map(shingles, pdf["text"]) if len(s)]
            if sets:
                sizes = list(map(len, sets))
                yield pd.DataFrame({"token": np.concatenate(sets).view(np.int64), "s1": np.repeat([signature(s)[0] for s in sets], sizes),
                                    "n": np.repeat(sizes, sizes)})

    return _texts_of(docs, classes, wanted).mapInPandas(run, "token long, s1 long, n int").distinct()


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, heat) -> DataFrame:
    """(s1, n, set, second, third) of the classes in ``pairs``, one row each: whole
    sets and the prefixes under the other orders."""
    ends = pairs.select(F.col("as1").alias("s1"), F.col("an").alias("n")).union(pairs.select("bs1", "bn")).distinct()

    def run(batches):
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                s = shingles(text)
                rows.append((signature(s)[0], len(s), s.tobytes(), *(np.sort(prefix(s, heat.value, o)).tobytes() for o in (1, 2))))
            yield pd.DataFrame(rows, columns=["s1", "n", "set", "second", "third"])

    return stored(_texts_of(docs, classes, ends).mapInPandas(run, "s1 long, n int, set binary, second binary, third binary"), "jaccard-sets")


def _common(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64), assume_unique=True))


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, heat) -> DataFrame:
    """The pairs (as1, an, bs1, bn) that are links: first the filters of the
    second and third order, then the whole sets."""
    pairs = pairs.select("as1", "an", "bs1", "bn")
    sets = _sets(docs, classes, pairs, heat)

    def meet(df: DataFrame, *cols: str) -> DataFrame:
        for e in "ab":
            side = sets.select(F.col("s1").alias(f"{e}s1"), F.col("n").alias(f"{e}n"), *[F.col(c).alias(e + c) for c in cols])
            df = df.join(side, [f"{e}s1", f"{e}n"])
        return df

    def filtered(batches):
        for pdf in batches:
            least = least_shared(np.minimum(pdf["an"], pdf["bn"]))
            ok = [_common(p, q) >= k and _common(r, s) >= k for p, q, r, s, k in
                  zip(pdf["asecond"], pdf["bsecond"], pdf["athird"], pdf["bthird"], least)]
            yield pdf.loc[ok, ["as1", "an", "bs1", "bn"]]

    def compared(batches):
        for pdf in batches:
            both = np.array([_common(x, y) for x, y in zip(pdf["aset"], pdf["bset"])], dtype=np.int64)
            ok = 100 * both >= PERCENT * (pdf["an"].to_numpy(dtype=np.int64) + pdf["bn"].to_numpy(dtype=np.int64) - both)
            yield pdf.loc[ok, ["as1", "an", "bs1", "bn"]]

    kind = "as1 long, an int, bs1 long, bn int"
    left = stored(meet(pairs, "second", "third").mapInPandas(filtered, kind), "jaccard-filtered").distinct()
    return stored(meet(left, "set").mapInPandas(compared, kind).select(
        F.struct(F.col("as1").alias("s1"), F.col("an").alias("n")).alias("a"),
        F.struct(F.col("bs1").alias("s1"), F.col("bn").alias("n")).alias("b")).distinct(), "jaccard-links")


_COUNTS = [f"m{i}" for i in range(PARTS)]


def _rare_posts(docs: DataFrame, classes: DataFrame, crowded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, s1, n, members) of the shingles that at most ``CROWD`` of the
    classes in ``crowded`` have, and (s1, n, m0, m1, ...): how many others each
    class has in every part."""
    tokens = stored(_tokens_of(docs, classes, crowded.select("s1", "n").distinct()), "jaccard-crowd")
    members = stored(tokens.groupBy("token").agg(F.count("*").alias("members")).where("members > 1"), "jaccard-members")
    few = F.col("members") <= CROWD
    rare = stored(tokens.join(members.where(few), "token"), "jaccard-rare")
    part = F.pmod(F.xxhash64("token"), F.lit(PARTS))
    others = stored(tokens.join(members.where(~few), "token").groupBy("s1", "n").agg(
        *[F.count(F.when(part == i, 1)).alias(c) for i, c in enumerate(_COUNTS)]), "jaccard-others")
    discard(tokens, members)
    return rare, others


def _apart(held: DataFrame, shared: int) -> DataFrame:
    """(as1, an, bs1, bn, most): a row for each list of ``held`` (token, s1, n,
    comp, and m0, m1, ... where they bound) that a pair of different components
    meets in, and what is not rare in either, part by part. Where the lists are
    not those of rare shingles (``shared`` = 0), only of pairs that have enough
    in common without them."""
    counts = [c for c in _COUNTS if c in held.columns]
    a = held.select("token", F.col("s1").alias("as1"), F.col("n").alias("an"), F.col("comp").alias("ac"), *[F.col(c).alias(f"a{c}") for c in counts])
    b = held.select(F.col("token").alias("t"), F.col("s1").alias("bs1"), F.col("n").alias("bn"), F.col("comp").alias("bc"),
                    *[F.col(c).alias(f"b{c}") for c in counts])
    # ordered by size, so that the length filter is one-sided
    meet = f"token = t and (an < bn or (an = bn and as1 < bs1)) and 100 * an >= {PERCENT} * bn and ac <> bc"
    most = " + ".join(f"least(a{c}, b{c})" for c in counts) or "cast(an as bigint)"
    if not shared:
        meet += " and " + _within(most, "0")
    return a.join(b, F.expr(meet)).select("as1", "an", "bs1", "bn", F.expr(most).alias("most"))


def _within(most: str, votes: str) -> str:
    """That a pair with at most so many others, and so many rare shingles in common, can be a link."""
    return f"100 * ({most} + {votes}) >= {PERCENT} * (an + bn - ({most}) - {votes})"


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("as1", "an", "bs1", "bn").agg(F.count("*").alias("votes"), F.first("most").alias("most"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Null and wordless texts have no shingles and are their own component. Texts
    of fewer words than a shingle have one. A row that repeats a doc_id is a
    document of its own with that id; a null doc_id counts as no smaller id and
    stays null where its document is alone. An empty table gives no rows.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = _signed(docs)
    rows = stored(signed.where("chunk < 0").select("doc_id", "n", "s1", "s2", F.struct("d1", "d2").alias("rep")), "jaccard-rows")
    classes = stored(rows.where("n > 0").groupBy("s1", "n", "s2").agg(
        F.min("doc_id").alias("first"), F.min("rep").alias("rep"), F.count("*").alias("copies")), "jaccard-classes")
    heat = spark.sparkContext.broadcast(_heat(signed))
    discard(signed)
    sets = _prefixes(docs, heat)
    posts = _shared_posts(docs, heat, sets)
    discard(sets)

    # each list's members against its smallest
    stars = posts.where("p.s1 <> s1 or p.n <> n").groupBy(
        F.col("p.s1").alias("as1"), F.col("p.n").alias("an"), F.col("s1").alias("bs1"), F.col("n").alias("bn")).agg(F.count("*").alias("votes"))
    stars = stored(stars.where(_SIMILAR).where(_ENOUGH), "jaccard-stars")
    links = _links(stars, docs, classes, heat)
    groups = components(links, "jaccard-groups")

    # what is still apart: members of different components in one list
    label = groups.select(F.col("id.s1").alias("s1"), F.col("id.n").alias("n"), "comp")
    labelled = stored(posts.select("token", "s1", "n").join(label, ["s1", "n"], "left")
                      .select("token", "s1", "n", F.coalesce("comp", F.struct("s1", "n")).alias("comp")), "jaccard-labelled")
    discard(posts)
    ends = F.min("comp").alias("x"), F.max("comp").alias("y")
    mixed = stored(labelled.groupBy("token").agg(*ends).where("x <> y").select("token"), "jaccard-mixed")
    apart = stored(labelled.join(mixed, "token", "left_semi"), "jaccard-apart")
    discard(labelled, mixed)
    held = stored(_able(apart), "jaccard-able")
    discard(apart)
    crowds = held.groupBy("token").agg(F.count("*").alias("members"), *ends).where(F.col("members") > CROWD).where("x <> y")
    crowds = stored(crowds.select("token"), "jaccard-crowds")
    crowded = held.join(crowds, "token", "left_semi")
    rare, others = _rare_posts(docs, classes, crowded)

    def bounded(df: DataFrame) -> DataFrame:  # with what is not rare
        return df.join(others, ["s1", "n"], "left").fillna(0, _COUNTS)

    close = stored(bounded(crowded).where(f"100 * ({' + '.join(_COUNTS)}) >= {PERCENT} * n"), "jaccard-candidates")
    short = stored(held.join(crowds, "token", "left_anti"), "jaccard-short-lists")
    label = crowded.select("s1", "n", "comp").distinct()
    lists = stored(bounded(rare.join(label, ["s1", "n"])).drop("members"), "jaccard-rare-lists")
    discard(held, crowds, rare, others)
    rest = _counted(_apart(close, 0).unionByName(_apart(short, 0))).where(_ENOUGH).unionByName(
        _counted(_apart(lists, 1)).where(_within("most", "votes")))
    rest = rest.select("as1", "an", "bs1", "bn").distinct()
    rest = stored(rest.join(stars.select("as1", "an", "bs1", "bn"), ["as1", "an", "bs1", "bn"], "left_anti")
                  .join(stars.select(F.col("bs1").alias("as1"), F.col("bn").alias("an"), F.col("as1").alias("bs1"), F.col("an").alias("bn")),
                        ["as1", "an", "bs1", "bn"], "left_anti"), "jaccard-rest")
    discard(close, short, lists)
    if not rest.isEmpty():
        links = links.union(_links(rest, docs, classes, heat))
        groups = components(links, "jaccard-groups")

    label = groups.select(F.col("id.s1").alias("s1"), F.col("id.n").alias("n"), "comp")
    named = classes.join(label, ["s1", "n"], "left").where("copies > 1 or comp is not null").select(
        "s1", "n", "s2", "first", F.coalesce("comp", F.struct("s1", "n")).alias("comp"))
    named = stored(named, "jaccard-named")
    smallest = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = stored(named.join(smallest, "comp").select("s1", "n", "s2", "component_id"), "jaccard-components")
    return rows.join(named, ["s1", "n", "s2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
