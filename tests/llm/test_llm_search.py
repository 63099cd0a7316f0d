"""Jaccard join, top-k search and WARC archives against brute force."""

import gzip
import hashlib
import io
import os
import random

import numpy as np

from hirescope.llm import jaccard, topk, warc


def brute_components(docs):
    def grams(t):
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()

    sets = [(d, grams(t)) for d, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def near_copies(rng, n=150):
    vocab = [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocab) for _ in range(60)]
    bases = [[rng.choice(vocab) for _ in range(rng.randint(3, 150))] for _ in range(8)]
    docs = []
    for d in range(n):
        words = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocab)
        if rng.random() < 0.3:
            words += passage
        docs.append((d, rng.choice([" ", "\n", "  "]).join(words).replace("w1", rng.choice(["w1", "W1"]))))
    return docs


def test_components_match_brute_force(spark):
    docs = near_copies(random.Random(2)) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A\tB"), (905, "É b c"), (906, "é b c"),
                                            (907, "a b"), (908, "x" * 5000), (909, "x" * 5000)]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    want = brute_components(docs)
    assert sorted(map(tuple, got.collect())) == want
    assert len({c for _, _, c in want}) < len(want) - 40


def test_null_ids_link_like_others(spark):
    text = " ".join(f"n{i}" for i in range(200))
    docs = [(5, text), (None, text + " more"), (None, "alone here"), (7, "other words")]
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(5, 196, 5), (None, 197, 5), (None, 1, None), (7, 1, 7)], key=repr)


def test_a_group_makes_few_comparisons(spark, monkeypatch):
    """Copies with edits from a few words, so that edits repeat: pairs grow with
    the group, not with its square, and no link is lost."""
    rng = random.Random(1)
    base = [f"b{rng.randrange(10**6)}" for _ in range(140)]
    few = [f"e{i}" for i in range(40)]
    docs = []
    for d in range(700):
        words = list(base)
        for _ in range(0 if d == 77 else rng.randint(1, 9)):
            words[rng.randrange(140)] = rng.choice(few)
        docs.append((d, " ".join(words)))
    compared = []
    plain = jaccard._links

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "_links", counted)
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_components(docs)
    assert sum(compared) < jaccard.CROWD * len(docs) < len(docs) ** 2 / 20


def test_sketches_are_summed_in_bounded_groups(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c d e {i % 3} g h") for i in range(90)], "doc_id long, text string").repartition(45)
    whole = jaccard._heat(jaccard._signed(docs))
    monkeypatch.setattr(jaccard, "_PIECES", 4)
    assert (jaccard._heat(jaccard._signed(docs)) == whole).all()



def test_components_of_a_crowd(spark):
    """One text with edits from few to many: some copies link to it, some to
    each other, most to nothing."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for d in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(150)] = f"e{rng.randrange(10 ** 6)}"
        if d % 10 == 0:
            words[20:60] = [f"shared{i}" for i in range(40)]  # far from the text, near each other
        docs.append((d, " ".join(words)))
    got = sorted(map(tuple, jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    want = brute_components(docs)
    assert got == want and 5 < len({c for _, _, c in want}) < 100


def test_components_with_hot_tokens(spark, monkeypatch):
    """Every token hot: the other path of the posting lists."""
    docs = near_copies(random.Random(4), 60)
    monkeypatch.setattr(jaccard, "_heat", lambda signed: np.full(jaccard.SKETCH, 3, dtype=np.uint8))
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_components(docs)


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours link, ends do not: components, not stars."""
    words = [f"v{i}" for i in range(400)]
    docs = [(100 - k, " ".join(words[8 * k:8 * k + 200])) for k in range(20)]
    got = {r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {81} and {c for _, _, c in brute_components(docs)} == {81}


def test_components_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n int, token int")
    assert jaccard.near_duplicates(empty).count() == 0
    twice = spark.createDataFrame([(5, "a b c d e f", 1), (5, "a b c d e f", 2), (None, "zz", 3), (3, "a b c d e f", 4)], "doc_id long, text string, n int")
    got = sorted([tuple(r) for r in jaccard.near_duplicates(twice).collect()], key=str)
    assert got == [(3, 2, 3), (5, 2, 3), (5, 2, 3), (None, 1, None)]


def brute_top(rows, every=20, k=20):
    ok = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            ok.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for j, qv in ok if j == q for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=40).astype(np.float32)]) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 40), (2003, [float("inf")] * 40), (None, rows[0][1]), (2020, [1.0, 2.0]),
             (2021, [0.5, -1.0]), (2040, []), (40, rows[7][1]), (41, rows[41][1])]  # a query id and another id that repeat
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(map(tuple, topk.exact_top_k(df).collect()))
    assert got == brute_top(rows)
    assert topk.exact_top_k(df.where("false")).count() == 0


def test_bounds_never_lose_a_candidate():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(64, 900)) * rng.uniform(0.1, 8, size=900) * np.linspace(4, 0.1, 64)[:, None])
    whole = x.T @ x
    compacted = 0
    for i in range(30):
        alive, scores = topk.bounded_scores(x[:, i:i + 1], x, 5, np.full(1, -np.inf))
        assert set(np.flatnonzero(whole[i] >= np.sort(whole[i])[-5])) <= set(alive)
        assert (scores[0] == whole[i, alive]).all()
        compacted += 900 - len(alive)
    assert compacted > 9000  # a third and more


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a", big), (5, "http://b", big), (3, None, big), (2, "http://c", "small"), (4, "http://d", "small"),
            (6, "http://é", None), (7, "u", ""), (8, "u", "é" * 600), (9, "u", "é" * 600), (None, "n", big), (10, "v", "\r\n\r\nWARC/1.1\r\n" * 90), (8, "u", "é" * 600)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, archive string")
    got = [tuple(r) for r in warc.round_trip(pages, str(tmp_path / "w")).collect()]
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        to = max((p for p, _, h in rows if h == html and p is not None), default=None) if len(raw) >= 1000 else None
        again = to is not None and page != to
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", to if again else None))
    assert sorted(got, key=str) == sorted(want, key=str)
    names = [n for n in os.listdir(tmp_path / "w" / "normalised") if n.endswith(".warc.gz")]
    assert names and not [n for n in os.listdir(tmp_path / "w" / "monolithic") if n.endswith(".tmp")]
    assert warc.round_trip(pages.where("false"), str(tmp_path / "e")).count() == 0


def test_normaliser_gives_each_record_a_member():
    recs = [warc.record("response", i, "http://x", b"y" * (i * 40000), i * 40000, hashlib.sha1(b"y" * (i * 40000)).hexdigest()) for i in range(8)]
    out = io.BytesIO()
    index = list(warc.normalise(io.BytesIO(gzip.compress(b"".join(recs))), out))
    assert gzip.decompress(out.getvalue()) == b"".join(recs)
    for rec, e in zip(recs, index, strict=True):
        assert gzip.decompress(out.getvalue()[e["offset"]:e["offset"] + e["length"]]) == rec
    # an archive that was normalised already comes out the same
    again = io.BytesIO()
    list(warc.normalise(io.BytesIO(out.getvalue()), again))
    assert again.getvalue() == out.getvalue()


def test_sets_hold_one_row_for_each_class(spark, monkeypatch):
    """Copies of a text, also with its doc_id, do not multiply the pairs."""
    a = " ".join(f"a{i}" for i in range(60))
    b = a.replace("a59", "z")
    docs = [(1, a)] * 5 + [(d, a) for d in range(10, 400)] + [(2, b)] * 5 + [(d, b) for d in range(1000, 1400)]
    made, own = [], jaccard._sets
    monkeypatch.setattr(jaccard, "_sets", lambda *x: made.append(own(*x)) or made[-1])
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted((d, 56, 1) for d, _ in docs)
    assert made and made[0].count() == 2


def test_copies_of_a_text_are_read_as_one(spark):
    """The texts of wanted classes come once each, however many rows hold them."""
    docs = [(d, t) for t in ("a b c d e f g", "h i j k l m n") for d in range(40)] + [(90, "not wanted at all here"), (91, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = jaccard._signed(df).where("chunk < 0 and n = 3").selectExpr("s1", "n", "struct(d1, d2) as rep").distinct()
    got = jaccard._texts_of(df, rows, rows.select("s1", "n"))
    assert sorted(r["text"] for r in got.collect()) == ["a b c d e f g", "h i j k l m n"]


def test_prefixes_are_cut_once(spark, monkeypatch):
    """Cold and hot tokens of the first order come of one pass over the texts."""
    calls, plain = [], jaccard._prefixes

    def counted(docs, heat):
        calls.append(plain(docs, heat))
        return calls[-1]

    monkeypatch.setattr(jaccard, "_prefixes", counted)
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(20)] + [None, " ", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    heat = np.zeros(jaccard.SKETCH, dtype=np.uint8)
    heat[::2] = 3
    jaccard._shared_posts(docs, spark.sparkContext.broadcast(heat))
    assert len(calls) == 1
    got = {(r.s1, r.n): (set(r.cold), set(r.hot), r["rank"]) for r in calls[0].collect()}
    for t in [s for s in map(jaccard.shingles, texts) if len(s)]:
        p = jaccard.prefix(t, heat, 0)
        hot = heat[p & np.uint64(jaccard.SKETCH - 1)] > 0
        cold, warm, rank = got[(jaccard.signature(t)[0], len(t))]
        assert cold == set(p[~hot].view(np.int64).tolist()) and warm == set(p[hot].view(np.int64).tolist())
        assert rank == (1000 * int(np.count_nonzero(heat[t & np.uint64(jaccard.SKETCH - 1)] == 0)) // len(t) if hot.any() else 0)


def test_texts_with_one_common_shingle_are_no_crowd(spark, monkeypatch):
    """Long lists of classes that share nothing else: their whole sets are not
    read, and near copies among them are still found."""
    rng = random.Random(5)
    docs = []
    for d in range(480):
        words = [f"u{rng.randrange(10 ** 9)}" for _ in range(28)]
        at = rng.randrange(20)
        words[at:at] = [f"p{d % 12}x{j}" for j in range(5)]
        docs.append((d, " ".join(words)))
    docs += [(1000 + d, docs[d][1] + " more") for d in range(0, 480, 40)]
    asked, plain = [], jaccard._rare_posts

    def counted(docs, classes, crowded):
        asked.append(crowded.select("s1", "n").distinct().count())
        return plain(docs, classes, crowded)

    monkeypatch.setattr(jaccard, "_rare_posts", counted)
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_components(docs)
    assert len(asked) == 1 and asked[0] < 40


def test_classes_with_just_enough_lists_stay(spark):
    """A link of a class of n shingles takes 1 + n' div 20 lists, n' = 80 % of n."""
    rows = [(t, s, n, s) for s, n, k in [(1, 23, 1), (2, 24, 1), (3, 24, 2), (4, 100, 4), (5, 100, 5), (6, 1, 1)] for t in range(k)]
    held = spark.createDataFrame(rows, "token long, s1 long, n int, comp long")
    assert sorted({r.s1 for r in jaccard._able(held).collect()}) == [1, 3, 5, 6]
    assert jaccard._able(held).columns == ["s1", "n", "token", "comp"]


def test_sketch_counters_are_packed():
    for most in (0, 1, 255, 256, 70_000, 2 ** 33):
        counts = np.zeros(jaccard._CHUNK, dtype=np.int64)
        counts[7] = most
        raw = jaccard._packed(counts)
        assert (jaccard._unpacked(raw) == counts).all() and len(raw) == jaccard._CHUNK * max(1, (most.bit_length() + 7) // 8 if most < 2 ** 16 else 4 if most < 2 ** 32 else 8)


def test_copies_that_lack_different_shingles_are_not_compared(spark, monkeypatch):
    """Copies of a text that is not there itself, three edits each: nearly as
    much is not rare in each as a link needs, but seldom the same."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for d in range(90):
        words = list(base)
        for at in rng.sample(range(5, 145), 3 if d % 9 else 1):
            words[at] = f"e{rng.randrange(10 ** 6)}"
        docs.append((d, " ".join(words)))
    compared, plain = [], jaccard._links

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard, "_links", counted)
    got = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_components(docs)
    assert sum(compared) < 90 * 89 / 2 / 3
