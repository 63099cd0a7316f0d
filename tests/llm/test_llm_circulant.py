"""Circulant MinHash near duplicates against brute force."""

import random

import numpy as np

from hirescope.llm import circulant
from hirescope.llm.common import semi_by_bloom


def grams(text):
    w = (text or "").encode().lower().split()
    k = min(4, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute_components(docs):
    sets = [grams(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]
    return sorted(((*r, r[0] == r[2]) for r in out), key=repr)


def copies(rng, n):
    """Copies of a few texts with up to 12 words changed: chains of links, pairs
    close to the threshold on either side, and a passage that many share."""
    vocab = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocab) for _ in range(rng.randint(3, 160))] for _ in range(6)]
    passage = [rng.choice(vocab) for _ in range(50)]
    out = []
    for d in range(n):
        words = list(rng.choice(bases)) if rng.random() < 0.8 else [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 12)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append((d, rng.choice([" ", "\n", "\t "]).join(words + passage * (rng.random() < 0.2))))
    return out


def test_components_match_brute_force(spark):
    rng = random.Random(8)
    docs = copies(rng, 260) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A\tB"), (905, "É b c"), (906, "é b c"),
                               (908, "x" * 5000), (909, "x" * 5000), (3, "a b"), (None, "a b"), (None, "q r s t u"), (None, "q r s t u"), (None, None)]
    base = " ".join(f"n{i}" for i in range(200))
    docs += [(950, base), (None, base + " more"), (951, base + " more words")]
    df = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, n int, comp string")
    got = circulant.kept_first(circulant.near_duplicates(df))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_components(docs)


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, "a"), (2, "b c")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = circulant.near_duplicates(df).collect()
        assert sorted(map(tuple, got)) == sorted((d, int(bool(t)), d) for d, t in rows)


def test_second_permutation_is_one():
    x = np.random.default_rng(1).integers(0, 2**32, 200_000, dtype=np.uint32)
    x = np.unique(x)
    assert len(np.unique(circulant.pi(x.copy()))) == len(x)


def test_coordinates_estimate_the_similarity():
    """Each circular shift agrees as often as the sets are alike."""
    rng = np.random.default_rng(4)
    for share in (0.3, 0.6, 0.8, 0.9):
        agree = []
        for _ in range(60):
            t = rng.integers(0, 2**63, 1000, dtype=np.int64).astype(np.uint64)
            both = int(share * 1000)
            rest = (1000 - both) // 2
            a, b = np.unique(t[:both + rest]), np.unique(np.concatenate([t[:both], t[both + rest:]]))
            agree.append(np.mean(circulant.signature(a) == circulant.signature(b)))
        assert abs(np.mean(agree) - share) < 0.02


def test_long_sets_in_blocks():
    s = np.unique(np.random.default_rng(2).integers(0, 2**63, 9000, dtype=np.int64).astype(np.uint64))
    whole = circulant.pi(circulant.sigma(s) + circulant._SHIFTS).min(axis=1)
    assert (circulant.signature(s) == whole).all()


def test_a_group_makes_few_comparisons(spark, monkeypatch):
    """Pairs grow with a group of near copies, not with its square."""
    rng = random.Random(1)
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    docs = []
    for d in range(600):
        words = list(base)
        for _ in range(0 if d == 77 else rng.randint(1, 10)):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        docs.append((d, " ".join(words)))
    compared = []
    plain = circulant._verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(circulant, "_verified", counted)
    got = circulant.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(r[0], r[2]) for r in sorted(brute_components(docs))]
    assert sum(compared) < 8 * len(docs), compared


def test_a_bitmap_thins_before_the_shuffle(spark):
    """Only rows that the bitmap lets through are shuffled for the exact join: a
    semi-join would be moved below the bitmap, with all rows of the table."""
    rows = spark.range(4000).selectExpr("id % 2000 as k", "id % 7 as j", "cast(id as string) as text")
    keys = spark.range(0, 2000, 100).selectExpr("id as k", "id % 7 as j")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        thin = semi_by_bloom(rows, "k", keys, "test-bloom")
        assert "LeftSemi" not in thin._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(map(tuple, thin.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    want = [(i % 2000, i % 7, str(i)) for i in range(4000) if i % 100 == 0 and i % 7 == i % 2000 % 7]
    assert thin.columns == rows.columns and got == sorted(want)


def test_sets_are_made_of_one_text_each(spark):
    """Copies of a text, or texts of an equal set, give its class one row."""
    docs = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "A b c d e f g h"), (4, "p q r s t u"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    signed = circulant._signed(df)
    sets = circulant._sets(df, signed, signed.where("n > 0"))
    assert sorted(len(r["set"]) for r in sets.collect()) == [3, 5]
    assert sets.select("k1", "k2").distinct().count() == 2
