"""Periodic runs against a brute-force version."""

import hashlib
import random
import re
import zlib

from hirescope.llm import queries, runs

EMPTY = hashlib.sha256(b"").hexdigest()


def brute_runs(w):
    """Maximal stretches for every period; those whose smallest period it is."""
    found = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                part = w[i:i + length]
                if not any(all(part[x] == part[x + d] for x in range(length - d)) for d in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


def brute_collapsed(w, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repetitive(rng):
    """Random words with planted repeats, some broken, some of repeats."""
    out = []
    for _ in range(rng.randint(1, 5)):
        root = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        if rng.random() < 0.3:
            root = root * rng.randint(2, 5) + [rng.choice("abc")]
        out += root * rng.randint(1, 9) + root[:rng.randint(0, len(root))]
        if rng.random() < 0.4 and out:
            out[rng.randrange(len(out))] = rng.choice("abcd")
        out += [rng.choice("abcdef") for _ in range(rng.randint(0, 6))]
    return out


def test_runs_match_brute_force():
    rng = random.Random(11)
    total = 0
    for _ in range(1500):
        w = repetitive(rng)
        want = brute_runs(w)
        assert runs.runs_of(w) == want, w
        total += len(want)
    for _ in range(500):
        w = [rng.choice("ab") for _ in range(rng.randint(0, 80))]
        assert runs.runs_of(w) == brute_runs(w)
    assert total > 2000


def test_equal_hashes_are_no_squares(monkeypatch):
    """Hashes only find blocks: runs stay right where all blocks collide."""
    monkeypatch.setattr(runs, "_PRIME", 3)
    monkeypatch.setattr(runs, "_POWERS", [pow(runs._BASE, 2 << k, 3) for k in range(48)])
    rng = random.Random(5)
    for _ in range(200):
        w = repetitive(rng)
        assert set(runs.runs_of(w)) <= set(brute_runs(w))


def test_long_texts_stay_linear():
    w = ["x"] * 60_000 + [str(i) for i in range(60_000)] + (["a"] * 999 + ["b"]) * 60
    blocks = [(120_000 + 1000 * i, 999, 1) for i in range(60)]
    assert runs.runs_of(w) == [(0, 60_000, 1), *sorted([*blocks, (120_000, 60_000, 1000)])]


def brute_row(doc, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    best = min(found, key=lambda r: (-r[1] * 10**9 // r[2], r[0], r[2])) if found else (None, None, None)
    return (doc, len(found), *best, None if not found else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n_},{q}\n" for s, n_, q in found).encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(w, found).encode()).hexdigest())


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choice([repetitive(rng), [str(rng.random()) for _ in range(rng.randint(0, 90))]])))
            for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, " \n\x0b"), (1003, "é é é é " * 6), (5, "a a a a a a"), (5, "a a a a a a"), (1004, "A a A a A a A a")]
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted((brute_row(*d) for d in docs), key=repr)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs) > 20


def test_edges(spark):
    schema = "doc_id long, text string"
    assert runs.periodic_runs(spark.createDataFrame([], schema)).count() == 0
    got = {r.doc_id: r for r in runs.periodic_runs(spark.createDataFrame(
        [(None, "no no no no no no"), (2, None), (3, " ")], schema)).collect()}
    assert [tuple(r) for r in got[None].runs] == [(0, 6, 1)] and got[None].collapsed == "no"
    assert all(got[i].runs == [] and got[i].n_words == 0 and got[i].collapsed == "" for i in (2, 3))


def test_null_ids_pass_the_query(spark, tmp_path):
    spark.createDataFrame([(None, "b " * 6)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = queries.op11_periodic_runs(spark, str(tmp_path)).collect()[0]
    assert (row.doc_id, row.n_runs, row.exponent_milli) == (None, 1, 6000)
    assert row.collapsed_sha256 == hashlib.sha256(b"b").hexdigest()
