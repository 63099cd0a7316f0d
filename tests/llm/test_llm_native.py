"""Sharding, line dedup and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from hirescope.llm import decontaminate, line_dedup, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- sharding --

def brute_shards(rows, n_shards=16, seed=17):
    by = defaultdict(list)
    for doc, text, source in rows:
        size, crc = len((text or "").encode()) + 1, zlib.crc32((text or "").encode())
        ordkey = hashlib.md5(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
        by["-" if source is None else "+" + source].append((ordkey, -1 if doc is None else doc, size, crc))
    placed = []
    for stratum, held in by.items():
        for k, r in enumerate(sorted(held), 1):
            placed.append(((2 * k - 1) / (2 * len(held)), stratum, *r))
    placed.sort()
    out, seen = [], Counter()
    for i, (_, _, _, doc, size, crc) in enumerate(placed):
        shard = i * n_shards // len(placed)
        out.append((None if doc == -1 else doc, size, crc, shard, seen[shard]))
        seen[shard] += 1
    return out


def test_shards_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "", "a", "é" * 3, "x" * 5000]), rng.choice(["hot"] * 6 + ["a", "b", None])) for i in range(500)]
    rows += [(7, "a", "hot"), (7, "a", "hot"), (None, "z", None)]
    got = sharding.interleaved_shards(frame(spark, rows)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got], key=key) == sorted(brute_shards(rows), key=key)
    counts = Counter(r.shard for r in got)
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    hot = Counter(r.shard for r in got if r.source == "hot")
    assert max(hot.values()) - min(hot.values()) <= 2  # every shard has the mixture
    assert {r.law for r in got} == {"rows"} and all(r.grown_shard is None for r in got)


def test_shards_edges(spark):
    assert sharding.interleaved_shards(frame(spark, [])).count() == 0
    extra = spark.createDataFrame([(1, "a", "s", 9, 9)], "doc_id long, text string, source string, rank int, shard int")
    assert sharding.interleaved_shards(extra).count() == 1


# -------------------------------------------------------------- line dedup --

def norm(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def simhash(text):
    words = [w for w in text.split(" ") if len(w) > 3] or text.split(" ")
    sums = [0] * 64
    for w in words:
        h = xxhash.xxh64(w.encode(), seed=42).intdigest()
        for b in range(64):
            sums[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * sums[b] > len(words))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(docs, min_words=5, similarity=0.9, max_edits=256):
    places = defaultdict(list)
    for doc, text in docs:
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            n = norm(line)
            if len(n.split(" ")) >= min_words:
                places[n].append((doc, k))
    lines = sorted(places)
    sims = {n: simhash(n) for n in lines}
    root = {n: n for n in lines}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(lines):
        for b in lines[i + 1:]:
            if bin(sims[a] ^ sims[b]).count("1") <= 3:
                if distance(a, b) <= min((1 - similarity) * max(len(a), len(b)) + 1e-9, max_edits):
                    root[find(a)] = find(b)
    first = {}
    for n in lines:
        first[find(n)] = min([first.get(find(n), min(places[n])), *places[n]])
    drop = {p for n in lines for p in places[n] if p != first[find(n)]}
    return {doc: (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (doc, k) not in drop),
                  0 if text is None else len(text.split("\n")), sum(1 for p in drop if p[0] == doc)) for doc, text in docs}


def near_lines(rng, n=60):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, bases = [], [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    for doc in range(n):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(bases)) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 12))]
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(rng.choice(["{}", "  {}!", "** {} **"]).format(" ".join(line)))
        docs.append((doc, "\n".join(lines)))
    return docs


def test_lines_match_brute_force(spark):
    docs = near_lines(random.Random(3)) + [(100, None), (101, ""), (102, "one two\none two"), (103, "Same LINE with five words!\nsame line, with five words")]
    got = line_dedup.drop_repeated_lines(frame(spark, docs, "doc_id long, text string")).collect()
    want = brute_lines(docs)
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got} == want
    assert sum(r.n_dropped for r in got) > 20 and want[103][2] == 1
    fuzzy = sum(w[2] for w in want.values()) - sum(w[2] for w in brute_lines(docs, similarity=1.0).values())
    assert fuzzy > 0  # some links are not equal lines


def test_lines_edges(spark):
    empty = frame(spark, [], "doc_id long, text string, n_dropped string, row int")
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    long = "word " * 50000
    rows = [(1, long, "x", 1), (2, long + "\ntail", "y", 2), (2, long + "\ntail", "y", 2), (None, None, None, None)]
    got = line_dedup.drop_repeated_lines(frame(spark, rows, "doc_id long, text string, n_dropped string, row int")).collect()
    assert [(r.doc_id, r.text, r.n_dropped) for r in sorted(got, key=lambda r: r.doc_id or 0)] == [
        (None, None, 0), (1, long, 0), (2, "tail", 1), (2, "tail", 1)]


def test_long_lines_link_by_similarity_alone(spark):
    """Hundreds of edits, in words that carry no weight: the SimHash stays."""
    line = [w for i in range(1500) for w in (f"word{i * i}", "abc")]

    def edited(n):
        return " ".join(["xyz" if i % 2 and i < 2 * n else w for i, w in enumerate(line)])

    most = len(edited(0)) // 30  # three edits each: a tenth
    rows = [(1, edited(0)), (2, edited(100)), (3, edited(most)), (4, "other words stand here and stay")]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_repeated_lines(frame(spark, rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}
    rows = [(1, edited(0)), (3, edited(most + 2))]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_repeated_lines(frame(spark, rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 3: 0}


def test_lines_of_few_words_take_part(spark):
    shared = ["版权所有未经书面许可不得转载本网站的任何内容", "All rights reserved", "https_example_com_a_very_long_address_without_end", "x" * 400]
    rows = [(d, "\n".join([f"own{d}", *shared, "Home", "one two"])) for d in range(3)]
    rows.append((3, "Y" + "x" * 399 + "\nall rights RESERVED!"))  # one edit
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_repeated_lines(frame(spark, rows, "doc_id long, text string")).collect()}
    assert got[0] == (rows[0][1], 0)
    assert got[1] == ("own1\nHome\none two", 4) and got[2] == ("own2\nHome\none two", 4)
    assert got[3] == ("", 2)


def test_sums_of_parts_are_the_sums_of_the_line(spark):
    """SimHashes of lines of one part and of many, and of rows repeated whole, by
    the definition: bits set by more than half of the words with weight."""
    rows = [(1, " ".join(f"word{i * i}" for i in range(n))) for n in (5, 126, 127, 128, 254, 255, 700)]
    rows += [(2, "same words " * 100)] * 300 + [(3, "of a to it as")]
    got = line_dedup._lines(frame(spark, rows, "doc_id long, text string"), 5, 12).groupBy("row").agg({"sim": "max", "h1": "count"}).collect()
    texts = spark.createDataFrame([(t,) for t in {t for _, t in rows[:-1]}], "t string")
    words = texts.selectExpr("t", "explode(split(trim(t), ' ')) as w").selectExpr("t", "xxhash64(w) as h").collect()
    sums = defaultdict(list)
    for r in words:
        sums[r.t].append(r.h)
    want = {sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) for hs in sums.values()}
    assert want <= {r["max(sim)"] % (1 << 64) for r in got}
    assert len(got) == len({t for _, t in rows})


# --------------------------------------------------------- decontamination --

def brute_hits(docs, items, window=10):
    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            k = min(window, len(v))
            wins = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
            for i in range(len(w) - k + 1) if v else []:
                if tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return out


@pytest.mark.parametrize("short", [False, True])
def test_contamination_matches_brute_force(spark, short):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(30)] + ["É", "über", "ſ"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(10, 30)))) for i in range(20)]
    items += [(3, items[4][1]), (50, None), (51, "  ... "), (None, items[2][1])]
    if short:
        items += [(60, "w1 W2 w3"), (61, "über"), (62, "w5 w5 w5 w5 w5 w5 w5")]
    docs = []
    for d in range(60):
        text = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            text[rng.randint(0, len(text)):0] = (items[rng.randrange(20)][1]).upper().split(" ")[:rng.randint(8, 30)]
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(text)))
    docs += [(100, None), (101, ""), (102, "w1"), (103, " ".join(["w5"] * 20)), (104, items[0][1] + " " + items[0][1])]
    got = decontaminate.contamination(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string"))
    got = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got)) == sorted(brute_hits(docs, items))
    assert sum(r.contaminated for r in got) > 10


def test_contamination_edges(spark):
    docs = frame(spark, [(1, "a b", "x"), (1, "a b", "x")], "doc_id long, text string, row string")
    none = frame(spark, [], "item_id long, text string, window int")
    got = decontaminate.contamination(docs, none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)] * 2
    assert decontaminate.contamination(docs.where("false"), none).count() == 0


def test_line_distance_is_the_plain_one(spark):
    """Cut ends, words compared one by one and gaps decide as the distance of the
    whole lines does."""
    r, rows = random.Random(5), []
    for i in range(1500):
        a = [r.choice(["ab", "abc", "b", "cab", "dd", "xy"]) for _ in range(r.randint(0, 9))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k, o = r.randint(0, len(b)), r.randint(0, 3)
            if o == 0:
                b.insert(k, r.choice(["ab", "q", "abc"]))
            elif b and o == 1:
                b.pop(min(k, len(b) - 1))
            elif b:
                b[min(k, len(b) - 1)] = r.choice(["abd", "ba", "c"])
        rows.append((i, " ".join(a), " ".join(b), r.randint(0, 8)))
    both = spark.createDataFrame(rows, "i int, na string, nb string, most int")
    near = line_dedup._compared(both.selectExpr("struct(i) as ida", "struct(nb) as idb", "most", "split(na, ' ') as wa", "split(nb, ' ') as wb"))
    got = near.selectExpr("ida.i", "near").join(both, "i").selectExpr("near", "levenshtein(na, nb) <= most as want").collect()
    assert len(got) == 1500 and 300 < sum(x.want for x in got) < 1400 and all(x.near == x.want for x in got)


def test_simhash_bits_are_those_of_more_than_half(spark):
    r = random.Random(6)
    for wide in (False, True):
        rows, want = [], []
        for i in range(300):
            n = r.choice([1, 2, 126, 127]) if not wide else r.choice([1, 2, 128, 129, 40_000, 1_000_001])
            c = [r.choice([0, n // 2, n // 2 + 1, n, r.randint(0, n)]) for _ in range(64)]
            if wide:
                sums = [c[8 * k + j] | c[8 * (k + 4) + j] << 32 for j in range(8) for k in range(4)]
            else:
                sums = [sum(c[8 * b + j] << 8 * b for b in range(8)) for j in range(8)]
            rows.append((i, n, *sums))
            sim = sum(1 << b for b in range(64) if 2 * c[b] > n)
            want.append(sim - (1 << 64) if sim >> 63 else sim)
        names = [f"w{j}_{k}" for j in range(8) for k in range(4)] if wide else [f"s{j}" for j in range(8)]
        df = spark.createDataFrame(rows, "i long, n long, " + ", ".join(f"{x} long" for x in names))
        sim = line_dedup._wide_simhash() if wide else line_dedup._simhash()
        assert [x.sim for x in df.select("i", sim.alias("sim")).orderBy("i").collect()] == want


def test_texts_without_repeated_lines_stay_where_they_are(spark, monkeypatch):
    moved = []
    plain = line_dedup.split_by_bloom

    def spied(df, key, keys, name):
        out = plain(df, key, keys, name)
        moved.append(out[0].count())
        return out

    monkeypatch.setattr(line_dedup, "split_by_bloom", spied)
    rows = [(i, "\n".join(" ".join(f"{'abcdefghij'[(i * 7 + j * k) % 10] * 5}{i}x{j}x{k}" for k in range(8)) for j in range(3))) for i in range(100)]
    rows.append((200, rows[3][1].split("\n")[0] + "\nsome other words that stand in no other text"))
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[200].n_dropped == 1 and got[200].text == "some other words that stand in no other text"
    assert all(got[i].text == rows[i][1] and got[i].n_dropped == 0 for i in range(100)) and 1 <= moved[0] < 20
