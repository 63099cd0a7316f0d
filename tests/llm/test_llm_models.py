"""Language ID, quality, secrets and n-best segmentation: held-out accuracy,
brute force and exact round trips."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirescope.llm import language, nbest, quality, secrets

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- language --

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.language_of(docs, per_language=100).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_language_edges(spark):
    rows = [(i, t, la) for i, (t, la) in enumerate([("the cat and the dog went home", "en"), ("der hund und die katze gehen", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 !!", "en"), (105, "½ ² Ⅳ ٣", "en"), (103, "É", None), (None, "the dog", None), (104, "the house " * 30000, None), (104, "the house " * 30000, None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = {(r.doc_id): r for r in language.language_of(docs).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (100, 101, 102, 105))
    assert got[103].lang_pred in ("en", "de") and got[104].lang_pred == "en" and got[None].held_out
    assert language.language_of(docs).count() == len(rows)
    unlabelled = language.language_of(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    assert language.language_of(docs.where("false")).count() == 0


def test_codewords_keep_their_distance():
    for n in (2, 3, 4, 5, 9, 40):
        code = language.codewords(n)
        apart = [(code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2)]
        assert min(apart) >= (1 if n == 2 else 2) and code.shape[0] == n
    # one wrong bit still decodes to the right codeword
    code = language.codewords(5)
    margins = 5 * code.copy()
    margins[:, 0] *= -0.2
    assert (language.losses(margins, code).argmin(axis=1) == np.arange(5)).all()


def test_ngram_counts_of_pieces_are_those_of_the_whole(monkeypatch):
    text = "Ünd the quick brown fox " * 50
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "_PIECE", 97)
    assert (language.ngram_counts(text) == whole).all()


# ----------------------------------------------------------------- quality --

def test_quality_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.quality_of(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r.predicted for r in got if r.quality == 1]
    bad = [r.predicted for r in got if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5 and len(bad) > 5


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "x" * 300000, 1.0), (3, "x" * 300000, 1.0), (None, "text", 1.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_of(docs, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.3} and {r.predicted for r in got} == {1}
    words = spark.createDataFrame([(i, f"plain words of text number {i} and more of it" if i % 2 else "!!" * 40 + f"{i}") for i in range(200)], "doc_id long, text string")
    labels = words.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").union(spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int"))
    got = quality.quality_of(words.unionByName(docs.drop("score")), labels).collect()
    assert len(got) == 205 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.doc_id and r.doc_id > 3]) > 0.95


# ----------------------------------------------------------------- secrets --

TEXTS = [
    "password=abcdef1 and TOKEN : 'aaaa' Secret=\"0123456789abcdef01234567\"",
    "api_key=x api-key=123456 apikey = zzzzzz.", "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "c", "deadbeef" * 3 + "G" + "0" * 23 + " " + "f" * 100,
    "passwordpassword=secret=token=abcdefg", "é\U0001F600 token=abcdef ſecret=abcdefg", "", "no secrets here",
]


def brute_base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans_match_the_contract(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, "a1 " * 40000), (1, TEXTS[1])]
    for r in secrets.find_secrets(spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, base string")).collect():
        want = brute_base(dict(rows)[r.doc_id] or "")
        assert r.base == r.spans == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
    assert secrets.secrets_of(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_viterbi_is_the_best_of_all_taggings():
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(3, 3))
    trans[0, 2] = secrets._NEVER
    for length in (1, 2, 5):
        e = rng.normal(size=(6, length, 3))
        got = secrets.viterbi(e, trans)
        for i in range(6):
            def value(tags):
                path = [0, *tags, 0]
                return sum(e[i, t, tags[t]] for t in range(length)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
            assert tuple(got[i]) == max(itertools.product(range(3), repeat=length), key=value)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    trans, e, y = rng.normal(size=(3, 3)), rng.normal(size=(1, 4, 3)), np.array([[0, 1, 2, 0]])

    def likelihood(e, trans):
        def value(tags):
            path = [0, *tags, 0]
            return sum(e[0, t, tags[t]] for t in range(4)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
        return value(y[0]) - np.log(sum(np.exp(value(t)) for t in itertools.product(range(3), repeat=4)))

    ge, gt = secrets._gradients(e, y, trans)
    for at in ((0, 1, 2), (0, 3, 0)):
        d = np.zeros_like(e)
        d[at] = 1e-5
        assert np.isclose((likelihood(e + d, trans) - likelihood(e - d, trans)) / 2e-5, ge[at], atol=1e-5)
    for at in ((0, 1), (1, 2), (2, 0)):
        d = np.zeros_like(trans)
        d[at] = 1e-5
        assert np.isclose((likelihood(e, trans + d) - likelihood(e, trans - d)) / 2e-5, gt[at], atol=1e-5)


def test_field_finds_what_the_patterns_miss(spark):
    rows = []
    for i in range(300):
        h = hashlib.sha256(str(i).encode()).hexdigest()
        rows.append((i, f"the word of the day password={h[:18]} and more words" if i % 3 == 0 else
                     f'in the text token = "{h[:40]}" and so on' if i % 3 == 1 else f"call +{i}555 (020) 7946-{i:04d} on 12.3.{1900 + i} or 10.0.{i % 255}.1 in v{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.train(docs)
    new = 'in the text key "' + hashlib.sha1(b"x").hexdigest()[:22] + '" and so on'
    plain = "call +77555 (020) 7946-0077 on 12.3.1977 or 10.0.77.1"
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame([(1, new), (2, plain)], "doc_id long, text string"), model).collect()}
    assert got[1].n_hex == 0 and got[1].spans == "crf:17:39" and got[2].spans == ""


def _credential(rng, letters_only):
    if letters_only:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz").upper() if i % 2 else rng.choice("abcdefghijklmnopqrstuvwxyz") for i in range(rng.randint(12, 18)))
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(rng.randint(10, 20)))


def test_precision_and_recall_on_texts_not_learned_from(spark):
    """Secrets that no base pattern finds, letters-only ones among them, in texts
    like and unlike those learned from; and words that are none."""
    rng = random.Random(12)
    prose = "the key to the old house was on the table so they pass the login page and walk on with McDonald and an iPhone to see e.g. the and/or gate".split()

    def words(n):
        return " ".join(rng.choice(prose) for _ in range(n))

    learn = [(i, f"{words(12)} {rng.choice(['password', 'api_key', 'secret', 'token'])}{rng.choice([': ', '=', ' = '])}{_credential(rng, i % 2)} {words(9)}" if i % 3 else
              f"{words(30)} v{i} on 12.3.{1900 + i}") for i in range(600)]
    model = secrets.train(spark.createDataFrame(learn, "doc_id long, text string"))
    held, wanted = [], set()
    for i in range(300):
        front, secret = words(rng.randint(2, 12)), _credential(rng, i % 2)
        lead = rng.choice(["Authorization: Bearer ", "login ", "pwd: ", "credential "]) if i % 3 else ""
        text = f"{front} {lead}{secret if i % 3 else words(4)} {words(6)}"
        held.append((i, text))
        if i % 3:
            wanted.add((i, text.index(secret), text.index(secret) + len(secret)))
    got = secrets.find_secrets(spark.createDataFrame(held, "doc_id long, text string"), model).collect()
    found = {(r.doc_id, int(s), int(e)) for r in got for _, s, e in (x.split(":") for x in r.spans.split(",") if x)}
    assert not any(r.base for r in got)
    hits = len(found & wanted)
    assert hits >= 0.9 * len(wanted) and hits >= 0.9 * len(found), (hits, len(wanted), len(found))
    letters = {w for w in wanted if w[0] % 2}
    assert len(found & letters) >= 0.9 * len(letters) > 80


def test_free_tokens_and_their_company():
    text = "the word Authorization: Bearer QwErTy\npwd hunter two three four\nmixedCase and/or plain ABC x" + "y" * 20
    free = [text[s:e] for s, e in secrets.free_tokens(text)]
    assert free == ["Bearer", "QwErTy", "hunter", "two", "three", "mixedCase", "and/or", "x" + "y" * 20]
    company = secrets.Company(text)
    assert company.before(text.index("QwErTy")) == ("bearer", "authorization:")
    assert company.before(text.index("word")) == ("the", "") and company.before(0) == ("", "")
    long = "a" * 5000
    assert secrets.Company(f"{long} token=x1").before(5007) == ("token=", long)


# ------------------------------------------------------------------ n-best --

TOY = {"pieces": {p: (i, s) for i, (p, s) in enumerate([("▁", -2.0), ("a", -3.0), ("b", -3.5), ("ab", -4.0), ("▁a", -2.5), ("ba", -5.0), ("aba", -6.0), ("▁ab", -6.5), ("▁▁", -3.0)])},
       "bytes": {b: 100 + b for b in range(256)}, "unk": 99, "penalty": -20.0}


def every_path(text):
    if not text:
        return [(0.0, ())]
    out = []
    for k in range(1, len(text) + 1):
        if text[:k] in TOY["pieces"]:
            i, s = TOY["pieces"][text[:k]]
            out += [(s + t, (i, *r)) for t, r in every_path(text[k:])]
    if text[0] not in TOY["pieces"]:
        out += [(-20.0 + t, (*(100 + b for b in text[0].encode()), *r)) for t, r in every_path(text[1:])]
    return out


@pytest.mark.parametrize("text", ["ab", "abab baba", "  aba", "abca\nab é", "a" * 9, "b ab  a"])
def test_n_best_are_the_best_of_all_paths(text):
    seg = nbest.Segmenter(TOY, 4)
    ids, count, scores, sizes, merged, back, parts = seg.encode(text)
    paths = sorted(every_path(("▁" + text).replace(" ", "▁")), key=lambda x: -x[0])[:4]
    assert np.allclose(scores, [s for s, _ in paths])
    assert back == text and count == len(ids) // 4 == sizes[0]
    for (loss, more, swaps), score, size in zip(merged, scores, sizes):
        own = tuple(np.frombuffer(nbest.path_ids(parts, swaps), "<i4").tolist())
        assert len(own) == size and any(own == p and np.isclose(s, score) for s, p in every_path(("▁" + text).replace(" ", "▁")))
    assert len({nbest.path_ids(parts, m[2]) for m in merged}) == len(merged)


def test_many_chunks_at_once_are_as_one_by_one():
    rng = np.random.default_rng(5)
    chunks = sorted({"".join(rng.choice(list("ab▁"), size=rng.integers(2, 9))) for _ in range(600)})
    one, many = nbest.Segmenter(TOY, 4), nbest.Segmenter(TOY, 4)
    many.learn(chunks)
    assert len(many.memo) > 300
    for c, got in many.memo.items():
        assert got == one.chunk(c)


def test_memo_is_bounded_and_results_stay_the_same():
    rng = np.random.default_rng(6)
    one, few = nbest.Segmenter(TOY, 4), nbest.Segmenter(TOY, 4, memo=200)
    for _ in range(20):
        text = " ".join("".join(rng.choice(list("abc"), size=rng.integers(1, 12))) for _ in range(80))
        chunks = few.chunks(text)
        few.learn({c for c in chunks if c not in few.memo})
        assert len(few.memo) + len(few.older) <= 200
        assert few.encode(text, chunks)[:4] == one.encode(text)[:4]
    assert few.older and len(one.memo) > 200


def test_encoding_round_trip(spark):
    texts = ["Hello  world\n\tok", "", None, "日本語 é \U0001F600", "x" * 20000, " lead and trail ", "a▁b", "Hello  world\n\tok"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    enc = nbest.segmented(docs)
    rows = {r.doc_id: r for r in enc.collect()}
    back = {r.doc_id: r.text for r in nbest.decoded(enc).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert rows[i].n_tokens is None and rows[i].ids is None and back[i] is None
        elif "▁" in t:
            assert not rows[i].round_trip and back[i] == t.replace("▁", " ")
        else:
            assert rows[i].round_trip and back[i] == t and len(rows[i].ids) == rows[i].n_tokens
    assert rows[1].n_tokens == 0 and rows[1].scores == [0.0]
    assert nbest.segmented(docs.where("false")).count() == 0


def test_patches_give_all_ids_of_long_texts_back(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: (r.ids, r.n_best_ids, r.n_best_crc32) for r in nbest.segmented(docs).collect()}
    again = nbest.rebuilt(nbest.segmented(docs, as_patches=True))
    assert {r.doc_id: (r.ids, r.n_best_ids, r.n_best_crc32) for r in again.collect()} == whole and len(whole) > 100


def test_all_n_segmentations_come_out(spark):
    texts = ["abab baba", "abca\nab é", "", None, "ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in nbest.segmented(docs, vocab=TOY).collect()}
    short = {r.doc_id: r for r in nbest.segmented(docs, vocab=TOY, with_ids=False).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        if t is None:
            assert r.n_best_ids is None and r.n_best_crc32 is None and r.round_trip is None
            continue
        paths = every_path(("▁" + t).replace(" ", "▁") if t else "")
        assert len(r.n_best_ids) == len(r.scores) == min(4, len(paths)) and r.n_best_ids[0] == r.ids and r.round_trip
        assert len(set(map(tuple, r.n_best_ids))) == len(r.n_best_ids) and list(map(len, r.n_best_ids)) == r.n_pieces
        for ids, score in zip(r.n_best_ids, r.scores):
            assert any(tuple(ids) == p and np.isclose(s, score) for s, p in paths)
        assert r.n_best_crc32 == short[i].n_best_crc32 == [zlib.crc32(np.array(ids, dtype="<i4").tobytes()) for ids in r.n_best_ids]
    patched = nbest.segmented(docs, vocab=TOY, as_patches=True)
    again = {r.doc_id: r for r in nbest.rebuilt(patched).collect()}
    for r in patched.collect():
        assert again[r.doc_id].n_best_ids == rows[r.doc_id].n_best_ids and again[r.doc_id].ids == rows[r.doc_id].ids
        assert r.n_best_patches is None or r.n_best_patches[0] == []
    wrong = dict(TOY, pieces=dict(TOY["pieces"], ab=(1, -4.0)))  # two pieces of one id: decoding it cannot give both back
    assert not all(r.round_trip for r in nbest.segmented(docs.where("doc_id = 4"), vocab=wrong).collect())


def test_a_filter_on_the_language_predicts_once(spark):
    """Filters on a prediction are not pushed below it, where they would predict again."""
    rows = [(i, "the quick brown fox" if i % 2 else "der schnelle braune fuchs", "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify(docs, language.train(docs)).where("lang_pred <> 'und' and not ambiguous")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert out.count() == 40
