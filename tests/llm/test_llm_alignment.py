"""Cross-tokenizer alignment against a brute-force version."""

import collections
import hashlib
import json
import random

import pytest

from hirescope.llm import alignment as A

TEXTS = [
    "Hello world", "naïve café – déjà vu…", "  two  spaces ", "日本語のテキスト 😀", "tab\tand\nline", "", None, "<|endoftext|> is text",
    "<0x41> ▁ mark", "a", " ", "ﬁne ½", "word " * 300, "x" * 3000, "Hello world", " hard", "é combined",
]


def tokens(files):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files["a"])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files["b"])
    chars = {}
    n = 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte:
            chars[chr(byte)] = byte
        else:
            chars[chr(256 + n)] = byte
            n += 1

    def both(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        raw_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        return list(zip(ids_a, raw_a)), list(zip(ids_b, raw_b))

    return both


def spans(toks):
    out, at = [], 0
    for i, raw in toks:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(docs, files):
    both, rows, held = tokens(files), [], collections.Counter()
    for doc, text in docs:
        a, b = both(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(r for _, r in a) != raw or b"".join(r for _, r in b) != raw:
            rows.append((doc, [], [], [], ""))
            continue
        sa, sb = spans(a), spans(b)
        ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups, at = [], 0
        for e in ends:
            groups.append(",".join(str(i) for i, s, t in sa if at <= s and t <= e) + "|" + ",".join(str(i) for i, s, t in sb if at <= s and t <= e))
            at = e
        links = [(i, j) for i, s, t in sa for j, u, v in sb if s < v and u < t]
        held.update(set(links))
        rows.append((doc, sa, sb, links, ";".join(groups)))
    top = collections.defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return sorted(((doc, len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for doc, a, b, links, g in rows), key=repr)


@pytest.fixture(scope="module")
def files():
    return A.tokenizer_files()


def test_scores_match_brute_force(spark, files):
    rng = random.Random(6)
    alphabet = list("abcdefghij  éß–日本語😀.,<>\n\t'\"0123")
    docs = list(enumerate(TEXTS)) + [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80)))) for i in range(150)]
    docs += [(3, "Hello world"), (None, "Hello there world"), (None, None)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, pair int, row string")
    got = A.scored_alignments(df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = brute(docs, files)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[1] > 0 for r in want) > 100 and sum(r[4] > max(r[1], r[2]) for r in want) > 50


def test_groups_are_written_out(spark, files):
    df = spark.createDataFrame([(1, "déjà vu"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in A.alignments(df, files).collect()}
    assert rows[2].groups == "" and rows[2].groups_sha256 == "" and rows[2].pairs == []
    one = rows[1]
    assert hashlib.sha256(one.groups.encode()).hexdigest() == one.groups_sha256 and sum(one.times) == one.n_links
    groups = [tuple(tuple(map(int, side.split(","))) for side in g.split("|")) for g in one.groups.split(";")]
    aligner = A.Aligner(files)
    for a, b in groups:  # both sides of a group are the same bytes
        assert b"".join(aligner.bytes_a[i] for i in a) == b"".join(aligner.bytes_b[i] for i in b)
    assert (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups)) == (one.n_a, one.n_b)


def test_counts_beyond_the_broadcast_bound(spark, files, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    want = sorted(map(tuple, A.scored_alignments(df, files).collect()))
    monkeypatch.setattr(A, "MAX_BROADCAST_PAIRS", 0)
    assert sorted(map(tuple, A.scored_alignments(df, files).collect())) == want


def test_empty_table(spark, files):
    assert A.scored_alignments(spark.createDataFrame([], "doc_id long, text string"), files).collect() == []


def test_byte_letters_cover_the_vocabulary(files):
    letters = A.byte_letters()
    assert sorted(letters.values()) == list(range(256))
    vocab = json.loads(files["a"])["model"]["vocab"]
    assert sum(len(t) == 1 for t in vocab) == 256 and all(c in letters for t in list(vocab)[:50000] for c in t)


def test_words_are_aligned_as_whole_texts(files, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(8)
    words = ["the", "cat's", "naïve", "x&&&", "1234", "日本", "a\tb", "", "<s>", "▁u", "e\u0301", "Zürich,", "q" * 90, "it 'll"]
    texts = [" ".join(rng.choice(words, size=rng.integers(0, 30))) for _ in range(300)]
    monkeypatch.setattr(A, "MEMO", 16)
    aligner = A.Aligner(files)
    assert aligner.by_words
    for at in range(0, 300, 50):
        for text, got in zip(texts[at:at + 50], aligner.aligned(texts[at:at + 50])):
            want = aligner._whole(text)
            assert got[:4] == want[:4] and sorted(got[4].tolist()) == sorted(want[4].tolist())
    assert aligner.older and max(map(len, aligner.memo), default=0) <= A._LONGEST
