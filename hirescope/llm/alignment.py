"""Alignment of two tokenizers over the same bytes.

Both tokenizers cut a text's bytes (a space, then the text) into tokens. The
cumulative ends of either's tokens go into a dictionary from end to index; the
intersection of the two key sets, sorted, is where both have a border, and
slices both id lists into groups. Within a group every token of one side
overlaps a token of the other; where a side has one token, it overlaps all of
the other's, and elsewhere the overlaps follow from the ends within the slice.

No token of either tokenizer reaches across a space between two plain characters
(checked when the files are loaded), so both have a border there, and a text's
alignment is its words' alignments one after the other. New words are aligned
many at a time, and kept in a bounded memo.

How many documents hold an id pair is counted over the whole corpus: each
document's distinct pairs are written with their occurrences, counted by pair
(combined before the shuffle) and joined back.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ship, stored, worker_cache

ship(__name__)

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Most id pairs that are sent to every executor (32 MB); above it the counts
#: are joined by a shuffle.
MAX_BROADCAST_PAIRS = 1 << 20
MEMO = 500_000  # words that a worker remembers (some 400 bytes each)
_LONGEST = 64  # characters of a word that is remembered
#: Spaces at which a byte-level tokenizer cuts in any case: between two
#: characters that are certainly no white space (it goes to the next word).
_CUT = re.compile("(?<=[!-~\u00c0-\u024f]) (?=[!-~\u00c0-\u024f])")
#: Words of characters whose class no version of Unicode has changed.
_PLAIN = re.compile("(?: [!-~\u00c0-\u024f]+)+")
# Fixed value: how a byte-level tokenizer of this kind cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHIFT = 20  # bits of an id of B in a pair's key


def tokenizer_files(a: str = BYTE_BPE, b: str = PIECE_BPE) -> dict:
    """The two files, read on the driver (their size is that of a vocabulary)."""
    with open(a, encoding="utf-8") as fa, open(b, "rb") as fb:
        return {"a": fa.read(), "b": fb.read()}


def byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable bytes stand
    for themselves, the others for the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """The two tokenizers with the bytes of all their tokens."""

    def __init__(self, files: dict) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files["a"])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files["b"])
        letters = byte_letters()
        made = json.loads(files["a"])
        vocab = made["model"]["vocab"]
        entry = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in vocab.items()}
        n = max(max(entry), self.a.get_vocab_size() - 1) + 1
        self.bytes_a = [entry.get(i, b"") for i in range(n)]
        # words are independent: no normalisation across them, cut by the pattern
        split = made.get("pre_tokenizer") or {}
        self.by_words = made.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        self.memo: dict[str, tuple | None] = {}  # None: a word that either tokenizer does not give back
        self.older: dict[str, tuple | None] = {}  # what was in the memo when it was last full
        self.ranked = self._by_ranks(made["model"], self.bytes_a) if self.by_words else None
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            self.by_words = self.by_words and "▁" not in piece.lstrip("▁")
        self.sizes_a = np.array(list(map(len, self.bytes_a)), dtype=np.int64)
        self.sizes_b = np.array(list(map(len, self.bytes_b)), dtype=np.int64)
        # an id as it is written within its side of a group, and at its end
        self.names = np.array([f"{i}{end}" for ids, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for end in ends
                               for i in range(len(ids))], dtype=object)

    @staticmethod
    def _by_ranks(model: dict, spelled: list[bytes]):
        """An encoder that merges by rank, if every merge makes the token of its
        own rank (then both merge alike); else none."""
        import tiktoken

        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        first = 256
        if model["type"] != "BPE" or any(model["vocab"].get(x + y) != first + k for k, (x, y) in enumerate(pairs)):
            return None
        ranks = {spelled[i]: i for i in range(first + len(pairs))}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _words_a(self, words: list[str]) -> list[np.ndarray]:
        """Ids of A for each word. Words of plain characters go to a faster encoder
        of the same ranks, many as one text, as each is cut off from the next."""
        out: list = [None] * len(words)
        plain = [k for k, w in enumerate(words) if _PLAIN.fullmatch(w)] if self.ranked else []
        for at in range(0, len(plain), 5000):
            some = plain[at:at + 5000]
            ids = np.array(self.ranked.encode_ordinary("".join([words[k] for k in some])), dtype=np.int64)
            ends = np.cumsum([len(words[k].encode()) for k in some])
            stops = (np.searchsorted(np.cumsum(self.sizes_a[ids]), ends) + 1).tolist()
            for k, start, stop in zip(some, [0, *stops], stops):
                out[k] = ids[start:stop]
        rest = [k for k, got in enumerate(out) if got is None]
        for k, e in zip(rest, self.a.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
            out[k] = np.array(e.ids, dtype=np.int64)
        return out

    def _learn(self, words: list[str]) -> None:
        """Alignments of new words (n_a, n_b, n_groups, groups, packed id pairs of
        the links), all of them as one text."""
        all_a, all_b = self._words_a(words), self.b.encode([w[1:] for w in words], num_threads=1)
        held = []
        for w, a, b in zip(words, all_a, all_b):
            raw = w.encode()
            if (b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw
                    and b"".join(map(self.bytes_b.__getitem__, b)) == raw):
                held.append((w, a, b))
            else:
                self.memo[w] = None
        if not held:
            return
        a = np.concatenate([x for _, x, _ in held])
        b = np.array([i for _, _, x in held for i in x], dtype=np.int64)
        n_a, n_b = [len(x) for _, x, _ in held], [len(x) for _, _, x in held]
        cut_a, cut_b, link_a, link_b = self.align(a, b)
        stop_a = np.cumsum(n_a)
        names = self._named(a, b, cut_a, cut_b)
        ends = (stop_a + np.cumsum(n_b)).tolist()
        groups = ["".join(names[x:y])[:-1] for x, y in zip([0, *ends], ends)]
        n_groups = np.diff(np.searchsorted(cut_a, stop_a), prepend=0).tolist()
        raw = ((a[link_a] << _SHIFT) | b[link_b]).tobytes()
        stops = (8 * np.searchsorted(link_a, stop_a)).tolist()
        pairs = map(raw.__getitem__, map(slice, [0, *stops], stops))
        self.memo.update(zip([w for w, _, _ in held], zip(n_a, n_b, n_groups, groups, pairs)))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text; none where the bytes of either are not
        those of a space and the text."""
        spaced = [" " + t for t in texts]
        out = []
        for text, e, b in zip(spaced, self.a.encode_batch_fast(spaced, add_special_tokens=False), self.b.encode(texts, num_threads=1)):
            raw, a = text.encode(), e.ids
            same = (b"".join(map(self.bytes_a.__getitem__, a)) == raw
                    and b"".join(map(self.bytes_b.__getitem__, b)) == raw)
            out.append((np.array(a if same else [], dtype=np.int64), np.array(b if same else [], dtype=np.int64)))
        return out

    def _whole(self, text: str) -> tuple[int, int, int, str, np.ndarray]:
        """n_a, n_b, n_groups, groups, id pair of every link of a text, not word by word."""
        (a, b), = self.encode([text])
        if not len(a):
            return 0, 0, 0, "", np.zeros(0, dtype=np.int64)
        cut_a, cut_b, link_a, link_b = self.align(a, b)
        return len(a), len(b), len(cut_a) - 1, self.written(a, b, cut_a, cut_b), (a[link_a] << _SHIFT) | b[link_b]

    def aligned(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray]]:
        """n_a, n_b, n_groups, groups, id pair of every link, for each text; its new
        words are aligned once, if words are independent."""
        if not self.by_words:
            return list(map(self._whole, texts))
        split = []
        for text in texts:
            first, *rest = _CUT.split(" " + text)
            split.append([first, *[" " + word for word in rest]])
        new = {word for words in split for word in words if word not in self.memo}
        if len(self.memo) + len(new) > MEMO // 2:
            self.memo, self.older = {}, self.memo
            new = {word for words in split for word in words}
        known = self.older.keys() & new
        self.memo.update(zip(known, map(self.older.__getitem__, known)))
        new = sorted(new - known)
        for at in range(0, len(new), 20_000):
            self._learn(new[at:at + 20_000])
        out = []
        for text, words in zip(texts, split):
            parts = list(map(self.memo.__getitem__, words))
            if None in parts or not text:
                out.append(self._whole(text))
                continue
            n_a, n_b, n_groups, groups, pairs = zip(*parts)
            out.append((sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), np.frombuffer(b"".join(pairs), dtype=np.int64)))
        for word in new:
            if len(word) > _LONGEST:
                del self.memo[word]
        return out

    def align(self, a: np.ndarray, b: np.ndarray):
        """Slices (begin of each group and the end of the last, for either side)
        and links (indices into a and into b, for every overlapping pair)."""
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        at_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1)))
        at_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1)))
        common = list(filter(at_b.__contains__, at_a))  # sorted, as ends ascend
        cut_a = np.array([0, *map(at_a.__getitem__, common)], dtype=np.int64)
        cut_b = np.array([0, *map(at_b.__getitem__, common)], dtype=np.int64)
        # tokens of B that a token of A overlaps: all of its slice's, if either
        # side has one token there
        sizes = np.diff(cut_a)
        first = np.repeat(cut_b[:-1], sizes)
        last = np.repeat(cut_b[1:], sizes)
        many = np.repeat((sizes > 1) & (np.diff(cut_b) > 1), sizes)
        if many.any():
            stop = ends_a[many]
            first[many] = np.searchsorted(ends_b, stop - self.sizes_a[a[many]], side="right")
            last[many] = np.searchsorted(ends_b, stop, side="left") + 1
        counts = last - first
        link_a = np.repeat(np.arange(len(a)), counts)
        link_b = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts - first, counts)
        return cut_a, cut_b, link_a, link_b

    def _named(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """The ids as they are written, with the sign behind each."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        last_a, last_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        last_a[cut_a[1:] - 1], last_b[cut_b[1:] - 1] = True, True
        at = np.empty(len(a) + len(b), dtype=np.int64)
        at[np.arange(len(a)) + np.repeat(cut_b[:-1], np.diff(cut_a))] = a + n_a * last_a
        at[np.arange(len(b)) + np.repeat(cut_a[1:], np.diff(cut_b))] = 2 * n_a + b + n_b * last_b
        return self.names[at].tolist()

    def written(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        """The groups as text: ids of a, a bar, ids of b; groups by semicolons."""
        return "".join(self._named(a, b, cut_a, cut_b))[:-1]


def alignments(docs: DataFrame, files: dict | None = None, with_groups: bool = True) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``, ids in
    order; only its ``groups_sha256`` without ``with_groups``), pairs and times
    (the distinct linked id pairs and how often the text holds each) for every
    row of ``docs`` (doc_id, text).

    Null and empty texts, and texts that either tokenizer does not give back
    byte for byte, have no tokens: zeros, no pairs, and '' for the groups.
    """
    files = files or tokenizer_files()
    key = hashlib.sha256(files["a"].encode() + files["b"]).hexdigest()
    made = docs.sparkSession.sparkContext.broadcast(files)
    kind = f"n_a long, n_b long, n_groups long, n_links long, {'groups string, ' * with_groups}groups_sha256 string, pairs array<long>, times array<int>"

    @F.pandas_udf(kind)
    def aligned(col: pd.Series) -> pd.DataFrame:
        aligner, rows = worker_cache("alignment", key, lambda: Aligner(made.value)), []
        for n_a, n_b, n_groups, groups, linked in aligner.aligned([t or "" for t in col]):
            pairs, times = np.unique(linked, return_counts=True)
            rows.append((n_a, n_b, n_groups, len(linked), *[groups] * with_groups,
                         hashlib.sha256(groups.encode()).hexdigest() if n_a else "", pairs, times.astype(np.int32)))
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in kind.split(", ")])

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", aligned("text").alias("s")).select("doc_id", "s.*")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, best): how many rows hold each id pair, and whether no
    other pair of its A id is held by more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs")), "align-counts")
    top = counts.groupBy(F.shiftright("pair", _SHIFT).alias("id_a")).agg(F.max("n_docs").alias("top"))
    return counts.withColumn("id_a", F.shiftright("pair", _SHIFT)).join(top, "id_a").select(
        "pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def scored_alignments(docs: DataFrame, files: dict | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is its A
    id's most frequent one in the corpus, ties included), count_sum (the pair's
    documents, summed over the links) and groups_sha256 ('' without tokens) for
    every row of ``docs``. Rows count one by one, repeated ones too; an empty
    table gives no rows; further columns are ignored."""
    rows = stored(alignments(docs, files, with_groups=False).withColumn("row", F.monotonically_increasing_id()), "align-rows")
    counts = stored(pair_counts(rows), "align-pairs")
    links = rows.where("n_links > 0").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), "l.times")
    if counts.count() <= MAX_BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256")
