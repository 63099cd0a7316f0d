"""SentencePiece n-best segmentation, encoding and decoding.

A text (spaces written as U+2581, one in front) is a path through the lattice
of vocabulary pieces; its score is the sum of its pieces' scores. A forward
Viterbi pass gives the best score up to every position; a backward A* search
from the end uses these scores as exact heuristics, so hypotheses leave its
agenda in the order of their full scores and the first ``n`` that reach the
start are the n-best.

No piece holds a space mark behind another character, and characters that
occur in no longer piece stand alone, so a text's lattice falls apart into
chunks. Every chunk gets its best path and the loss of its second best (from
the scores before and behind each piece); the ``n`` best paths of a text
differ from the best one in the ``n - 1`` chunks of the smallest losses only,
so just these are searched, and their n-best lists are merged, exactly. Both
results are kept in a bounded memo.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ship, worker_cache

ship(__name__)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MEMO = 1_000_000  # chunks a worker remembers (some 250 bytes each)


def vocabulary(path: str = MODEL) -> dict:
    """Pieces of a SentencePiece model: normal pieces with id and score, ids of
    the byte pieces, and the score of a character that has no piece. Read once,
    on the driver; its size is that of the vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = {}, {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[sp.id_to_piece(i)] = (i, sp.get_score(i))
    return {"pieces": pieces, "bytes": byte_ids, "unk": sp.unk_id(),
            "penalty": min(s for _, s in pieces.values()) - 10.0}


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(chunks: list[str]) -> np.ndarray:
    """Code points of chunks of one length, a row each."""
    return np.frombuffer("".join(chunks).encode("utf-32-le"), dtype="<u4").reshape(len(chunks), -1).astype(np.uint64)


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes (modulo 2^64) of all beginnings, the empty one first."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        for k in range(codes.shape[1]):
            out[:, k + 1] = out[:, k] * _BASE + mixed[:, k]
    return out


def _place(hashes: np.ndarray, shift: int) -> np.ndarray:
    return ((hashes >> np.uint64(shift)) & np.uint64((1 << 20) - 1)).astype(np.int32)


class Spelling:
    """The bytes of every id (space marks as spaces), in one table."""

    def __init__(self, vocab: dict):
        spelled = {i: p.replace(SPACE, " ").encode() for p, (i, _) in vocab["pieces"].items()}
        spelled.update({i: bytes([b]) for b, i in vocab["bytes"].items()})
        spelled.setdefault(vocab["unk"], "\ufffd".encode())
        sizes = np.zeros(max(spelled) + 1, dtype=np.int64)
        for i, raw in spelled.items():
            sizes[i] = len(raw)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.table = np.frombuffer(b"".join(spelled[i] for i in sorted(spelled)), dtype=np.uint8)

    def bytes_of(self, paths: list[bytes]) -> list[bytes]:
        """What each path (packed ids) decodes to, all of them by one gather."""
        ids = np.frombuffer(b"".join(paths), dtype="<i4")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        raw = self.table[np.arange(int(sizes.sum())) + np.repeat(self.starts[ids] - (ends - sizes), sizes)].tobytes()
        stops = np.concatenate([[0], ends])[np.cumsum([0] + [len(p) // 4 for p in paths])].tolist()
        return [raw[a:b] for a, b in zip(stops, stops[1:])]


class Segmenter:
    def __init__(self, vocab: dict, n: int, memo: int = MEMO):
        self.most = memo
        self.pieces, self.bytes, self.unk, self.penalty, self.n = vocab["pieces"], vocab["bytes"], vocab["unk"], vocab["penalty"], n
        self.longest = max(map(len, self.pieces))
        self.names = {i: p for p, (i, _) in self.pieces.items()}
        self.values = {i: b for b, i in self.bytes.items()}
        # characters that can stand in a piece of two or more
        joined = {c for p in self.pieces if len(p) > 1 for c in p}
        body = "".join(re.escape(c) for c in sorted(joined - {SPACE}))
        inner = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.split = re.compile(f"[{SPACE}{body}]+|[^{SPACE}{body}]" if inner else f"{SPACE}+[{body}]*|[{body}]+|[^{SPACE}{body}]").findall
        self.memo: dict = {}
        self.older: dict = {}  # what was in the memo when it was last full
        self.lists: dict = {}
        # every beginning of a piece; the whole pieces with id and score
        self.begin: dict = dict.fromkeys((p[:k] for p in self.pieces for k in range(1, len(p))), ())
        self.begin.update(self.pieces)
        # hashes of the pieces in two tables, the second one for what finds its
        # place in the first one taken, and the few that are left, sorted; for
        # many chunks at a time
        self.sizes = {len(p) for p in self.pieces}
        names = sorted(self.pieces, key=len)
        hashes = np.concatenate([_prefix_hashes(_codes(list(own)))[:, -1] for _, own in itertools.groupby(names, len)])
        self.ids, self.scores = (np.array([self.pieces[p][k] for p in names]) for k in (0, 1))
        self.places = []
        left = np.arange(len(names))
        for shift in (44, 20):
            at, free = _place(hashes[left], shift), np.full(1 << 20, -1, dtype=np.int32)
            _, first = np.unique(at, return_index=True)
            free[at[first]] = left[first]
            self.places.append((shift, hashes[free], free))
            left = np.delete(left, first)
        order = left[np.argsort(hashes[left])]
        self.few = hashes[order], order.astype(np.int32)

    def _edges(self, text: str, end: int):
        """Pieces that end at ``end``: (start, ids, score). A character without a
        piece of its own is its bytes (or unknown) at the penalty's score."""
        for start in range(max(0, end - self.longest), end):
            p = self.pieces.get(text[start:end])
            if p is not None:
                yield start, (p[0],), p[1]
        if text[end - 1] not in self.pieces:
            raw = text[end - 1].encode("utf-8", "replace")
            yield end - 1, tuple(self.bytes.get(b, self.unk) for b in raw) if self.bytes else (self.unk,), self.penalty

    def search(self, text: str) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a chunk, best first; ties to fewer ids, then
        to the order of the search. Suffixes are linked cells, and a position
        expands its n best suffixes only, so the search is linear in the chunk."""
        size = len(text)
        edges: list = [None] * (size + 1)
        best = [0.0] * (size + 1)
        for end in range(1, size + 1):
            edges[end] = list(self._edges(text, end))
            best[end] = max([best[start] + s for start, _, s in edges[end]])
        agenda, made, expanded, out = [(-best[size], 0, 0, size, 0.0, None)], 0, [0] * (size + 1), []
        while agenda and len(out) < self.n:
            _, k, _, at, score, suffix = heapq.heappop(agenda)
            if at == 0:
                ids = []
                while suffix is not None:
                    ids.extend(suffix[0])
                    suffix = suffix[1]
                out.append((score, tuple(ids)))
                continue
            if expanded[at] == self.n:
                continue
            expanded[at] += 1
            for start, piece, s in edges[at]:
                made += 1
                heapq.heappush(agenda, (-(best[start] + s + score), k + len(piece), made, start, score + s, (piece, suffix)))
        return out

    def decode(self, ids) -> str:
        """Pieces to text: bytes are joined to characters, space marks become
        spaces, and the one in front goes."""
        try:
            return "".join([self.names[i] for i in ids])
        except KeyError:
            pass  # bytes, or an unknown id
        out, held = [], bytearray()
        for i in ids:
            if i in self.values:
                held.append(self.values[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.names.get(i, "�"))
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def best(self, text: str):
        """The best path's ids and score, and what the second best path loses
        (infinite, if there is none)."""
        size, begin = len(text), self.begin
        before, back, edges = [-np.inf] * (size + 1), [None] * (size + 1), []
        before[0] = 0.0
        for start in range(size):
            here = before[start]
            for end in range(start + 1, size + 1):
                p = begin.get(text[start:end])
                if p is None:
                    break
                if p:
                    edges.append((start, end, p[1]))
                    if here + p[1] > before[end]:
                        before[end], back[end] = here + p[1], (start, (p[0],))
            if text[start] not in self.pieces:
                _, ids, score = next(e for e in self._edges(text[start], 1))
                edges.append((start, start + 1, score))
                if here + score > before[start + 1]:
                    before[start + 1], back[start + 1] = here + score, (start, ids)
        behind = [-np.inf] * size + [0.0]
        for start, end, score in reversed(edges):
            if score + behind[end] > behind[start]:
                behind[start] = score + behind[end]
        path, on, at = [], set(), size
        while at:
            start, ids = back[at]
            path.append(ids)
            on.add((start, at))
            at = start
        second = max([before[start] + score + behind[end] for start, end, score in edges if (start, end) not in on], default=-np.inf)
        return tuple(i for ids in reversed(path) for i in ids), before[size], before[size] - second

    def _bound(self, more: int) -> None:
        """Keeps the memo and its elder to ``most`` chunks together, but for those
        of one call."""
        if len(self.memo) + more > self.most // 2:
            self.memo, self.older = {}, self.memo

    def learn(self, chunks) -> None:
        """``best`` for many chunks together, one array operation for each pair of
        positions."""
        self._bound(len(chunks))
        chunks = set(chunks)
        known = self.older.keys() & chunks
        self.memo.update(zip(known, map(self.older.__getitem__, known)))
        group = [c for c in chunks - known if 1 < len(c) <= 40 and all(map(self.pieces.__contains__, c))]
        group.sort(key=len, reverse=True)
        for at in range(0, len(group), 20_000):
            if len(group) - at >= 16:
                self._learn(group[at:at + 20_000])

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of pieces, and of which."""
        rows, which = [], []
        for shift, known, piece in self.places:
            at = _place(hashes, shift)
            some = np.flatnonzero(known[at] == hashes)
            some = some[piece[at[some]] >= 0]
            rows.append(some)
            which.append(piece[at[some]])
        known, piece = self.few
        if len(known):
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            some = np.flatnonzero(known[at] == hashes)
            rows.append(some)
            which.append(piece[at[some]])
        return np.concatenate(rows), np.concatenate(which)

    def _learn(self, group: list[str]) -> None:
        """The chunks are ordered by length, the longest first, so those that reach
        a position are a beginning of the group."""
        n, lengths = len(group), np.array(list(map(len, group)))
        size = int(lengths[0])
        hashes = _prefix_hashes(_codes([c.ljust(size, "\0") for c in group])).T.copy()
        power = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(size):
                power.append(power[-1] * _BASE)
        before = np.full((size + 1, n), -np.inf)
        before[0] = 0.0
        back, piece = np.zeros((size + 1, n), dtype=np.int16), np.zeros((size + 1, n), dtype=np.int32)
        edges = []
        for end in range(1, size + 1):
            reach = int(np.searchsorted(-lengths, -end, side="right"))
            for start in range(max(0, end - self.longest), end):
                if end - start not in self.sizes:
                    continue
                with np.errstate(over="ignore"):
                    rows, which = self._found(hashes[end, :reach] - hashes[start, :reach] * power[end - start])
                if not len(rows):
                    continue
                scores = self.scores[which]
                edges.append((start, end, rows, scores))
                total = before[start, rows] + scores
                better = total > before[end, rows]
                rows = rows[better]
                before[end, rows] = total[better]
                back[end, rows] = start
                piece[end, rows] = self.ids[which[better]]
        behind = np.full((size + 1, n), -np.inf)
        behind[lengths, np.arange(n)] = 0.0
        for start, end, rows, scores in sorted(edges, key=lambda e: -e[0]):
            behind[start, rows] = np.maximum(behind[start, rows], scores + behind[end, rows])
        # walk the best paths back; on[e]: the path has a piece that ends at e
        on, where = np.zeros((size + 1, n), dtype=bool), lengths
        for end in range(size, 0, -1):
            on[end] = where == end
            where = np.where(on[end], back[end], where)
        second = np.full(n, -np.inf)
        for start, end, rows, scores in edges:
            keep = ~(on[end, rows] & (back[end, rows] == start))
            other = rows[keep]
            second[other] = np.maximum(second[other], before[start, other] + scores[keep] + behind[end, other])
        taken = on[1:].T
        raw = piece[1:].T[taken].astype("<i4").tobytes()
        stops = (4 * np.cumsum(taken.sum(axis=1))).tolist()
        scores = before[lengths, np.arange(n)]
        self.memo.update(zip(group, zip(map(raw.__getitem__, map(slice, [0, *stops], stops)), scores.tolist(), (scores - second).tolist())))

    def chunk(self, text: str):
        """(packed ids, score, loss of the second best path)."""
        got = self.memo.get(text) or self.older.get(text)
        if got is None:
            ids, score, loss = self.best(text)
            got = (np.array(ids, dtype="<i4").tobytes(), score, loss)
            if len(text) <= 256:
                self._bound(1)
                self.memo[text] = got
        return got

    def others(self, text: str, packed: bytes, score: float):
        """(loss, ids) of up to n - 1 further paths of a chunk, best first."""
        got = self.lists.get(text)
        if got is None:
            own = tuple(np.frombuffer(packed, "<i4").tolist())
            got = [(score - s, ids) for s, ids in self.search(text) if ids != own][:self.n - 1]
            if len(text) <= 256:
                if len(self.lists) >= self.most:
                    self.lists.clear()
                self.lists[text] = got
        return got

    def chunks(self, text: str) -> list[str]:
        return self.split((SPACE + text).replace(" ", SPACE)) if text else []

    def encode(self, text: str, chunks: list[str] | None = None, decoded: bool = True):
        """Best ids (packed), their number, the n best scores and numbers of
        pieces, the swapped chunks of each, the decoded text (if wanted), and the
        chunks' best paths."""
        chunks = self.chunks(text) if chunks is None else chunks
        parts = list(map(self.memo.get, chunks))
        if None in parts:
            parts = [p or self.chunk(c) for p, c in zip(parts, chunks)]
        packed, scores, losses = zip(*parts) if parts else ((), (), ())
        ids, score = b"".join(packed), sum(scores)
        count = len(ids) // 4
        # the n best differ from the best in chunks with the smallest losses
        losses = np.array(losses)
        if 1 < self.n <= len(losses):
            losses[losses > np.partition(losses, self.n - 2)[self.n - 2]] = np.inf
        at = np.flatnonzero(losses < np.inf)
        near = heapq.nsmallest(self.n - 1, zip(losses[at].tolist(), at.tolist()))
        merged = [(0.0, 0, ())]
        for _, k in sorted(near, key=lambda x: x[1]):
            own = parts[k]
            options = [(0.0, 0, ())] + [(loss, len(i) - len(own[0]) // 4, ((k, i),)) for loss, i in self.others(chunks[k], own[0], own[1])]
            merged = sorted((a + b, m + n, x + y) for a, m, x in merged for b, n, y in options)[:self.n]
        return ids, count, [score - loss for loss, _, _ in merged], [count + more for _, more, _ in merged], merged, \
            self.decode(np.frombuffer(ids, "<i4").tolist())[1:].replace(SPACE, " ") if decoded else None, parts


def patches_of(parts, swaps) -> list[tuple[int, int, tuple[int, ...]]]:
    """A merged path against the best one: (start, length, new ids) for every
    swapped chunk, in order; start and length count ids of the best path."""
    out, at, start = [], 0, 0
    for k, ids in sorted(swaps):
        start += sum([len(p[0]) for p in parts[at:k]]) // 4
        at = k
        out.append((start, len(parts[k][0]) // 4, ids))
    return out


def patched(best: bytes, patches) -> bytes:
    """Ids (packed) of the path that the patches make of the best one."""
    out, at = [], 0
    for start, length, ids in patches:
        out += [best[4 * at:4 * start], np.array(ids, dtype="<i4").tobytes()]
        at = start + length
    return b"".join([*out, best[4 * at:]])


def path_ids(parts, swaps) -> bytes:
    """Ids (packed) of a merged path."""
    return patched(b"".join([p[0] for p in parts]), patches_of(parts, swaps))


_PATCH = "array<struct<start:int,length:int,ids:array<int>>>"
_RESULT = "n_tokens long, ids_crc32 long, scores array<double>, n_pieces array<int>, round_trip boolean, n_best_crc32 array<long>"
_BATCH = 1 << 16  # characters whose paths are decoded together: a few MB of indices


def segmented(docs: DataFrame, n: int = 4, vocab: dict | None = None, with_ids: bool = True, model: str = MODEL,
              as_patches: bool = False, memo: int = MEMO) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, scores, n_pieces, round_trip, n_best_crc32 and,
    if ``with_ids``, ids (array of int) and n_best_ids (array of arrays of int)
    for every row of ``docs``.

    ``scores``, ``n_pieces``, ``n_best_ids`` and ``n_best_crc32`` list the n best
    segmentations (fewer, if the text has fewer), best first; ``ids`` is the
    best. ``as_patches`` gives n_best_patches instead of n_best_ids: what each
    segmentation changes in ``ids`` (start, length, new ids; nothing for the
    best), from which ``rebuilt`` makes n_best_ids again. ``round_trip``: the
    ids of every one of them decode to the text (a text that holds U+2581 itself
    comes back with spaces). Null texts have null results; empty ones have no
    tokens and one path of score 0. ``memo``: how many chunks a worker remembers;
    it keeps them while it waits for further tasks, also of other stages.
    """
    vocab = vocab or vocabulary(model)
    key = (n, memo, zlib.crc32(repr(sorted(vocab["pieces"].items())).encode()), len(vocab["bytes"]), vocab["unk"], vocab["penalty"])
    made = docs.sparkSession.sparkContext.broadcast(vocab)
    others = f"n_best_patches array<{_PATCH}>" if as_patches else "n_best_ids array<array<int>>"
    kind = _RESULT + f", ids array<int>, {others}" * with_ids
    names = re.findall(r"(\w+) (?=long|array|boolean)", kind)

    @F.pandas_udf(kind)
    def encoded(col: pd.Series) -> pd.DataFrame:
        seg, spelling = worker_cache("nbest", key, lambda: (Segmenter(made.value, n, memo), Spelling(made.value)))
        rows = []
        split = [[] if text is None else seg.chunks(text) for text in col]
        seg.learn({c for chunks in split for c in chunks if c not in seg.memo})
        waiting, size = [], 0

        def decode() -> None:  # all paths of the texts that wait
            nonlocal waiting, size
            back = iter(spelling.bytes_of([p for _, paths, _ in waiting for p in paths]))
            for row, paths, raw in waiting:
                row[4] = all([next(back) == raw for _ in paths])
            waiting, size = [], 0

        for text, chunks in zip(col, split):
            if text is None:
                rows.append([None] * (6 + 2 * with_ids))
                continue
            best, count, scores, sizes, merged, _, parts = seg.encode(text, chunks, decoded=False)
            patches = [patches_of(parts, swaps) for _, _, swaps in merged]
            paths = [patched(best, p) for p in patches]
            crcs = [zlib.crc32(raw) for raw in paths]
            ids = [] if not with_ids else [np.frombuffer(best, "<i4"), [
                [dict(zip(("start", "length", "ids"), p)) for p in path] for path in patches]] if as_patches else [
                np.frombuffer(best, "<i4"), [np.frombuffer(raw, "<i4") for raw in paths]]
            rows.append([count, crcs[0], scores, sizes, None, crcs, *ids])
            waiting.append((rows[-1], paths, (" " + text).encode("utf-8", "replace") if text else b""))
            size += len(text)
            if size >= _BATCH:
                decode()
        decode()
        return pd.DataFrame(rows, columns=names).astype({"n_tokens": "Int64", "ids_crc32": "Int64", "round_trip": "boolean"})

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", encoded("text").alias("s")).select("doc_id", "s.*")


def rebuilt(encoded: DataFrame) -> DataFrame:
    """``encoded`` with n_best_ids (all ids of every segmentation) instead of
    n_best_patches. Built-in functions only."""

    def whole(patches: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("at"))
        done = F.aggregate(patches, start, lambda acc, p: F.struct(
            F.concat(acc["ids"], F.slice("ids", acc["at"] + 1, p["start"] - acc["at"]), p["ids"]).alias("ids"),
            (p["start"] + p["length"]).alias("at")))
        return F.concat(done["ids"], F.slice("ids", done["at"] + 1, F.size("ids")))

    return encoded.withColumn("n_best_ids", F.transform("n_best_patches", whole)).drop("n_best_patches")


def decoded(encoded: DataFrame, vocab: dict | None = None, model: str = MODEL) -> DataFrame:
    """doc_id and the text of ``ids`` (null for null)."""
    made = encoded.sparkSession.sparkContext.broadcast(vocab or vocabulary(model))

    @F.pandas_udf("string")
    def back(col: pd.Series) -> pd.Series:
        seg = Segmenter(made.value, 1)
        return pd.Series([None if ids is None else seg.decode(ids)[1:].replace(SPACE, " ") for ids in col])

    return encoded.select("doc_id", back("ids").alias("text"))
