"""Secret scans: regular expressions for known kinds, and a linear-chain
conditional random field for what they miss.

Tokens are runs of the characters that credentials consist of, and other runs
without white space. The field tags them begin, inside or outside of a secret.
It decides every token that has anything of a secret: a digit, a capital after
a small letter, a sign of an encoding (``+/=_``), 20 and more characters, or a
word that announces one (password, key, bearer, ...) shortly before it on its
line. The others, plain words in plain company, are outside by a tag
dictionary; runs of the *free* tokens stand between two tokens known to be
outside, so Viterbi over these runs equals Viterbi over the whole text.

Features of a free token: its shape, length, alphabet and share of digits, the
words before it, whether they announce a secret, the character after it, and
features of the whole text (how many free tokens it has, whether it looks like
code), all of whole tokens and words. The field is trained by gradient ascent
on a bounded sample of texts whose tags come from the regular expressions
(distant supervision).
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ship

ship(__name__)

# The patterns of the base kinds, in the order of their rank.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs of 24 and more, as runs are greedy
KINDS = ("assign", "access", "hex", "crf")
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

_T = "A-Za-z0-9+/_.=-"
#: Free by itself: with a digit, a capital after a small letter, a sign of an
#: encoding, or of 20 and more characters; from a token's start, possessive.
FREE = re.compile(f"(?<![{_T}])(?=[A-Za-z.-]*+[0-9+/_=]|[A-Z.-]*+(?:[a-z.-]++[A-Z])|[{_T}]{{20}})[{_T}]++")
TOKEN = re.compile(f"[{_T}]++")
WORD = re.compile(r"\S+")
#: Words that announce a secret; the next ``NEAR`` tokens of the line are free.
ANNOUNCE = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "login")
_ANNOUNCED = re.compile(f"(?:{'|'.join(ANNOUNCE)})[{_T}]*+")
NEAR = 3
DIMS = 1 << 13
TAGS = 3  # outside, begin, inside


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def free_tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the free tokens, in order."""
    spans = {m.span() for m in FREE.finditer(text)}
    low = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)  # as long as the text
    if any(k in low for k in ANNOUNCE):
        for word in _ANNOUNCED.finditer(low):
            stop = text.find("\n", word.end())
            rest = TOKEN.finditer(text, word.end(), len(text) if stop < 0 else stop)
            spans.update(m.span() for m, _ in zip(rest, range(NEAR)))
    return sorted(spans)


def free_runs(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring free tokens (only white space between them)."""
    runs: list[list[tuple[int, int]]] = []
    end = -1
    for start, stop in free_tokens(text):
        if runs and not text[end:start].strip():
            runs[-1].append((start, stop))
        else:
            runs.append([(start, stop)])
        end = stop
    return runs


class Company:
    """The words in front of a place of a text: the beginning of the word that
    the place stands in, then whole words."""

    def __init__(self, text: str):
        self.text = text
        spans = [m.span() for m in WORD.finditer(text)]
        self.starts, self.spans = [s for s, _ in spans], spans

    def before(self, start: int) -> tuple[str, str]:
        """The last two, lower-cased."""
        k = bisect.bisect_right(self.starts, start) - 1
        words = []
        while k >= 0 and len(words) < 2:
            s, e = self.spans[k]
            word = self.text[s:min(e, start)]
            if word:
                words.append(word.lower())
            k -= 1
        return (*words, "", "")[:2]


def _bucket(*parts) -> int:
    return zlib.crc32("\x00".join(map(str, parts)).encode("utf-8", "replace")) & (DIMS - 1)


def _shape(token: str) -> str:
    """Letters and digits by kind, repeats once."""
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", token))))


def file_features(text: str, n_free: int) -> list[int]:
    return [_bucket("file-free", min(n_free, 32).bit_length()),
            _bucket("file-code", "{" in text, ";\n" in text, "=" in text),
            _bucket("file-length", len(text).bit_length() // 2)]


def token_features(text: str, start: int, end: int, company: Company) -> list[int]:
    token, size = text[start:end], end - start
    digits = sum(map(str.isdigit, token))
    last, second = company.before(start)
    alphabet = ("hex" if re.fullmatch(r"[0-9a-f]+", token) else "upper" if re.fullmatch(r"[A-Z0-9]+", token)
                else "number" if re.fullmatch(r"[0-9.+/=-]+", token) else "mixed" if re.search("[a-z]", token) and re.search("[A-Z]", token) else "other")
    shape = _shape(token)
    switches = len(re.findall(r"[A-Za-z][0-9]|[0-9][A-Za-z]", token))
    cases = len(re.findall(r"[a-z][A-Z]", token))
    said = "last" if any(k in last for k in ANNOUNCE) else "second" if any(k in second for k in ANNOUNCE) else "no"
    return [
        _bucket("bias"), _bucket("switches", min(switches, 6)), _bucket("alphabet", alphabet), _bucket("shape", shape if len(shape) <= 8 else "long", alphabet), _bucket("length", min(size, 48) // 4),
        _bucket("alphabet", alphabet, min(size, 48) // 8), _bucket("digits", digits * 8 // size), _bucket("cases", min(cases, 6)),
        _bucket("before", last), _bucket("two-before", second), _bucket("announced", said, last[-1:] in (":", "=")), _bucket("announced", said, alphabet, min(cases, 2), min(size, 24) // 6),
        _bucket("after", text[end:end + 1]), _bucket("glued", text[start - 1:start]),
        _bucket("key", token.split("=")[0].lower() if "=" in token else "-"), _bucket("head", token[:4] if alphabet == "upper" else "-"),
    ]


def emissions(w: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    return w[np.array(rows)].sum(axis=1)


def viterbi(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of runs of one length: ``e`` is (runs, length, tags), each run
    between two tokens that are outside; "inside" never follows "outside"."""
    n, length, _ = e.shape
    score = e[:, 0] + trans[0]
    back = np.zeros((n, length, TAGS), dtype=np.int8)
    for t in range(1, length):
        step = score[:, :, None] + trans[None]
        back[:, t] = step.argmax(axis=1)
        score = step.max(axis=1) + e[:, t]
    tags = np.zeros((n, length), dtype=np.int8)
    tags[:, -1] = (score + trans[:, 0]).argmax(axis=1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


def _gradients(e: np.ndarray, y: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected tags (as ``e``) and transitions, by the forward
    and backward sums of runs of one length."""
    n, length, _ = e.shape
    f = np.zeros_like(e)
    b = np.zeros_like(e)
    f[:, 0] = e[:, 0] + trans[0]
    for t in range(1, length):
        f[:, t] = e[:, t] + np.logaddexp.reduce(f[:, t - 1, :, None] + trans[None], axis=1)
    b[:, -1] = trans[:, 0]
    for t in range(length - 2, -1, -1):
        b[:, t] = np.logaddexp.reduce(trans[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
    z = np.logaddexp.reduce(f[:, -1] + trans[:, 0], axis=1)
    seen = np.eye(TAGS)[y]
    p = np.exp(f + b - z[:, None, None])
    gt = np.zeros_like(trans)
    for t in range(length + 1):
        now = p[:, t] if t < length else np.eye(TAGS)[np.zeros(n, dtype=int)]
        if t == 0:
            gt[0] += (seen[:, 0] - now).sum(axis=0)
        elif t == length:
            gt[:, 0] += (seen[:, -1] - p[:, -1]).sum(axis=0)
        else:
            pair = np.exp(f[:, t - 1, :, None] + trans[None] + (e[:, t] + b[:, t])[:, None, :] - z[:, None, None])
            gt += (seen[:, t - 1, :, None] * seen[:, t, None, :] - pair).sum(axis=0)
    return seen - p, gt


_NEVER = -1e4  # outside to inside


def fit(runs: list[tuple[np.ndarray, np.ndarray]], rounds: int = 120, l2: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, tags) and transitions from runs of (features of each
    token, tags), by Adam on the regularised log-likelihood."""
    groups = defaultdict(list)
    for x, y in runs:
        groups[len(y)].append((x, y))
    packed = [(np.stack([x for x, _ in g]), np.stack([y for _, y in g])) for _, g in sorted(groups.items())]
    n = max(1, sum(y.size for _, y in packed))
    params = [np.zeros((DIMS, TAGS)), np.zeros((TAGS, TAGS))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for t in range(1, rounds + 1):
        trans = params[1].copy()
        trans[0, 2] = _NEVER
        grads = [-l2 * n * params[0], -l2 * n * params[1]]
        for x, y in packed:
            ge, gt = _gradients(params[0][x].sum(axis=2), y, trans)
            for tag in range(TAGS):
                grads[0][:, tag] += np.bincount(x.ravel(), np.repeat(ge[:, :, tag].ravel(), x.shape[2]), minlength=DIMS)
            grads[1] += gt
        for p, g, i in zip(params, grads, range(2)):
            m, v = moments[i]
            m[:], v[:] = 0.9 * m + 0.1 * g / n, 0.999 * v + 0.001 * (g / n) ** 2
            p += 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    params[1][0, 2] = _NEVER
    return params[0], params[1]


def tagged_runs(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Free runs of a text with tags from the base spans."""
    runs = free_runs(text)
    spans = base_spans(text)
    whole, company = file_features(text, sum(map(len, runs))), Company(text)
    out = []
    for run in runs:
        x, y, held = [], [], None
        for s, e in run:
            span = next((k for k, (a, b, _) in enumerate(spans) if a < e and s < b), None)
            y.append(0 if span is None else 2 if span == held else 1)
            held = span
            x.append(token_features(text, s, e, company) + whole)
        out.append((np.array(x), np.array(y)))
    return out


def train(docs: DataFrame, per_class: int = 600, seed: int = 23, runs_per_text: int = 200) -> tuple[np.ndarray, np.ndarray] | None:
    """The field from at most ``per_class`` texts with base spans and as many
    without a span (by a seeded hash of the id), of each at most
    ``runs_per_text`` runs (by a seeded hash of their place). None if no text
    has a span."""
    hot = F.col("text").rlike(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]")
    rows = docs.where("text is not null").select("doc_id", "text", F.when(hot, 1).otherwise(0).alias("hot"))
    from .language import bounded_sample

    def runs_of(batches):
        for pdf in batches:
            got = []
            for d, t in zip(pdf["doc_id"], pdf["text"]):
                runs = tagged_runs(t)
                drawn = sorted(range(len(runs)), key=lambda k: (zlib.crc32(f"{seed}:{k}:{len(t)}".encode()), k))[:runs_per_text]
                got += [(d, k, runs[k][0].shape[1], runs[k][0].astype(np.int32).tobytes(), runs[k][1].astype(np.int32).tobytes()) for k in drawn]
            yield pd.DataFrame(got, columns=["doc_id", "k", "f", "x", "y"])

    got = bounded_sample(rows, "hot", per_class, seed).select("doc_id", "text").mapInPandas(
        runs_of, "doc_id long, k int, f int, x binary, y binary").toPandas().sort_values(["doc_id", "k"])
    runs = [(np.frombuffer(x, np.int32).reshape(-1, f), np.frombuffer(y, np.int32)) for f, x, y in zip(got["f"], got["x"], got["y"])]
    if not any(y.any() for _, y in runs):
        return None
    return fit(runs)


def added_spans(text: str, spans: list[tuple[int, int, str]], model: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int, str]]:
    """Spans that the field tags and no base span touches."""
    runs = free_runs(text)
    if not runs:
        return []
    w, trans = model
    whole, company = file_features(text, sum(map(len, runs))), Company(text)
    by_length = defaultdict(list)
    for run in runs:
        by_length[len(run)].append(run)
    found = []
    for length, group in by_length.items():
        for at in range(0, len(group), 4096):
            some = group[at:at + 4096]
            e = emissions(w, [token_features(text, s, t, company) + whole for run in some for s, t in run])
            for run, tags in zip(some, viterbi(e.reshape(len(some), length, TAGS), trans)):
                for (s, t), tag in zip(run, tags):
                    if tag == 1:
                        found.append([s, t])
                    elif tag == 2 and found:
                        found[-1][1] = t
    ends = sorted(spans)
    out, k, reach = [], 0, -1
    for s, t in sorted(found):
        while k < len(ends) and ends[k][0] < t:
            reach = max(reach, ends[k][1])
            k += 1
        if reach <= s:
            out.append((s, t, "crf"))
    return out


def _digest_input(spans) -> str:
    return ",".join(f"{kind}:{s}:{t}" for s, t, kind in spans)


def find_secrets(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base, spans, n_added for every row.

    ``base`` and ``spans`` are ``kind:start:end`` by start, then kind, joined by
    commas (code points, end exclusive); ``spans`` has the base spans and the
    field's. Null texts count as empty and have none. Without a model only the
    base kinds are found.
    """
    small = None if model is None else (model[0].astype(np.float32), model[1])

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base string, spans string, n_added long")
    def scanned(col: pd.Series) -> pd.DataFrame:
        out = []
        for text in col:
            text = text or ""
            base = base_spans(text)
            added = added_spans(text, base, small) if small is not None else []
            every = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if added else base
            n = [sum(1 for x in base if x[2] == k) for k in KINDS[:3]] if base else [0, 0, 0]
            out.append((*n, _digest_input(base), _digest_input(every), len(added)))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base", "spans", "n_added"])

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", scanned("text").alias("s")).select("doc_id", "s.*")


def secrets_of(docs: DataFrame, per_class: int = 600) -> DataFrame:
    """Train the field on ``docs`` and scan all of it."""
    return find_secrets(docs, train(docs, per_class))
