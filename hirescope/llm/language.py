"""Language identification with error-correcting output codes.

Every language gets a binary codeword. For each bit a logistic classifier on
hashed character n-grams (one to three bytes, folded text) tells its two sides
apart. A text goes to the codeword with the smallest logistic loss against
all bit margins (loss-weighted decoding); the losses of all codewords also
give the score, and texts whose two nearest codewords lie close together are
flagged as ambiguous.

Training reads a bounded sample of labelled rows (``per_language`` at most),
as n-gram counts of their whole texts; prediction reads every whole text in
Arrow batches with numpy.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, ship, stored

ship(__name__)

DIMS = 4096
_PIECE = 1 << 20  # bytes of a text that are hashed at a time
#: ASCII is folded: letters to lower case, all else to a space.
_FOLD = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def ngram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of the folded UTF-8 bytes."""
    raw = b" " + (text or "").encode("utf-8", "replace").translate(_FOLD) + b" "
    out = np.zeros(DIMS, dtype=np.float64)
    for at in range(0, len(raw), _PIECE):
        a = np.frombuffer(raw[at:at + _PIECE + 2], dtype=np.uint8).astype(np.uint32)
        two = (a[:-1] << np.uint32(8)) | a[1:]
        three = (two[:-1] << np.uint32(8)) | a[2:]
        for grams, seed in ((a[:_PIECE], 0x9E3779B1), (two[:_PIECE], 0x85EBCA77), (three[:_PIECE], 0xC2B2AE3D)):
            hashed = grams * np.uint32(seed)
            out += np.bincount((hashed ^ (hashed >> np.uint32(15))) & np.uint32(DIMS - 1), minlength=DIMS)
    return out


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Rows of square roots of relative counts (unit length)."""
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """``n`` codewords of +1 and -1. Up to five: all splits in two (the
    exhaustive code). More: the random code with the largest smallest
    distance of 64 draws, of 10 * log2(n) bits and 15 at least."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = [s for r in range(1, n) for s in combinations(range(n), r) if 0 in s]
        return np.array([[1.0 if i in s else -1.0 for s in splits] for i in range(n)])
    rng, bits, best = np.random.default_rng(seed), max(15, int(np.ceil(10 * np.log2(n)))), None
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        code[:, np.abs(code.sum(axis=0)) == n] *= np.where(np.arange(n) % 2, 1.0, -1.0)[:, None]
        least = ((bits - code @ code.T) / 2 + bits * np.eye(n)).min()
        if best is None or least > best[0]:
            best = (least, code)
    return best[1]


def fit_bits(x: np.ndarray, y: np.ndarray, rounds: int = 300, l2: float = 1e-5) -> np.ndarray:
    """Logistic regression of every bit (columns of ``y``, +1 or -1) by Adam;
    the last row is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros((x.shape[1], y.shape[1]))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        margin = np.clip(y * (x @ w), -30, 30)
        g = -(x.T @ (y / (1 + np.exp(margin)))) / len(x) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def losses(margins: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Logistic loss of every text (row) against every codeword (column)."""
    return np.logaddexp(0, -margins[:, None, :] * code[None, :, :]).sum(axis=2)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bounded_sample(rows: DataFrame, label: str, per_label: int, seed: int = 11) -> DataFrame:
    """At most ``per_label`` rows of each label, by a seeded hash of doc_id:
    thinned by the label's count first, so that the exact cut sees few rows. The
    counts (one number a label, as many as a model has classes) are read first
    and sent to all tasks."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id"))
    counts = rows.groupBy(label).agg(F.count("*").alias("__n"))
    counts = rows.sparkSession.createDataFrame(counts.collect(), counts.schema)
    thin = rows.withColumn("__h", h).join(F.broadcast(counts), label)
    share = F.pmod(F.col("__h"), F.lit(1 << 30)) / float(1 << 30)
    thin = thin.where(share < F.greatest(F.lit(2.0 * per_label), F.lit(200.0)) / F.col("__n"))
    nth = F.row_number().over(Window.partitionBy(label).orderBy("__h"))
    return thin.withColumn("__k", nth).where(F.col("__k") <= per_label).drop("__h", "__k", "__n")


def train(docs: DataFrame, per_language: int = 400) -> dict:
    """The model from rows that are not held out and have a language; the
    counts of at most ``per_language`` texts of a language reach the driver."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")

    def counted(batches):
        for pdf in batches:
            yield pd.DataFrame({"lang": pdf["lang"], "x": [ngram_counts(t).astype(np.float32).tobytes() for t in pdf["text"]]})

    got = bounded_sample(rows, "lang", per_language).mapInPandas(counted, "lang string, x binary").toPandas()
    langs = sorted(got["lang"].unique())
    if not langs:
        return {"langs": [], "code": np.ones((0, 1)), "w": np.zeros((DIMS + 1, 1))}
    got = got.assign(key=[bytes(b) for b in got["x"]]).sort_values(["lang", "key"])  # the same order in every run
    x = _scaled(np.stack([np.frombuffer(b, dtype=np.float32) for b in got["key"]]).astype(np.float64))
    code = codewords(len(langs))
    y = code[[langs.index(v) for v in got["lang"]]]
    return {"langs": langs, "code": code, "w": fit_bits(x, y)}


def identify(docs: DataFrame, model: dict, margin: float = 0.2, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score and ambiguous.

    ``und`` with score 0 for null texts, texts without a letter, and where the
    model knows no language. ``score`` is the share of the nearest codeword in
    exp(-loss) over all codewords; ``ambiguous`` if the two largest shares
    differ by less than ``margin``. Columns of those names are replaced. Every
    text is predicted once, also where the caller filters by the result.
    """
    langs, code, w = list(model["langs"]), model["code"], model["w"]

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predicted(col: pd.Series) -> pd.DataFrame:
        known = np.array([bool(langs) and t is not None and any(map(str.isalpha, t)) for t in col], dtype=bool)
        out = pd.DataFrame({"lang_pred": np.full(len(col), "und", dtype=object), "score": 0.0, "ambiguous": ~known})
        rows = np.flatnonzero(known)
        for at in range(0, len(rows), 512):
            some = rows[at:at + 512]
            x = _scaled(np.stack([ngram_counts(col.iloc[i]) for i in some]))
            loss = losses(x @ w[:-1] + w[-1], code)
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            two = np.sort(share, axis=1)[:, -2:]
            out.loc[some, "lang_pred"] = np.array(langs, dtype=object)[best]
            out.loc[some, "score"] = share[np.arange(len(some)), best]
            out.loc[some, "ambiguous"] = (two[:, 1] - two[:, 0] < margin) if len(langs) > 1 else False
        return out

    # else a filter on the result would be pushed below and predict all texts a
    # second time, by further Python workers
    predicted = predicted.asNondeterministic()
    own = {"lang_pred", "score", "ambiguous"}
    arrow_batches(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]
    return docs.select(*kept, predicted(F.col(text)).alias("__p")).select(*kept, "__p.*")


def language_of(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``docs``."""
    model = train(docs, per_language)
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).drop("text")
