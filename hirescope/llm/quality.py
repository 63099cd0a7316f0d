"""Quality scores from compression.

Two zstandard dictionaries are built from text that is labelled good and bad.
A text is compressed block by block with either; what the good dictionary
saves over the bad one, relative to the size without a dictionary, is the
normalised difference. A logistic curve, fitted on further labelled rows,
turns it - with how far the text compresses by itself, and their product -
into a probability that the label is 1.

Blocks are of a fixed size, so a dictionary weighs as much at the end of a
long text as at its start, and whole texts of any length need one block of
memory. Dictionaries and curve are fitted on bounded samples of labelled rows;
every row is scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ship, stored
from .language import bounded_sample, held_out

ship(__name__)

BLOCK = 4096  # bytes
LEVEL = 3
DICT_BYTES = 64 * 1024
THRESHOLD = 0.3


class Sizer:
    """Compressed sizes of texts with the good, the bad and no dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        made = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO)
            d.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        self.good, self.bad = made
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Normalised size difference (bad minus good, over plain), the share
        that plain compression leaves, and the log of the length."""
        raw = (text or "").encode("utf-8", "replace")
        good = bad = plain = 0
        for at in range(0, len(raw), BLOCK):
            block = raw[at:at + BLOCK]
            good += len(self.good.compress(block))
            bad += len(self.bad.compress(block))
            plain += len(self.plain.compress(block))
        if not raw:
            return 0.0, 1.0, 0.0
        return (bad - good) / plain, plain / len(raw), float(np.log1p(len(raw)))


def basis(f: np.ndarray) -> np.ndarray:
    """Terms of the curve: a constant, the difference, the plain share, and
    products up to the second degree."""
    d, r, n = f[:, 0] * 4, f[:, 1] * 2, f[:, 2] / 10
    return np.stack([np.ones_like(d), d, r, n, d * d, d * r, r * r, d * n, r * n, n * n], axis=1)


def fit_curve(f: np.ndarray, y: np.ndarray, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps; classes weigh as they occur."""
    x = basis(f)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + l2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary from ``samples``; too few for its trainer (it
    needs some hundred): their bytes as a raw dictionary."""
    total = sum(map(len, samples))
    size = max(1024, min(DICT_BYTES, total // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, piece: int = 8192) -> dict | None:
    """Dictionaries and curve from rows that are not held out. At most
    ``per_label`` rows a label make the dictionaries, by one piece of ``piece``
    bytes each; as many others, by their whole texts, make the curve. The curve
    is shifted to the labels' shares among all rows that may be learned from.
    None if a label is missing."""
    marked = labels.where("quality in (0, 1)").select("doc_id", "quality").dropDuplicates(["doc_id", "quality"])
    halves = marked.where(~held_out()).withColumn("part", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(2)))
    known = docs.where(~held_out() & F.col("text").isNotNull()).select("doc_id", "text")

    def texts(part: int) -> DataFrame:
        """Texts of a sample of one half: ids are drawn among the labels, so only
        the drawn rows' texts leave the scan (2 * per_label ids are sent)."""
        ids = stored(bounded_sample(halves.where(F.col("part") == part).select("doc_id", "quality"), "quality", per_label), "quality-ids")
        return known.join(F.broadcast(ids), "doc_id")

    raw = F.col("text").cast("binary")
    start = F.when(F.length(raw) > piece, F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.length(raw) - piece)).otherwise(0)
    got = texts(0).select(
        "doc_id", "quality", F.substring(raw, (start + 1).cast("int"), F.lit(piece)).alias("piece")).toPandas()
    by = {q: [bytes(p) for _, p in sorted(zip(g["doc_id"], g["piece"]))] for q, g in got.groupby("quality")}
    if len(by) < 2:
        return None
    # as many bytes of either, so that neither dictionary knows more
    most = min(sum(map(len, by[q])) for q in by)
    blocks = {q: _blocks(by[q], most) for q in by}
    dicts = {"good": dictionary(blocks[1]), "bad": dictionary(blocks[0])}

    def measured(batches):
        sizer = Sizer(dicts["good"], dicts["bad"])
        for pdf in batches:
            f = np.array([sizer.features(t) for t in pdf["text"]]).reshape(-1, 3)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "a": f[:, 0], "b": f[:, 1], "c": f[:, 2]})

    points = texts(1).select("doc_id", "quality", "text").mapInPandas(
        measured, "doc_id long, quality int, a double, b double, c double").toPandas().sort_values(["quality", "doc_id", "a"])
    if points["quality"].nunique() < 2:
        return None
    w = fit_curve(points[["a", "b", "c"]].to_numpy(), points["quality"].to_numpy())
    n = {r["quality"]: r["n"] for r in marked.where(~held_out()).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    odds = points["quality"].mean() / (1 - points["quality"].mean())
    w[0] += np.log(n[1] / n[0]) - np.log(odds)
    return dicts | {"w": w, "base": n[1] / (n[0] + n[1])}


def _blocks(pieces: list[bytes], most: int) -> list[bytes]:
    out, size = [], 0
    for p in pieces:
        if size >= most:
            break
        out += [p[at:at + BLOCK // 2] for at in range(0, len(p), BLOCK // 2)]
        size += len(p)
    return out


def quality_of(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on).

    Null and empty texts have difference 0, share 1 and length 0 and get the
    curve's value there; without labels of both kinds every score is the
    threshold. One row for each row of ``docs``.
    """
    model = train(docs, labels, per_label)
    out = docs.select("doc_id", "text", held_out().alias("held_out"))
    if model is None:
        return out.select("doc_id", "held_out", F.lit(THRESHOLD).alias("score"), F.lit(1).alias("predicted"))
    good, bad, w = model["good"], model["bad"], model["w"]
    cache: list = []

    @F.pandas_udf("double")
    def scored(col: pd.Series) -> pd.Series:
        if not cache:
            cache.append(Sizer(good, bad))
        f = np.array([cache[0].features(t) for t in col], dtype=np.float64).reshape(-1, 3)
        return pd.Series(1 / (1 + np.exp(-np.clip(basis(f) @ w, -30, 30))))

    arrow_batches(docs.sparkSession)
    out = out.select("doc_id", "held_out", scored("text").alias("score"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
