"""Periodic runs of words, by online dyadic square catching.

The words of a text are appended one after the other. A catcher is a completed
block of ``2^(k+1)`` words that starts at a multiple of ``2^k``; it waits under
the hash of its words. When the last ``2^(k+1)`` words equal a catcher's block
at a distance ``d`` of ``2^k`` to ``2^(k+1) - 1``, a comparison for period ``d``
opens: it is followed back to where the stretch begins, and every appended
word advances it by one comparison with the word ``d`` before. Each success
reports another square; when a comparison ends, the squares of its stretch
have merged into one run.

A run of period ``q`` and at least ``4 q`` words holds a whole catcher of the
level with ``2^k <= q < 2^(k+1)`` among its first ``2^k`` starts, and its copy
``q`` words on: blocks longer than the smallest period recur at no smaller
distance, so the latest equal catcher is the one ``q`` words before. Longer
runs are therefore all caught. Hashes only find catchers; words are compared.

The work is about two catchers and a few look-ups a word; a text takes some
250 bytes a word while it is read, one text at a time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ship

ship(__name__)

MIN_WORDS = 6  # of a run
MIN_PERIODS = 4  # of a run, as a multiple of its smallest period
_PRIME = (1 << 61) - 1
_BASE = 0x1B873593CC9E2D51 % _PRIME
_POWERS = [pow(_BASE, 2 << k, _PRIME) for k in range(40)]


def words_of(text: str | None) -> list[bytes]:
    """Words end at the six ASCII white-space characters and nowhere else."""
    return (text or "").encode("utf-8", "replace").split()


class SquareCatcher:
    """Runs of a sequence of whole numbers that is appended item by item
    (``extend``, ``close``): ``runs`` holds (start, length, period) of those that
    have ended."""

    def __init__(self) -> None:
        self.items: list[int] = []  # appended so far
        self.prefix = [0]  # hashes of all beginnings
        self.pairs: dict[int, int] = {}  # blocks of two words -> latest start
        self.levels: list[dict] = [{} for _ in _POWERS[1:]]  # hash of a longer block -> latest start
        self.open: dict[int, int] = {}  # period -> start of the stretch that still has it
        self.runs: list[tuple[int, int, int]] = []

    def extend(self, new) -> None:
        items, prefix, pairs, levels, opened = self.items, self.prefix, self.pairs, self.levels, self.open
        n, rolled, last = len(items), prefix[-1], items[-1] if items else 0
        for item in new:
            if opened:  # one comparison for each period that still holds
                for period in [p for p in opened if items[n - p] != item]:
                    self._end(period, n)
            items.append(item)
            rolled = (rolled * _BASE + item + 1) % _PRIME
            prefix.append(rolled)
            n += 1
            pair, last = last << 32 | item, item
            if n == 1:
                continue
            caught = pairs.get(pair)
            pairs[pair] = n - 2
            looking = caught is not None
            if caught == n - 3 and 1 not in opened:
                self._begin(1, caught)
            if not looking and n & 1:
                continue
            for k, level in enumerate(levels, 1):
                step, size = 1 << k, 2 << k
                start = n - size
                completed = not n & (step - 1)  # a catcher's block ends here
                if start < 0 or not (completed or looking):
                    break
                block = (rolled - prefix[start] * _POWERS[k]) % _PRIME
                if looking:
                    caught = level.get(block)
                    if caught is None:
                        looking = False  # nor do longer blocks that end here recur
                    else:
                        period = start - caught
                        if step <= period < size and period not in opened and items[caught:caught + size] == items[start:n]:
                            self._begin(period, caught)
                if completed:
                    level[block] = start

    def _begin(self, period: int, start: int) -> None:
        items = self.items
        while start and items[start - 1] == items[start - 1 + period]:
            start -= 1
        self.open[period] = start

    def _end(self, period: int, stop: int) -> None:
        start = self.open.pop(period)
        length = stop - start
        if length >= max(MIN_WORDS, MIN_PERIODS * period) and self._smallest(start, period):
            self.runs.append((start, length, period))

    def _smallest(self, start: int, period: int) -> bool:
        """No smaller period: it would divide this one, and one of the prime
        quotients would be a period as well."""
        rest, prime = period, 2
        root = self.items[start:start + period]
        while rest > 1:
            if prime * prime > rest:
                prime = rest
            if rest % prime:
                prime += 1
                continue
            while not rest % prime:
                rest //= prime
            if root == root[:period // prime] * prime:
                return False
        return True

    def close(self) -> list[tuple[int, int, int]]:
        """All runs, by start, then period."""
        for period in list(self.open):
            self._end(period, len(self.items))
        return sorted(self.runs)


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``."""
    names: dict = {}
    catcher = SquareCatcher()
    catcher.extend([names.setdefault(word, len(names)) for word in words])
    return catcher.close()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words outside all runs and the first period of each, joined by a
    space: what a run repeats is dropped."""
    parts, at = [], 0
    for first, stop in sorted((start + period, start + length) for start, length, period in runs):
        if first > at:
            parts += words[at:first]
        at = max(at, stop)
    return b" ".join(parts + words[at:]).decode("utf-8")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then
    period) and collapsed (the text without what its runs repeat) for every row
    of ``docs`` (doc_id, text).

    A run is a stretch of consecutive words with smallest period ``q`` that no
    neighbouring word extends, of ``MIN_WORDS`` words and ``MIN_PERIODS`` periods
    at least. Null, empty and wordless texts have no words, no runs and an empty
    collapsed text. Rows are independent: repeated ones give equal results.
    Further columns are ignored.
    """

    @F.pandas_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def found(col: pd.Series) -> pd.DataFrame:
        rows = []
        for text in col:
            words = words_of(text)
            runs = runs_of(words)
            rows.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], collapsed(words, runs)))
        return pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", found("text").alias("f")).select("doc_id", "f.*")
