"""Periodic run detection (operator 13): online dyadic square catching over the words of a text.

Words arrive in order, as 64-bit hashes. For each power of two B, every completed block of B words at a multiple of
B gets a catcher, which lives until 4B words later: it catches the windows of B words that equal its block at a
distance q of 2B - 1 to 4B - 2. Any square of period q holds a whole block of that size in its first half, so none
escapes. A catch is compared backwards word by word; if the block before it matches at the same distance, that
block's catcher has the stretch already. Forwards, each appended word is compared with the one q before it until
they differ: a stretch of matches of q words or more is a square, and squares of one stretch are one run. A catch
inside a known run at a multiple of its period belongs to that run and is dropped at once. Windows have names, built
by doubling: the name of 2B words is a hash of the names of its halves.

``Catchers.append`` takes any number of words; the result doesn't depend on how they were dealt. State is linear
in the words that came in. An Arrow batch is one stream of words with a mark of its own after each text, so no run
crosses texts; each text is judged by itself and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, mix, small_batches
from streamweave.llm.words import AS_IT_IS, Words

#: Fewest words of a run, and how many of its first periods stay.
MIN_LENGTH = 12
VISIBLE = np.ones(256, np.uint8)
VISIBLE[[9, 10, 11, 12, 13, 32]] = 0
TURN = np.uint64(0x9E3779B97F4A7C15)


def matched(words: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, sign: int) -> np.ndarray:
    """How many words from places a and b on are equal, ``room`` at most; sign -1 looks backwards."""
    out = np.zeros(len(a), np.int64)
    left = np.flatnonzero(room > 0)
    width = 4
    while len(left):
        more = np.arange(width)
        done = out[left, None] + more
        inside = done < room[left, None]
        done = np.where(inside, done, 0)
        same = inside & (words[a[left, None] + sign * done] == words[b[left, None] + sign * done])
        full = same.all(axis=1)
        out[left] += np.where(full, width, same.argmin(axis=1))
        left = left[full]
        width = max(4, min(2 * width, (1 << 18) // max(1, len(left))))
    return out


class Level:
    """Windows of ``size`` words: the names of the last ones, the names of the completed blocks."""

    def __init__(self, size: int):
        self.size, self.low, self.names, self.blocks = size, 0, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def of(self, at: np.ndarray) -> np.ndarray:
        return self.names[at - self.low]

    def add(self, first: int, names: np.ndarray) -> None:
        """Takes the names of the windows from ``first`` on; forgets those that nothing can ask for any more."""
        at = np.arange(-first % self.size, len(names), self.size)
        self.blocks = np.concatenate((self.blocks, names[at]))
        self.names = np.concatenate((self.names, names))

    def forget(self, words: int) -> None:
        low = max(self.low, words - 4 * self.size)
        self.names, self.low = self.names[low - self.low:], low


class Catchers:
    """Takes words, reports runs. ``longest``: no stretch of words that counts is longer."""

    def __init__(self, longest: int, min_length: int = MIN_LENGTH):
        self.min_length, self.n = min_length, 0
        self.words = np.zeros(0, np.uint64)
        self.levels = [Level(1)]
        while 2 * (2 * self.levels[-1].size * 2 - 1) <= longest:
            self.levels.append(Level(2 * self.levels[-1].size))
        self.open = np.zeros((0, 2), np.int64)   # start, period of stretches that reach the last word
        self.runs = np.zeros((0, 3), np.int64)   # start, end, period of closed ones that are runs

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self.words = np.concatenate((self.words, words))
        here = np.full(len(self.open), old)
        end = old + matched(self.words, here - self.open[:, 1], here, np.full(len(here), len(words)), 1)
        self._keep(self.open[:, 0], end, self.open[:, 1], fresh=False)
        below = None
        for level in self.levels:
            first = max(0, old - level.size + 1)
            last = self.n - level.size + 1
            if last <= first:
                break
            at = np.arange(first, last)
            if below is None:
                level.add(first, words)
            else:
                level.add(first, mix(below.of(at) * TURN + below.of(at + below.size)))
            for back in (0, 1):
                self._catch(level, at, back)
            below = level
        for level in self.levels:
            level.forget(self.n)

    def _catch(self, level: Level, at: np.ndarray, back: int) -> None:
        """The new windows ``at`` against the nearest catcher that reaches them, or the one before it."""
        size = level.size
        block = (at - 2 * size + 1) // size - back
        here = np.flatnonzero((block >= 0) & (block * size >= at - 4 * size + 2))
        block, at = block[here], at[here]
        caught = level.blocks[block] == level.of(at)
        block, at = block[caught], at[caught]
        before = np.flatnonzero(block > 0)
        known = np.zeros(len(at), bool)
        known[before] = level.blocks[block[before] - 1] == level.of(at[before] - size)
        start, at = block[~known] * size, at[~known]
        period = at - start
        free = ~self._inside(start, at + size, period)
        start, at, period = start[free], at[free], period[free]
        if not len(at):
            return
        first = start - matched(self.words, start - 1, at - 1, np.minimum(start, size), -1)
        end = at + size + matched(self.words, start + size, at + size, self.n - at - size, 1)
        self._keep(first, end, period)

    def _inside(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether a known run holds the stretch and its period divides this one."""
        now = self.open[self.n - self.open[:, 0] >= 2 * self.open[:, 1]]
        runs = np.concatenate((self.runs, np.stack((now[:, 0], np.full(len(now), self.n), now[:, 1]), 1)))
        if not len(runs) or not len(start):
            return np.zeros(len(start), bool)
        runs = runs[np.lexsort((-runs[:, 2], runs[:, 1], runs[:, 0]))]
        reach = np.maximum.accumulate(runs[:, 1])
        best = np.maximum.accumulate(np.where(runs[:, 1] == reach, np.arange(len(runs)), 0))
        at = np.searchsorted(runs[:, 0], start, "right") - 1
        run = runs[best[np.maximum(at, 0)]]
        return (at >= 0) & (run[:, 1] >= end) & (period % run[:, 2] == 0)

    def _keep(self, start: np.ndarray, end: np.ndarray, period: np.ndarray, fresh: bool = True) -> None:
        """Stretches that reach the last word stay open, others that are long enough become runs."""
        still = end == self.n
        now = np.stack((start, period), 1)[still]
        self.open = np.concatenate((self.open, now)) if fresh else now
        size = end - start
        good = ~still & (size >= np.maximum(self.min_length, 2 * period))
        if good.any():
            self.runs = np.concatenate((self.runs, np.stack((start, end, period), 1)[good]))

    def finish(self) -> np.ndarray:
        """(start, end, period) of all runs by start, then period; of one stretch the smallest period."""
        start, period = self.open.T
        self.n += 1  # no word comes any more: all stretches end
        self._keep(start, np.full(len(start), self.n - 1), period, fresh=False)
        runs = self.runs[np.lexsort((self.runs[:, 2], self.runs[:, 1], self.runs[:, 0]))]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        runs = runs[new]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(column: pa.Array, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words of each text, runs as (text, start, length, period), flags of the words that go)."""
    words = Words(column, VISIBLE, AS_IT_IS)
    n = np.diff(words.first)
    total = len(words.hash) + len(n)
    at = np.arange(len(words.hash)) + np.repeat(np.arange(len(n)), n)
    stream = np.empty(total, np.uint64)
    stream[words.first[1:] + np.arange(len(n))] = mix(np.arange(1, len(n) + 1).astype(np.uint64) * TURN)
    stream[at] = words.hash
    catchers = Catchers(int(n.max(initial=0)), min_length)
    catchers.append(stream)
    runs = catchers.finish()
    gone = np.zeros(total + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    text = np.searchsorted(words.first[1:] + np.arange(len(n)), runs[:, 0])
    start = runs[:, 0] - words.first[text] - text
    return n, np.stack((text, start, runs[:, 1] - runs[:, 0], runs[:, 2]), 1), np.cumsum(gone)[at] > 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row for each row of ``docs``.

    Words are runs of characters other than white space, as they are written, numbered from 0. ``runs``: every stretch
    with smallest period q (words q apart are equal) of max(min_length, 2q) words or more that no neighbouring word
    extends, as structs (start, length, period) by start, then period. ``collapsed``: the words without those
    that lie in a run after its first q words, with a space between.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Repeated rows get equal results, a null id
    stays null, an empty table gives an empty result, other columns are ignored. Words are told apart by 64-bit
    hashes. One text's words must fit into a task: some 100 bytes a word."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in chunks(batches, 1):
            texts = batch.column(1)
            n, runs, gone = runs_of(texts, min_length)
            first = np.concatenate(([0], np.cumsum(n)))
            found = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
            offsets = pa.array(np.searchsorted(runs[:, 0], np.arange(len(n) + 1)), pa.int32())
            collapsed = []
            for i, text in enumerate(texts.to_pylist()):
                own, out = (text or b"").split(), gone[first[i]:first[i + 1]]
                collapsed.append(b" ".join([own[j] for j in np.flatnonzero(~out)] if out.any() else own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, found).cast(kind),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return (small_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
            .mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                             "collapsed string"))


def digest(runs: DataFrame) -> DataFrame:
    """Of each row of ``periodic_runs``: the number of runs, the longest one (ties: smallest start, then period), hashes."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
                                                    F.lit("\n")))
    return runs.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
