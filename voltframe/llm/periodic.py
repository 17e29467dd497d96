"""Periodic runs by internal pattern matching.

A run is a stretch of consecutive words with smallest period ``q``, at least
``EXPONENT * q`` and ``LEAST`` words long, that can't be extended. Texts are
searched in groups, one after another with a separator of its own behind each,
so that the array work is shared; a longer text is a group alone.

1. Suffix array: ranks by the first 2, 4, 8 ... words (prefix doubling) until
   all differ. The ranks of ``b`` words also name the blocks of that length and
   give each block its interval of the suffix array.
2. Dyadic blocks: of each length ``b`` (a power of two from ``SMALLEST``) those
   at every multiple of ``b / 2`` (of ``b`` itself at ``WHOLE_STEP``). A run of
   period q > b / 2, q <= b, holds one of them and its copy ``q`` words on; as the
   block is a period long, that copy is the next occurrence.
3. Wavelet tree over the suffix array: for each block that occurs again, the
   smallest position above its own in its interval (range successor), for all
   blocks at once. Occurrences within ``b`` words form an arithmetic progression;
   its difference, the distance of the first two, is the candidate period.
4. Each candidate is extended as long as words a period apart are equal; what is
   long enough is a run, and the candidate is its smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import WORD_SEPARATOR, table

EXPONENT = 4
LEAST = 6
#: Shortest block; it serves all periods up to its length.
SMALLEST = 4
#: At this length blocks at its multiples are enough: q + 2 b - 1 <= 4 q for q >= 5.
WHOLE_STEP = 8
#: Words that are searched together; a longer text is searched alone.
GROUP_WORDS = 1 << 16


class WaveletTree:
    """Values ``0 .. n - 1`` in the order of ``values``, one bit a level."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(int(len(values) - 1).bit_length(), 1) - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            zeros = np.concatenate(([0], np.cumsum(~one)))  # zeros before each place
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate((values[~one], values[one]))

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in places ``left .. right - 1`` are under ``bound``
        (which is under the tree's number of values)."""
        count = np.zeros(len(left), dtype=np.int64)
        for bit, zeros, total in self.levels:
            at_left, at_right = zeros[left], zeros[right]
            up = (bound >> bit) & 1 == 1
            count += np.where(up, at_right - at_left, 0)
            left = np.where(up, total + left - at_left, at_left)
            right = np.where(up, total + right - at_right, at_right)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value that ``n`` of those in places ``left .. right - 1`` are under."""
        value = np.zeros(len(left), dtype=np.int64)
        for bit, zeros, total in self.levels:
            at_left, at_right = zeros[left], zeros[right]
            low = at_right - at_left
            up = n >= low
            value += up.astype(np.int64) << bit
            n = np.where(up, n - low, n)
            left = np.where(up, total + left - at_left, at_left)
            right = np.where(up, total + right - at_right, at_right)
        return value

    def successor(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``bound`` in places ``left .. right - 1``,
        -1 if there is none."""
        none = bound >= len(self.levels[0][1]) - 1
        n = self.below(left, right, np.where(none, 0, bound))
        none |= n >= right - left
        return np.where(none, -1, self.nth(left, right, np.where(none, 0, n)))


def _blocks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array of ``words`` and, for each block length, positions and
    intervals of the dyadic blocks that occur more than once."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    rank = _ranks(words[order], order)
    at, length, blocks = np.arange(n), 1, []
    while True:
        if length >= SMALLEST:
            step = length if length == WHOLE_STEP else length // 2
            start = at[0:n - length + 1:step]
            size = np.bincount(rank, minlength=n)[rank[start]]
            again = size > 1
            if again.any():
                left = rank[start[again]]
                blocks.append((length, start[again], left, left + size[again]))
        if length >= n or (np.diff(rank[order]) > 0).all():
            return order, rank, blocks
        second = np.concatenate((rank[length:] + 1, np.zeros(min(length, n), dtype=np.int64)))
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        rank = _ranks(key[order], order)
        length *= 2


def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position how many are smaller."""
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return rank


def find_runs(words: np.ndarray) -> np.ndarray:
    """Start, length and period of each run in an array of word numbers, a row
    each, by start and then period."""
    nothing = np.zeros((0, 3), dtype=np.int64)
    if len(words) < LEAST:
        return nothing
    order, _, blocks = _blocks(words)
    if not blocks:
        return nothing
    start = np.concatenate([b[1] for b in blocks])
    longest = np.concatenate([np.full(len(b[1]), b[0]) for b in blocks])
    copy = WaveletTree(order).successor(np.concatenate([b[2] for b in blocks]),
                                        np.concatenate([b[3] for b in blocks]), start + 1)
    period = copy - start
    near = (copy >= 0) & (period <= longest)
    start, period = start[near], period[near]
    runs = []
    for q in np.unique(period).tolist():
        differ = np.concatenate(([-1], np.flatnonzero(words[:-q] != words[q:]), [len(words) - q]))
        stretch = np.unique(np.searchsorted(differ, start[period == q], side="right"))
        first = differ[stretch - 1] + 1
        length = differ[stretch] - first + q
        long = length >= max(LEAST, EXPONENT * q)
        runs.append(np.column_stack((first[long], length[long], np.full(int(long.sum()), q))))
    found = np.concatenate(runs) if runs else nothing
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of each of some texts, given as lists of words."""
    number: dict[bytes, int] = {}
    numbered, starts, at = [], [], 0
    for words in texts:
        starts.append(at)
        numbered.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64,
                                    count=len(words)))
        at += len(words) + 1
    # a separator stands behind each text; no two are equal
    joined = np.concatenate([np.append(a, -1 - i) for i, a in enumerate(numbered)])
    found = find_runs(joined)
    text = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= np.asarray(starts)[text]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _kept(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)),
                    ("collapsed", pa.string())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        group: list[tuple[object, list[bytes]]] = []
        size = 0
        for i in range(batch.num_rows):
            words = (texts[i].as_py() or "").encode().split()
            if group and size + len(words) > GROUP_WORDS:
                yield _answer(group)
                group, size = [], 0
            group.append((ids[i].as_py(), words))
            size += len(words)
        if group:
            yield _answer(group)


def _answer(group: list[tuple[object, list[bytes]]]) -> pa.RecordBatch:
    found = runs_of([words for _, words in group])
    flat = np.concatenate(found)
    ends = np.cumsum([0] + [len(f) for f in found])
    runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(flat[:, c]) for c in range(3)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in group], pa.int64()), pa.array([len(words) for _, words in group], pa.int64()), runs,
         pa.array([_kept(words, f).decode() for (_, words), f in zip(group, found)], pa.string())], schema=_FOUND)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (array of
    ``start, length, period`` in words, by start and then period) and ``collapsed``
    (the words outside of what runs repeat, joined by one space).

    A null or empty text has no words and no runs. Rows with null or repeated ids
    each keep their row; an empty table gives an empty result; further columns
    are ignored. Memory follows the longest text. Nothing is shuffled."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_search, "doc_id long, n_words long, "
                                    "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_runs(id_col: Column, text_col: Column) -> Column:
    """The text, in one document of ten (by the checksum of its id) with the words
    from some place on replaced by repetitions of a few words at that place."""
    h = F.crc32(id_col.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        times = (F.floor((n - a) / p) + 1).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (n - a).cast("int"))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")

    # in an array of one, so that the words are split once for all their uses
    words = F.array(F.filter(F.split(text_col, WORD_SEPARATOR), lambda w: w != ""))
    return F.when(h % 10 == 0, F.transform(words, repeated)[0]).otherwise(text_col)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = periodic_runs(docs.select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.reduce("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
                       lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", F.col("longest.start").alias("start"), F.col("longest.length").alias("length"),
             F.col("longest.period").alias("period"),
             F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
             "runs_sha256", "collapsed_sha256")
