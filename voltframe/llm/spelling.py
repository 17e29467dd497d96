"""Spelling variant grouping by k-d trees over letter counts.

Two words are near if one inserted, deleted or replaced letter turns one into
the other. One edit changes the letter counts by a distance (L1) of at most
two: a replacement raises one count and lowers another, an insertion raises one.

1. Words are counted: within each batch, then by a grouped sum.
2. A tree whose leaves are cells is fitted on a bounded sample of the words
   (``SAMPLE_A_CELL`` a cell, ``MOST_CELLS`` cells of about ``CELL_WORDS``). Its
   planes cut the word's length or a letter's count. Every word goes to its own
   cell, and as a query to each cell whose box it may reach with one letter more
   and one less (words of its length) or one more (words longer by one). Of two
   words of one length in different cells only the one on the lower side of the
   plane that parts them asks, so each pair is found once.
3. In a cell there is a k-d tree for each length; queries of that length and of
   the next shorter one descend it all at once, pruned by the boxes, and what the
   leaves hold is compared letter by letter.
4. Forms and roots: a grouped minimum over both directions of the pairs, then
   pointer doubling; a form is ``FORM_FACTOR`` times as frequent as its word, so
   chains are short.

A word of k letters has at most 90 (2 k + 1) near words, so no group of pairs
grows with the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import stored, table

FORM_FACTOR = 10
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: Words of one cell, sampled words for each cell, and cells, about and at most.
CELL_WORDS = 1 << 15
SAMPLE_A_CELL = 64
MOST_CELLS = 1 << 14
LEAF_WORDS = 16
#: Rows of queries that a leaf compares at a time.
BLOCK = 1 << 14
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000

#: Fixed values of the query: its runs of letters, its case folding, its planted misspellings.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLANTED = 31

#: Column of a letter's count: a to z, then U+00C0 to U+00FF; column 0 is the length.
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[ord("a"):ord("z") + 1] = np.arange(1, 27)
_COLUMN[0xC0:0x100] = np.arange(27, 91)
_COLUMNS = 91
_OUT = 9  # what a wrong length adds to the letters that are missing


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Latin-1 codes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Length and letter counts of each row of ``letters``."""
    rows, length = letters.shape
    at = _COLUMN[letters] + np.arange(rows)[:, None] * _COLUMNS
    counts = np.bincount(at.ravel(), minlength=rows * _COLUMNS).reshape(rows, _COLUMNS)
    counts = counts.astype(np.int8 if length < 128 else np.int32)
    counts[:, 0] = length
    return counts


class KdTree:
    """Planes ``column <= cut`` over rows of counts. With ``leaves``, so many
    leaves at most, numbered from 0; else leaves hold up to ``LEAF_WORDS`` rows,
    or rows that are all equal."""

    def __init__(self, counts: np.ndarray, leaves: int | None = None):
        self.leaves: list[np.ndarray] = []
        self.nodes: list[tuple[int, int, int, int]] = []  # column, cut, lower and upper child (~leaf)
        self.root = self._grow(counts, np.arange(len(counts)), leaves)

    def _grow(self, counts: np.ndarray, rows: np.ndarray, leaves: int | None) -> int:
        plane = None
        if (leaves is None and len(rows) > LEAF_WORDS) or (leaves is not None and leaves > 1 and len(rows) > 1):
            plane = self._plane(counts[rows])
        if plane is None:
            self.leaves.append(rows)
            return -len(self.leaves)
        column, cut = plane
        low = counts[rows, column] <= cut
        first = None if leaves is None else min(max(round(leaves * low.mean()), 1), leaves - 1)
        at = len(self.nodes)
        self.nodes.append((column, cut, 0, 0))
        lower = self._grow(counts, rows[low], first)
        upper = self._grow(counts, rows[~low], None if leaves is None else leaves - first)
        self.nodes[at] = (column, cut, lower, upper)
        return at

    @staticmethod
    def _plane(counts: np.ndarray) -> tuple[int, int] | None:
        """The most varied column, cut where its halves are most alike in size."""
        column = int(counts.astype(np.float32).var(axis=0).argmax())
        values, times = np.unique(counts[:, column], return_counts=True)
        if len(values) < 2:
            return None
        under = np.cumsum(times)[:-1]
        return column, int(values[np.abs(2 * under - len(counts)).argmin()])

    def visit(self, queries: np.ndarray, more: int, fewer: int,
              one_way: bool = False) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the rows of ``queries`` whose words may be there: with at most
        ``more`` letters that a query lacks and ``fewer`` that it has too many.
        ``one_way``: a query leaves its own path to the upper side only."""
        def descend(node: int, rows: np.ndarray, lack: np.ndarray, over: np.ndarray, strayed: np.ndarray,
                    box: dict[int, tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
            if not len(rows):
                return
            if node < 0:
                yield -1 - node, rows
                return
            column, cut, lower, upper = self.nodes[node]
            low, high = box.get(column, (-1, 1 << 30))
            value = queries[rows, column].astype(np.int64)
            weight = _OUT if column == 0 else 1
            above = np.maximum(value - cut, 0) - np.maximum(value - high, 0)
            less = over + weight * above
            go = less <= fewer
            if one_way:
                go &= strayed | (value <= cut)
            yield from descend(lower, rows[go], lack[go], less[go], strayed[go], {**box, column: (low, cut)})
            below = np.maximum(cut + 1 - value, 0) - np.maximum(low - value, 0)
            need = lack + weight * below
            go = need <= more
            yield from descend(upper, rows[go], need[go], over[go], (strayed | (value <= cut))[go],
                               {**box, column: (cut + 1, high)})

        none = np.zeros(len(queries), dtype=np.int64)
        return descend(self.root, np.arange(len(queries)), none, none, none.astype(bool), {})


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` (rows) and ``b`` (columns) differ in one letter."""
    differ = np.zeros((len(a), len(b)), dtype=np.int32)
    for i in range(a.shape[1]):
        differ += a[:, i, None] != b[None, :, i]
    return differ == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``b``, one letter longer, are words of ``a`` with a letter put in."""
    same = np.zeros((len(a), len(b)), dtype=np.int32)
    front = np.ones((len(a), len(b)), dtype=bool)
    back = front.copy()
    length = a.shape[1]
    for i in range(length):
        front &= a[:, i, None] == b[None, :, i]
        same += front
        back &= a[:, length - 1 - i, None] == b[None, :, length - i]
        same += back
    return same >= length


def _letter_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text with their number of occurrences."""
    found: Counter = Counter()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text:
                    found.update(_words(doc, text))
            if len(found) > COUNTED:
                yield _counted(found)
                found.clear()
    yield _counted(found)


def _words(doc: str | None, text: str) -> Iterator[str]:
    before = zlib.crc32(f"{doc}:".encode()) if doc is not None else None
    for m in RUN.finditer(text):
        word = m.group().translate(_LOWER)
        h = 1 if before is None else zlib.crc32(word.encode(), before)
        if h % PLANTED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        if len(word) >= LEAST_LETTERS:
            yield word


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                      names=["word", "n"])


def planted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least ``LEAST_LETTERS`` letters that occur
    ``LEAST_COUNT`` times, one run of letters in ``PLANTED`` (by the checksum of
    document and run) having lost a letter. Runs of a row without an id keep
    theirs; a null text has no words."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_letter_runs, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


_DATA, _SAME, _LONGER = 1, 2, 4


def _router(tree: KdTree):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1)
            counts = np.zeros((len(words), _COLUMNS), dtype=np.int32)
            lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                counts[rows] = counts_of(letters_of([words[i] for i in rows.tolist()], length))
            longer = counts.copy()
            longer[:, 0] += 1
            visits = [(cell, rows, kind) for kind, found in (
                (_DATA, tree.visit(counts, 0, 0)), (_SAME, tree.visit(counts, 1, 1, one_way=True)),
                (_LONGER, tree.visit(longer, 1, 0))) for cell, rows in found]
            key = np.concatenate([cell * len(words) + rows for cell, rows, _ in visits] or [np.zeros(0, dtype=np.int64)])
            kind = np.concatenate([np.full(len(rows), k) for _, rows, k in visits] or [np.zeros(0, dtype=np.int64)])
            order = np.argsort(key, kind="stable")
            key, first = np.unique(key[order], return_index=True)
            row = key % max(len(words), 1)
            kinds = np.bitwise_or.reduceat(kind[order], first) if len(first) else kind
            yield pa.RecordBatch.from_arrays(
                [pa.array(key // max(len(words), 1), pa.int32()), batch.column(0).take(pa.array(row)),
                 n.take(pa.array(row)), pa.array(kinds, pa.int32())], names=["cell", "word", "n", "kinds"])
    return route


def _near_in_cell(cell: pa.Table) -> pa.Table:
    """All near pairs of a cell's words and the queries sent to it."""
    words, kinds = cell["word"].to_pylist(), cell["kinds"].to_numpy()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    lefts, rights = [], []

    def rows_of(kind: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero((lengths == length) & (kinds & kind > 0))
        return rows, letters_of([words[i] for i in rows.tolist()], length)

    for length in np.unique(lengths[kinds & _DATA > 0]).tolist():
        data, data_letters = rows_of(_DATA, length)
        tree = KdTree(counts_of(data_letters))
        for kind, ask, more, fewer, test in ((_SAME, length, 1, 1, one_replaced),
                                             (_LONGER, length - 1, 1, 0, one_inserted)):
            asking, letters = rows_of(kind, ask)
            if not len(asking):
                continue
            counts = counts_of(letters)
            counts[:, 0] = length
            for leaf, rows in tree.visit(counts, more, fewer):
                there = tree.leaves[leaf]
                for at in range(0, len(rows), BLOCK):
                    part = rows[at:at + BLOCK]
                    q, d = np.nonzero(test(letters[part], data_letters[there]))
                    left, right = asking[part[q]], data[there[d]]
                    # two words of the cell itself find each other; other queries ask once
                    once = (left < right) | (kinds[left] & _DATA == 0) | (kind == _LONGER)
                    lefts.append(left[once])
                    rights.append(right[once])
    none = np.zeros(0, dtype=np.int64)
    left, right = pa.array(np.concatenate(lefts or [none])), pa.array(np.concatenate(rights or [none]))
    return pa.table({"a": cell["word"].take(left), "a_n": cell["n"].take(left), "b": cell["word"].take(right),
                     "b_n": cell["n"].take(right)})


def near_pairs(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of near words once. ``words`` has distinct
    words of a-z and U+00C0 to U+00FF and their counts ``n``."""
    total = words.count()
    cells = min(-(-max(total, 1) // cell_words), MOST_CELLS)
    sample = [r[0] for r in words.select("word").orderBy(F.xxhash64("word"), "word")
              .limit(SAMPLE_A_CELL * cells).collect()] if cells > 1 else []
    counts = np.zeros((len(sample), _COLUMNS), dtype=np.int32)
    for i, word in enumerate(sample):
        counts[i] = counts_of(letters_of([word], len(word)))[0]
    routed = words.select("word", "n").mapInArrow(_router(KdTree(counts, cells)),
                                                  "cell int, word string, n long, kinds int")
    return routed.groupBy("cell").applyInArrow(_near_in_cell, "a string, a_n long, b string, b_n long")


def spelling_variants(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """One row per row of ``words`` (distinct ``word``, count ``n``): ``word, form,
    root, n, n_near, form_n``.

    ``n_near`` is the number of near words, ``form`` the most frequent of them
    (ties: the first by code points) if it is ``FORM_FACTOR`` times as frequent
    as the word, ``root`` where the forms lead. No words, an empty result."""
    words = stored(words.select("word", "n"), "variant-words")
    pairs = stored(near_pairs(words, cell_words), "variant-pairs")
    both = pairs.select("a", F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("w")).alias("near")).unionByName(
        pairs.select(F.col("b").alias("a"), F.struct((-F.col("a_n")).alias("m"), F.col("a").alias("w")).alias("near")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    enough = -F.col("best.m") >= FORM_FACTOR * F.col("n")
    grouped = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.w")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")),
        "variant-forms")
    step = grouped.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        further = step.select(F.col("word").alias("__from"), F.col("root").alias("__to"))
        step = stored(step.join(further, F.col("root") == F.col("__from"), "left")
                      .select("word", F.coalesce("__to", "root").alias("root"),
                              F.col("__to").isNotNull().alias("moved")), "variant-roots")
        if step.where("moved").isEmpty():
            break
    return grouped.join(step.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(planted_words(table(spark, sf_dir, "documents")))
