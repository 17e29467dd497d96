"""Substring dedup by relative Lempel-Ziv parsing.

Every document is factored greedily against the text of all documents with
smaller ids: a factor is a stretch of its words that also stands in such a
document (its origin). The reference is indexed in blocks that the text itself
delimits: of the word ``GRAM``-grams in each window of ``WINDOW`` words the one with
the smallest hash (leftmost of equals) is the window's anchor, and the windows
with one anchor in a row form a block. Equal windows have equal anchors wherever
they stand, so the index by anchor misses no match; it holds about one row for
22 words.

1. Index: anchor and 128-bit hash of the words of each block. Anchors that occur
   in one document only can't match and go.
2. Whole blocks that a smaller document has too. Of these, 2, 4, 8 ... neighbours
   are hashed and looked up together, wherever they begin, so that it is known
   for each block how far (within a factor of two) the text goes on in which
   document.
3. Greedy factors: from the left, the longest of these matches begins a factor;
   it goes on as long as the next blocks stand next in the same origin.
4. Factor boundaries: where a block isn't found whole but its anchor is, its
   windows are hashed and looked up singly among those of all distinct blocks
   with this anchor; they lengthen a factor at its ends, or are short ones.

A factor of ``WINDOW`` words or more is a duplicate span; what such factors cover
is removed. The answer is that of comparing all windows; 128-bit hashes stand
for their words. Lookups are grouped minima and equi-joins: a passage that a
third of all documents hold is combined map-side, and AQE may split its join
partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import stored, table

WINDOW = 50
GRAM = 8

DOC = ["doc", "crc"]
BLOCK = ["b1", "b2"]


class Words:
    """The words of a text (between ASCII white space), joined by one space."""

    def __init__(self, text: str | None):
        words = (text or "").encode().split()
        self.n = len(words)
        self.joined = b" ".join(words)
        self.ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=self.n) + 1) - 1
        self.starts = np.concatenate(([0], self.ends[:-1] + 1)) if self.n else self.ends

    def hashes128(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words first..last, a row (two longs) for each pair."""
        text, digest = self.joined, xxhash.xxh3_128_digest
        got = b"".join([digest(text[s:e]) for s, e in zip(self.starts[first].tolist(), self.ends[last].tolist())])
        return np.frombuffer(got, dtype=np.int64).reshape(-1, 2)


def blocks(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of each block."""
    if words.n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    digest, text = xxhash.xxh64_intdigest, words.joined
    grams = np.fromiter((digest(text[s:e]) for s, e in
                         zip(words.starts[:words.n - gram + 1].tolist(), words.ends[gram - 1:].tolist())),
                        dtype=np.uint64, count=words.n - gram + 1)
    span = window - gram + 1
    anchor = np.concatenate([
        at + np.lib.stride_tricks.sliding_window_view(grams[at:at + (1 << 16) + span - 1], span).argmin(axis=1)
        + np.arange(min(1 << 16, len(grams) - span + 1 - at))
        for at in range(0, len(grams) - span + 1, 1 << 16)])
    first = np.concatenate(([0], np.nonzero(np.diff(anchor))[0] + 1))
    return grams[anchor[first]].view(np.int64), first, np.diff(np.append(first, len(anchor)))


_BLOCKS = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("anchor", pa.int64()), ("b1", pa.int64()),
                     ("b2", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("seq", pa.int32())])
_WINDOWS = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()),
                      ("first", pa.int32())])
_RUNS = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()),
                   ("first", pa.int32()), ("blocks", pa.int32())])
_FACTOR = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("origin", pa.int64()), ("origin_start", pa.int32())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("kept_sha256", pa.string()), ("kept", pa.string()), ("factors", pa.list_(_FACTOR))])


def _batches(columns: list[list[np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], type=f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part, out = batch.slice(at, 256), [[] for _ in _BLOCKS]
            for doc, crc, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                words = Words(text)
                anchor, first, n = blocks(words)
                if len(first):
                    both = words.hashes128(first, first + n - 1 + WINDOW - 1)
                    for c, x in zip(out, (np.full(len(n), doc), np.full(len(n), crc), anchor, both[:, 0], both[:, 1],
                                          first, n, np.arange(len(n)))):
                        c.append(x)
            yield _batches(out, _BLOCKS)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part, out = batch.slice(at, 256), [[] for _ in _WINDOWS]
            for doc, crc, text, spans in zip(*(part.column(i).to_pylist() for i in range(4))):
                words = Words(text)
                first = np.concatenate([np.arange(s["first"], s["first"] + s["n"]) for s in spans])
                both = words.hashes128(first, first + WINDOW - 1)
                for c, x in zip(out, (np.full(len(first), doc), np.full(len(first), crc), both[:, 0], both[:, 1],
                                      first)):
                    c.append(x)
            yield _batches(out, _WINDOWS)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of 2, 4, 8 ... neighbouring blocks of each document's ``spans``
    (sorted by ``seq``; blocks with consecutive numbers are neighbours)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part, out = batch.slice(at, 256), [[] for _ in _RUNS]
            for doc, crc, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                seq = np.array([s["seq"] for s in spans])
                first = np.array([s["first"] for s in spans])
                key = [s["b1"].to_bytes(8, "little", signed=True) + s["b2"].to_bytes(8, "little", signed=True) for s in spans]
                size = 1
                while len(key) > size:
                    # the two halves are neighbours if their numbers differ by the half's size
                    next_to = np.flatnonzero(seq[size:] - seq[:-size] == size)
                    if not len(next_to):
                        break
                    joined = [b""] * len(key)
                    for i in next_to.tolist():
                        if key[i] and key[i + size]:
                            joined[i] = xxhash.xxh3_128_digest(key[i] + key[i + size])
                    key, size = joined, 2 * size
                    there = np.array([i for i in next_to.tolist() if key[i]], dtype=np.int64)
                    if not len(there):
                        break
                    both = np.frombuffer(b"".join(key[i] for i in there.tolist()), dtype=np.int64).reshape(-1, 2)
                    for c, x in zip(out, (np.full(len(there), doc), np.full(len(there), crc), both[:, 0], both[:, 1],
                                          first[there], np.full(len(there), size))):
                        c.append(x)
            yield _batches(out, _RUNS)


def greedy_factors(blocks: list[tuple[int, int]], found: dict[int, list[tuple[int, int, int]]],
                   windows: dict[int, tuple[int, int]], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """Factors ``(start, length, origin, origin_start)`` of one document, by start.

    ``blocks``: first window and number of windows of its matched blocks, in
    order. ``found``: by a block's first window, matches ``(number of blocks,
    origin, origin_start)``. ``windows``: origin and its start of single windows."""
    stretches: list[list[int]] = []  # first window, windows, origin, origin_start

    def go_on(first: int, n: int, origin: int, at: int) -> None:
        last = stretches[-1] if stretches else None
        if last and last[0] + last[1] == first and last[2] == origin and last[3] + last[1] == at:
            last[1] += n
        else:
            stretches.append([first, n, origin, at])
    place = {first: i for i, (first, _) in enumerate(blocks)}
    singles = sorted(windows)
    at, i = 0, 0
    while i < len(blocks) or at < len(singles):
        if i == len(blocks) or (at < len(singles) and singles[at] < blocks[i][0]):
            go_on(singles[at], 1, *windows[singles[at]])
            at += 1
            continue
        first, n = blocks[i]
        matches = found[first]
        last = stretches[-1] if stretches else None
        # the factor before goes on if this block stands next in its origin
        same = [m for m in matches if last and last[0] + last[1] == first and m[1] == last[2] and m[2] == last[3] + last[1]]
        size, origin, start = max(same or matches, key=lambda m: m[0])
        end = place[first] + size
        length = blocks[end - 1][0] + blocks[end - 1][1] - first
        go_on(first, length, origin, start)
        i = end
    return [(first, n + window - 1, origin, start) for first, n, origin, start in stretches]


def _parsed(spans: list[dict]) -> list[tuple[int, int, int, int]]:
    found: dict[int, list[tuple[int, int, int]]] = {}
    blocks, windows = [], {}
    for s in spans:
        if s["blocks"] == 0:
            windows[s["first"]] = (s["origin"], s["origin_start"])
        else:
            found.setdefault(s["first"], []).append((s["blocks"], s["origin"], s["origin_start"]))
            if s["blocks"] == 1:
                blocks.append((s["first"], s["n"]))
    return greedy_factors(sorted(blocks), found, windows)


def _cut(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for doc, text, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                    words = (text or "").encode().split()
                    factors = [f for f in _parsed(spans or []) if f[1] >= WINDOW]
                    edge = np.zeros(len(words) + 1, dtype=np.int32)
                    for start, length, _, _ in factors:
                        edge[start] += 1
                        edge[start + length] -= 1
                    gone = np.cumsum(edge[:-1]) > 0
                    left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if factors else b" ".join(words)
                    rows.append((doc, len(words), int(gone.sum()), hashlib.sha256(left).hexdigest(),
                                 left.decode() if with_text else None,
                                 [dict(zip(_FACTOR.names, f)) for f in factors] if with_text else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in
                                                  zip(zip(*rows) if rows else [[]] * 6, _KEPT)], schema=_KEPT)
    return cut


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.list_(_FACTOR):
             "array<struct<start: int, length: int, origin: long, origin_start: int>>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _with_origin(rows: DataFrame, tag: str) -> DataFrame:
    """``rows`` (``doc``, ``first`` and the hash ``BLOCK``) whose hash a smaller
    document has too, with the smallest such document and a place in it."""
    origin = stored(rows.groupBy(*BLOCK).agg(F.min("doc").alias("origin"), F.max("doc").alias("most"),
                                             F.min_by("first", "doc").alias("origin_start"))
                    .where("origin < most").drop("most"), f"{tag}-origins")
    return rows.join(origin, BLOCK)


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """Matches in ``docs`` (``doc, crc, text``) of smaller ids: ``doc, crc, first, n,
    blocks, origin, origin_start``, from window ``first`` of the document and
    ``origin_start`` of the origin on. ``blocks`` is 1 for a block of ``n`` windows, 0
    for a single window, and 2, 4, 8 ... for so many neighbouring blocks."""
    index = stored(docs.where("doc IS NOT NULL").mapInArrow(_index, _ddl(_BLOCKS)), "rlz-blocks")
    # grouped results are written before they are joined, so that the join has
    # two plain shuffles and AQE can split a frequent key
    shared = stored(index.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                    .where("least < most").select("anchor", "least"), "rlz-anchors")
    common = stored(index.join(shared, "anchor"), "rlz-shared")
    hashes = stored(common.groupBy(*BLOCK).agg(F.min("doc").alias("origin"), F.max("doc").alias("most"),
                                               F.min_by("first", "doc").alias("origin_start")), "rlz-hashes")
    placed = stored(common.join(hashes, BLOCK), "rlz-placed")
    repeated = placed.where("origin < most")
    whole = repeated.select(*DOC, "first", "n", F.lit(1).alias("blocks"), "origin", "origin_start")
    lists = repeated.groupBy(*DOC).agg(F.array_sort(F.collect_set(F.struct("seq", "first", "b1", "b2"))).alias("spans"))
    runs = stored(lists.mapInArrow(_neighbours, _ddl(_RUNS)), "rlz-runs")
    longer = _with_origin(runs, "rlz-longer").select(*DOC, "first", F.lit(0).alias("n"), "blocks", "origin", "origin_start")
    # one document of each distinct block is enough to compare with
    distinct = placed.where("origin = doc")
    open_anchors = distinct.where("least < doc").select("anchor").distinct()
    edges = (distinct.join(open_anchors, "anchor", "left_semi").groupBy(*DOC)
             .agg(F.collect_set(F.struct("first", "n")).alias("spans")))
    windows = stored(docs.join(edges, DOC).select(*DOC, "text", "spans").mapInArrow(_windows, _ddl(_WINDOWS)),
                     "rlz-windows")
    single = _with_origin(windows, "rlz-windows").select(*DOC, "first", F.lit(1).alias("n"), F.lit(0).alias("blocks"),
                                                         "origin", "origin_start")
    return whole.unionByName(longer).unionByName(single).where("origin < doc")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256``
    and with ``with_text`` the ``kept`` words joined by one space and the ``factors``
    (``start, length, origin, origin_start`` in words) that were removed.

    A null or empty text has no words; a text under ``WINDOW`` words keeps all.
    A null id is neither smaller nor larger than another: its text stays whole
    and is no reference. Rows with the same id don't count as duplicates of each
    other; if they hold equal texts they get equal results. An empty table gives
    an empty result; further columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.crc32(F.col(text_col).cast("binary")).alias("crc"),
                       F.col(text_col).alias("text"))
    spans = duplicate_spans(rows).groupBy(*DOC).agg(F.collect_set(F.struct("first", "n", "blocks", "origin", "origin_start")).alias("spans"))
    keyed = rows.join(spans, DOC, "left").select("doc", "text", "spans")
    kept = keyed.mapInArrow(_cut(with_text), _ddl(_KEPT))
    return kept if with_text else kept.drop("kept", "factors")


def op3_rlz_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)
