"""Approximate nearest neighbours by collision-counting hashing.

Vectors are dealt into blocks. In a block ``PROJECTIONS`` random lines each hold
a sorted array of the vectors' projections. A query opens a window around its
own projection on every line; virtual rehashing widens all windows by ``GROWTH``
at a time, and only newly covered entries are counted. A vector that has
collided on more than ``COLLISIONS`` of the lines is verified: its exact
distance to the query is taken. The search of a block ends when the k-th
verified distance is at most the window's radius: a nearer vector would, with
its projections spread normally about the query's, have collided often enough
with a probability of about 0.99; or when the block is exhausted.

Every block is searched for every query and gives at most k rows a query; the
nearest of those are the result. A block's arrays are built once for each of at
most ``MOST_ROUNDS`` parts of the queries, which then pass by in batches; there
are ``MOST_BLOCKS`` blocks at most, which grow beyond ``BLOCK_ROWS`` with the
table. So the rows shuffled are ``MOST_ROUNDS`` times the vectors and
``MOST_BLOCKS`` times the queries at most, in proportion to both; memory is that
of one block. The search itself is queries x blocks, as in any exact check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltframe.llm.common import checkpointed, table
from voltframe.llm.vectors import matrix, usable

K = 10
BLOCK_ROWS = 12_000
QUERY_ROWS = 512
MOST_BLOCKS = 512
MOST_ROUNDS = 8
PROJECTIONS = 40
#: Share of the lines a vector must collide on. A vector at the window's radius
#: collides on a line with probability 0.683.
COLLISIONS = 0.5
GROWTH = 1.25
SEED = 7


class SortedProjections:
    """Sorted arrays of a block's projections on random lines."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.x, self.ids = x[order], ids[order]
        self.lines = np.random.default_rng(SEED).standard_normal((PROJECTIONS, x.shape[1]))
        at = self.lines @ self.x.T
        self.rows = np.argsort(at, axis=1, kind="stable")
        self.sorted = np.take_along_axis(at, self.rows, axis=1)
        #: a first radius: that of a window with about k entries in the middle of a line
        spread = np.median(self.sorted[:, -1] - self.sorted[:, 0]) if len(x) else 0.0
        self.first = max(spread * K / max(len(x), 1), 1e-9)

    def search(self, q: np.ndarray, q_id, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the k nearest verified vectors, ties to smaller ids."""
        n = len(self.x)
        own = int(np.count_nonzero(self.ids == q_id))
        centre = self.lines @ q
        counts = np.zeros(n, dtype=np.int32)
        need = int(np.ceil(COLLISIONS * PROJECTIONS))
        low = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, centre)])
        high = low.copy()
        done = np.zeros(n, dtype=bool)
        found, near = np.zeros(0, dtype=np.int64), np.zeros(0)
        radius = self.first
        while True:
            fresh = []
            for line in range(PROJECTIONS):
                s = self.sorted[line]
                lo = int(np.searchsorted(s, centre[line] - radius, "left"))
                hi = int(np.searchsorted(s, centre[line] + radius, "right"))
                lo, hi = min(lo, low[line]), max(hi, high[line])
                fresh += [self.rows[line, lo:low[line]], self.rows[line, high[line]:hi]]
                low[line], high[line] = lo, hi
            counts += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int32)
            check = np.nonzero((counts >= need) & ~done)[0]
            if len(check):
                done[check] = True
                check = check[self.ids[check] != q_id]
                gap = np.sqrt(((self.x[check] - q) ** 2).sum(axis=1))
                found, near = np.concatenate((found, check)), np.concatenate((near, gap))
                best = np.lexsort((self.ids[found], near))[:k]
                found, near = found[best], near[best]
            enough = min(k, n - own)
            if len(found) >= enough and (enough == 0 or near[enough - 1] <= radius or done.all()):
                return found, near
            radius *= GROWTH


_FOUND = pa.schema([("number", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (dim, block, round), the block's vectors before the
    queries: each block is indexed once, and its queries pass by in batches."""
    at, members, index = None, [], None
    for batch in batches:
        rows = batch.to_pandas()
        keys = list(zip(rows["dim"], rows["block"], rows["round"], rows["is_query"]))
        begin = 0
        while begin < len(rows):
            key = keys[begin]
            end = begin + 1
            while end < len(rows) and keys[end] == key:
                end += 1
            part = rows.iloc[begin:end]
            begin = end
            if key[:3] != at:
                at, members, index = key[:3], [], None
            if not key[3]:
                members.append((matrix(part["v"]), part["id"].to_numpy()))
            elif members:
                if index is None:
                    index = SortedProjections(np.concatenate([x for x, _ in members]),
                                              np.concatenate([i for _, i in members]))
                got = [(number, q_id, *index.search(q, q_id, K)) for number, q_id, q in
                       zip(part["number"].tolist(), part["id"].tolist(), matrix(part["v"]))]
                sizes = [len(g[2]) for g in got]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([g[0] for g in got], sizes)), pa.array(np.repeat([g[1] for g in got], sizes)),
                     pa.array(np.concatenate([index.ids[g[2]] for g in got])),
                     pa.array(np.concatenate([g[3] for g in got]))], schema=_FOUND)


def nearest(data: DataFrame, queries: DataFrame, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``K`` nearest found of ``data`` for
    each row of ``queries`` by Euclidean distance, nearest first, ties to the
    smaller id.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do rows without id; only vectors of equal length meet. A
    row with the query's id counts as the query's own. Repeated rows of ``data``
    are candidates each; a query that is repeated with the same vector is
    searched once, one with another vector is another query. An empty table
    gives an empty result."""
    def clean(df: DataFrame) -> DataFrame:
        return (df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
                .select(F.col(id_col).cast("long").alias("id"),
                        F.col(vector_col).cast("array<double>").alias("v"), F.size(vector_col).alias("dim")))
    # a number for each query: its rows must get the same one in every block
    data, queries = clean(data), checkpointed(clean(queries).dropDuplicates(["id", "v"])
                                              .withColumn("number", F.monotonically_increasing_id()))
    blocks = min(MOST_BLOCKS, max(1, -(-data.count() // block_rows)))
    rounds = min(MOST_ROUNDS, max(1, -(-queries.count() // query_rows)))
    # dealt by a hash, so equal vectors of different rows spread
    deal = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = ["dim", "block", "round", "is_query"]
    left = data.select("id", "v", "dim", F.lit(None).cast("long").alias("number"), F.lit(False).alias("is_query"),
                       deal(blocks, F.col("id"), F.col("v")).alias("block"), every(rounds).alias("round"))
    right = queries.select("id", "v", "dim", "number", F.lit(True).alias("is_query"), every(blocks).alias("block"),
                           deal(rounds, F.col("id")).alias("round"))
    found = (left.unionByName(right).repartition(blocks * rounds, *place[:3]).sortWithinPartitions(*place)
             .mapInArrow(_search, "number long, query_id long, vec_id long, score double"))
    order = Window.partitionBy("number").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
            .select("query_id", "rank", "vec_id", "score"))


def op7_collision_ann(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0"))
