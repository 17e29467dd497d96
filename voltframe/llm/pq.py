"""Embedding near-dedup by product quantisation.

Vectors are compared within their label by cosine. They are scaled to unit
length, where cosine >= t means distance <= r = sqrt(2 - 2 t).

* Coarse inverted lists: centroids fitted on a bounded sample; each distinct
  vector is listed under its nearest centroid.
* Residual subspace codes: the residual to the centroid is cut into subspaces
  and each part coded by its nearest codebook entry. The length of what the
  code leaves over (the code's error) is stored with it.
* Sufficient probes: a vector y visits list c if the bisecting plane between c
  and y's own centroid is at most r away from y; no member of another list can
  be within r.
* Asymmetric table lookup: distances between y's residual parts and all
  codebook entries are summed by code. The true distance differs from that sum
  by at most the code's error, so whatever lies beyond r plus its error is
  dropped without loss.
* Exact rerank: cosine in double precision of the original vectors.

So no pair is lost, whatever the fit. Equal vectors are collapsed first and
carry their count. Lists are cut into blocks of bounded size, found by counting,
and a block returns, besides counts, a spanning set of its links, not all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import checkpointed, components, table
from voltframe.llm.vectors import matrix, usable

MIN_COSINE = 0.98
#: Bound on the vectors that centroids and codebooks are fitted on, for each vector length.
FIT_ROWS = 8192
LIST_ROWS = 1500
MAX_LISTS = 4096
SUBSPACES = 8
CODES = 32
MEMBER_BLOCK = 4096
PROBE_BLOCK = 8192
ROUNDING = 1e-6


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from evenly spaced rows; an empty centre stays where it is."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(axis=1)[None, :] - 2 * x @ centres.T, axis=1)


@dataclass
class Quantiser:
    centres: np.ndarray
    cuts: list[np.ndarray]
    books: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int) -> Quantiser:
        centres = _kmeans(sample, lists)
        rest = sample - centres[_nearest(sample, centres)]
        cuts = [c for c in np.array_split(np.arange(sample.shape[1]), SUBSPACES) if len(c)]
        return cls(centres, cuts, [_kmeans(rest[:, c], CODES) for c in cuts])

    def encode(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and code error of unit vectors."""
        own = _nearest(u, self.centres)
        rest = u - self.centres[own]
        codes = np.stack([_nearest(rest[:, c], b) for c, b in zip(self.cuts, self.books)], axis=1)
        over = sum(((rest[:, c] - b[codes[:, i]]) ** 2).sum(axis=1)
                   for i, (c, b) in enumerate(zip(self.cuts, self.books)))
        return own, codes, np.sqrt(over)

    @cached_property
    def between(self) -> np.ndarray:
        """Distances of the centres, once per Python worker: at most MAX_LISTS squared numbers."""
        own = (self.centres ** 2).sum(axis=1)
        return np.sqrt(np.maximum(own[:, None] + own[None, :] - 2 * self.centres @ self.centres.T, 0))

    def probes(self, u: np.ndarray, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lists that may hold a vector within ``radius``."""
        to = (u ** 2).sum(axis=1)[:, None] + (self.centres ** 2).sum(axis=1)[None, :] - 2 * u @ self.centres.T
        excess = to - to[np.arange(len(u)), own][:, None]
        return [np.nonzero(e <= 2 * radius * b + ROUNDING)[0] for e, b in zip(excess, self.between[own])]

    def tables(self, u: np.ndarray, at: int) -> list[np.ndarray]:
        """Squared distances of the residual parts to ``at`` from all codes."""
        rest = u - self.centres[at]
        return [((rest[:, c][:, None, :] - b[None, :, :]) ** 2).sum(axis=2) for c, b in zip(self.cuts, self.books)]


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest linked node of each of n nodes, by label propagation with halving."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block_links(min_cosine: float, models: dict[int, Quantiser]):
    radius = float(np.sqrt(2 - 2 * min_cosine)) + ROUNDING

    def links(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim, at = int(keys[1]), int(keys[2])
        members, visitors = rows[~rows["visits"]], rows[rows["visits"]]
        empty = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"),
                              "n": pd.Series(dtype="int64")})
        if not len(members) or not len(visitors):
            return empty
        model = models[dim]
        x, y = matrix(members["v"]), matrix(visitors["v"])
        ux, uy = _unit(x), _unit(y)
        m_id, v_id = members["id"].to_numpy(), visitors["id"].to_numpy()
        copies = members["copies"].to_numpy()
        _, codes, error = model.encode(ux)
        limit = (radius + error + ROUNDING) ** 2
        counts = np.zeros(len(y), dtype=np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        nodes, place = np.unique(np.concatenate((m_id, v_id)), return_inverse=True)
        forest = np.zeros((0, 2), dtype=np.int64)
        for begin in range(0, len(y), 256):
            tables = model.tables(uy[begin:begin + 256], at)
            near = sum(t[:, codes[:, i]] for i, t in enumerate(tables))
            i, j = np.nonzero(near <= limit[None, :])
            for part in range(0, len(i), 200_000):
                p, q = i[part:part + 200_000] + begin, j[part:part + 200_000]
                other = m_id[q] != v_id[p]
                p, q = p[other], q[other]
                ok = (ux[q] * uy[p]).sum(axis=1) >= min_cosine - ROUNDING
                p, q = p[ok], q[ok]
                cos = (x[q] * y[p]).sum(axis=1) / (np.sqrt((x[q] ** 2).sum(axis=1)) * np.sqrt((y[p] ** 2).sum(axis=1)))
                p, q = p[cos >= min_cosine], q[cos >= min_cosine]
                np.add.at(counts, p, copies[q])
                pairs.append((place[q], place[len(m_id) + p]))
                if sum(len(a) for a, _ in pairs) > 500_000:
                    forest, pairs = _shrunk(forest, pairs, len(nodes)), []
        forest = _shrunk(forest, pairs, len(nodes))
        linked = counts > 0
        return pd.concat([pd.DataFrame({"a": v_id[linked], "b": v_id[linked], "n": counts[linked]}),
                          pd.DataFrame({"a": nodes[forest[:, 0]], "b": nodes[forest[:, 1]],
                                        "n": np.zeros(len(forest), dtype=np.int64)})])
    return links


def _shrunk(forest: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """At most n links with the same components."""
    a = np.concatenate([forest[:, 0], *[p for p, _ in pairs]])
    b = np.concatenate([forest[:, 1], *[q for _, q in pairs]])
    root = _roots(a, b, n)
    own = np.nonzero(root != np.arange(n))[0]
    return np.stack((own, root[own]), axis=1)


def _place(models: dict[int, Quantiser], radius: float):
    def place(frames):
        for rows in frames:
            own = np.zeros(len(rows), dtype=np.int64)
            probes: list = [None] * len(rows)
            for dim, part in rows.reset_index(drop=True).groupby("dim"):
                u = _unit(matrix(part["v"]))
                for begin in range(0, len(u), 1024):
                    some = slice(begin, begin + 1024)
                    at = _nearest(u[some], models[int(dim)].centres)
                    idx = part.index.to_numpy()[some]
                    own[idx] = at
                    for i, p in zip(idx, models[int(dim)].probes(u[some], at, radius)):
                        probes[i] = p.astype(np.int32)
            yield rows.assign(list=own.astype(np.int32), probes=probes)
    return place


def cosine_links(vectors: DataFrame, min_cosine: float = MIN_COSINE, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: the id, ``n_links``, ``component_id`` and ``kept``.

    Only vectors of equal, not null label and equal length are compared. Vectors
    that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows without id: they are their own component and kept (a
    null id: null component, kept). Repeated rows link with each other like
    equal vectors. An empty table gives an empty result."""

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"),
                          (usable(F.col(vector_col)) & F.col(label_col).isNotNull()
                           & F.col(id_col).isNotNull()).alias("fit"))
    # -0.0 and 0.0 are one value to grouping. A distinct vector has a number of its
    # own (``id``), since different vectors may carry one id; ``first`` is its smallest id
    distinct = checkpointed(rows.where("fit").groupBy("label", "v").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumns({"dim": F.size("v"), "id": F.monotonically_increasing_id()}))
    sizes = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    models = {}
    for dim, n in sizes.items():
        sample = (distinct.where(F.col("dim") == dim).orderBy(F.xxhash64("first"), "first", "id").limit(FIT_ROWS)
                  .select("v").toPandas())
        models[dim] = Quantiser.fit(_unit(matrix(sample["v"])), min(MAX_LISTS, max(1, -(-n // LIST_ROWS))))
    if not models:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    radius = float(np.sqrt(2 - 2 * min_cosine)) + ROUNDING
    placed = checkpointed(distinct.mapInPandas(
        _place(models, radius), distinct.schema.simpleString()[7:-1] + ",list:int,probes:array<int>"))
    home = ["label", "dim", "list"]
    blocks = (placed.groupBy(*home).agg(F.count(F.lit(1)).alias("members"))
              .withColumn("blocks", F.ceil(F.col("members") / MEMBER_BLOCK).cast("int")))
    visits = placed.select("label", "dim", "id", "v", "copies", F.explode("probes").alias("list"))
    rounds = (visits.groupBy(*home).agg(F.count(F.lit(1)).alias("visitors"))
              .withColumn("rounds", F.ceil(F.col("visitors") / PROBE_BLOCK).cast("int")))
    shape = checkpointed(blocks.join(rounds, home).select(*home, "blocks", "rounds"))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = (placed.join(shape, home).withColumn("block", deal("blocks")).withColumn("round", every("rounds"))
               .select(*home, "block", "round", "id", "v", "copies", F.lit(False).alias("visits")))
    visitors = (visits.join(shape, home).withColumn("round", deal("rounds")).withColumn("block", every("blocks"))
                .select(*home, "block", "round", "id", "v", "copies", F.lit(True).alias("visits")))
    links = checkpointed(members.unionByName(visitors).groupBy(*home, "block", "round")
                         .applyInPandas(_block_links(min_cosine, models), "a long, b long, n long"))
    roots = components(links.where("a <> b").select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "id")
    least = (distinct.join(roots, "id").groupBy("root").agg(F.min("first").alias("least")))
    known = (distinct.select("label", "v", "id", "first", "copies").join(counts, "id", "left")
             .join(roots.join(least, "root").select("id", "least"), "id", "left")
             .select("label", "v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
                     F.coalesce("least", "first").alias("root")))
    linked = (rows.where("fit").join(known, ["label", "v"]).select("id", F.col("n").alias("n_links"),
                                                                   F.col("root").alias("component_id")))
    alone = rows.where("NOT fit").select("id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op2_pq_dedup(spark, sf_dir: str) -> DataFrame:
    return cosine_links(table(spark, sf_dir, "embeddings"))
