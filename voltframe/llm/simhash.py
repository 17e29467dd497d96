"""SimHash near-dedup with pigeonring filtering.

A document's fingerprint has 64 bits; bit b is 1 if more than half of the
XXH64 values of its word shingles have bit b. Two fingerprints link when they
differ in at most ``max_distance`` bits.

Pigeonring filter: cut the 64 bits into ``max_distance + 1`` segments, seen as
a ring. If two fingerprints differ in at most d bits over m segments, some
segment i starts a chain i, i+1, ... each of whose prefixes of l segments
differs in at most floor(l * d / m) bits. With m = d + 1 that means: segment i
is equal, segments i and i+1 together differ in at most one bit, and so on
along the ring. The first two budgets become an equi-join key (segment i
exactly, segment i+1 exactly or with one bit flipped), the longer prefixes and
the full Hamming distance are checked on the joined pair.

Equal fingerprints are collapsed first. Within a dense group not all pairs are
emitted: each member of a key's group is first compared with the group's
smallest fingerprint, the components of those links are found, and the join
then only returns pairs of different components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from voltframe.llm.common import KEY, by_value, checkpointed, components, row_key

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of one text; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle_words + 1]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in
                              zip(starts.tolist(), ends[shingle_words - 1:].tolist())),
                             dtype=np.uint64, count=len(starts))
    ones = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        chunk = hashes[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(chunk, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)
    return int(value[0])


_fingerprints = by_value(lambda texts: pa.array([fingerprint(t) for t in texts], pa.int64()))


def segments(count: int) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` segments that cover 64 bits."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _segment(fp: str, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(cuts: list[tuple[int, int]], flips: bool) -> Column:
    """Array of (place, key): the segment at ``place`` and its successor, the
    successor also with each single bit flipped if ``flips``."""
    out = []
    for i, cut in enumerate(cuts):
        shift, width = cuts[(i + 1) % len(cuts)]
        key = F.shiftleft(_segment("fp", *cut), width).bitwiseOR(_segment("fp", shift, width))
        masks = [0] + ([1 << b for b in range(width)] if flips else [])
        out += [F.struct(F.lit(i).cast("byte").alias("place"), key.bitwiseXOR(F.lit(mask)).alias("key"))
                for mask in masks]
    return F.array(*out)


def _chain_ok(cuts: list[tuple[int, int]], max_distance: int) -> Column:
    """Cumulative differences along the ring from ``place`` stay in budget."""
    diff = F.col("fp").bitwiseXOR(F.col("fp2"))
    m, ok = len(cuts), F.bit_count(diff) <= max_distance
    for i in range(m):
        mask, within = 0, F.lit(True)
        for length in range(1, m):
            shift, width = cuts[(i + length - 1) % m]
            mask |= ((1 << width) - 1) << shift
            signed = mask - (1 << 64) if mask >> 63 else mask
            within &= F.bit_count(diff.bitwiseAND(F.lit(signed))) <= length * max_distance // m
        ok &= (F.col("place") != i) | within
    return ok


def link_fingerprints(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``fps`` has distinct longs ``fp``; returns ``(fp, root)``, the components
    of fingerprints that differ in at most ``max_distance`` (1 or more) bits."""
    if max_distance < 1:
        return fps.select("fp", F.col("fp").alias("root"))
    cuts = segments(max_distance + 1)
    exact = fps.select("fp", F.inline(_keys(cuts, flips=False)))
    first = exact.groupBy("place", "key").agg(F.min("fp").alias("fp2"), F.max("fp").alias("last"))
    # no broadcast, here and below: Spark sizes all keys of a fingerprint as one row
    star = (exact.join(first.where("fp2 <> last").hint("merge"), ["place", "key"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))).between(1, max_distance))
            .select(F.col("fp").alias("a"), F.col("fp2").alias("b")).distinct())
    star = checkpointed(star)
    part = components(star)
    known = checkpointed(fps.join(part.withColumnRenamed("id", "fp"), "fp", "left")
                         .select("fp", F.coalesce("root", "fp").alias("root")))
    # each row becomes 18 keys a segment: spread the rows over all tasks first
    known = known.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    left = known.select("fp", "root", F.inline(_keys(cuts, flips=False)))
    right = known.select(F.col("fp").alias("fp2"), F.col("root").alias("root2"),
                         F.inline(_keys(cuts, flips=True)))
    rest = (left.join(right.hint("merge"), ["place", "key"])
            .where((F.col("root") < F.col("root2")) & _chain_ok(cuts, max_distance))
            .select(F.col("root").alias("a"), F.col("root2").alias("b")).distinct())
    merged = components(rest).select(F.col("id").alias("root"), F.col("root").alias("top"))
    return known.join(merged, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))



def _grouped(docs: DataFrame, id_col: str, text_col: str, max_distance: int) -> DataFrame:
    """``id, text_hash, fp, root, component_id`` of every row; ``root`` names the component."""
    prints = checkpointed(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                                      F.arrow_udf(_fingerprints, LongType())(F.col(text_col)).alias("fp")))
    fps = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = link_fingerprints(fps.select("fp"), max_distance)
    named = fps.join(roots, "fp")
    tops = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(tops, "root").select("fp", "root", "component_id")
    return prints.join(of, "fp")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per row of ``docs``: the id, ``fp`` (long) and ``component_id``,
    the smallest id among the documents reachable by links.

    A null or empty text has fingerprint 0 and links like any other. A null id
    takes part but is never the smallest; a component of null ids only has a
    null component_id. Repeated rows each get their row. An empty table gives
    an empty result; further columns are ignored."""
    return _grouped(docs, id_col, text_col, max_distance).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, of
    several rows with it the one with the smallest hash of its text. In a
    component of null ids only, the hash alone decides. Columns and their order
    are those of ``docs``. An empty table gives an empty result."""
    chosen = (_grouped(docs, id_col, text_col, max_distance)
              .where(F.col("id").eqNullSafe(F.col("component_id")))
              .groupBy("root", "id").agg(F.min("text_hash").alias("__k_text"))
              .select(*row_key("id", "__k_text")[:2], "__k_text").distinct())
    keyed = docs.withColumns(dict(zip(KEY, row_key(id_col, text_col))))
    return keyed.join(chosen, KEY, "left_semi").dropDuplicates(KEY).drop(*KEY)


def op9_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                       "component_id")
