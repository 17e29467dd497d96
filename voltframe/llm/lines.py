"""Line dedup by distinct-site spread.

A line is boilerplate when it occurs on at least ``min_sites`` distinct sites.
Every line hash gets a HyperLogLog sketch of its sites; sketches merge map-side
and after the shuffle, so a line that holds a third of all rows costs one
sketch per task. The estimate alone decides far from the threshold; lines
whose estimate lies within ``ERRORS`` standard errors (one site at least) get
an exact distinct count. Boilerplate is then removed from every document but
its first occurrence (smallest id, then position), so the corpus keeps one
copy of each line and groups of copied documents keep one full member.

Every line that isn't blank is judged. Lines shorter than ``min_chars`` after
trimming recur by chance on many sites of a large corpus; they need
``SHORT_SHARE`` of all sites (``min_sites`` at least), also exactly near that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import KEY, checkpointed, row_key, table

MIN_SITES = 5
MIN_CHARS = 16
SHORT_SHARE = 0.5
LG_K = 12
ERRORS = 3
#: Parts that the rows of one line are dealt into where they are counted exactly.
SALTS = 64

LINE = ["h1", "h2"]


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int, min_chars: int) -> DataFrame:
    """One row per line that isn't blank: key of its document, position, 128-bit
    hash, site, and ``need``, the sites that make it boilerplate."""
    sites = docs.agg(F.count_distinct(F.col(site_col))).scalar()
    most = F.greatest(F.lit(min_sites), F.ceil(F.lit(SHORT_SHARE) * sites)).cast("long")
    size = F.length(F.trim("line"))
    return (docs.select(*row_key(id_col, text_col), F.col(site_col).alias("site"),
                        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
            .where(size > 0)
            .select(*KEY, "pos", "site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                    F.when(size >= min_chars, F.lit(min_sites).cast("long")).otherwise(most).alias("need")))


def spread_lines(lines: DataFrame) -> DataFrame:
    """Hashes of lines on at least ``need`` distinct sites, each with its first
    occurrence (``first``: document key and position)."""
    band = F.greatest(F.lit(1.0), ERRORS * 1.04 / 2 ** (LG_K / 2) * F.col("need"))
    seen = lines.groupBy(*LINE).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("site", LG_K).alias("sketch"),
                                    F.min(F.struct(*KEY, "pos")).alias("first"), F.min("need").alias("need"))
    # a line on s sites occurs at least s times
    seen = (seen.where(F.col("n") >= F.col("need"))
            .select(*LINE, "first", "need", F.hll_sketch_estimate("sketch").alias("sites"))
            .where(F.col("sites") >= F.col("need") - band))
    near = seen.where(F.col("sites") <= F.col("need") + band)
    # a line of a third of all rows meets its hash in SALTS parts, not in one task
    part = F.pmod(F.xxhash64(*KEY, "pos"), F.lit(SALTS)).cast("int")
    parts = near.select(*LINE, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    # no broadcast: Spark sizes all parts of a line as one row
    exact = (lines.select(*LINE, "site", part.alias("part")).join(parts.hint("merge"), [*LINE, "part"], "left_semi")
             .select(*LINE, "site").distinct().groupBy(*LINE).agg(F.count("site").alias("exact")))
    return (seen.join(exact, LINE, "left")
            .where(F.coalesce("exact", "sites") >= F.col("need")).select(*LINE, "first"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
               min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, and the counts
    ``n_lines`` and ``n_removed``; other columns as they are.

    A null text stays null and counts no lines; an empty one is a single empty
    line. A null site counts as no site. Null ids come after all others when
    the first occurrence is chosen. Rows that agree in id and text get the same
    result, so a first occurrence in a repeated row stays in each of them. An
    empty table gives an empty result."""
    lines = _lines(docs, id_col, text_col, site_col, min_sites, min_chars)
    # cut off before the join, so that its size is known and AQE can split a frequent line;
    # no broadcast: Spark sizes all lines of a document as one row
    drops = (lines.join(checkpointed(spread_lines(lines)).hint("merge"), LINE)
             .where(F.struct(*KEY, "pos") != F.col("first"))
             .groupBy(*KEY).agg(F.collect_set("pos").alias("__drop_lines")))
    key = row_key(id_col, text_col)
    split = F.split(F.col(text_col), "\n", -1)
    every = F.sequence(F.lit(0), F.size(split) - 1)
    kept = F.array_join(F.transform(F.array_except(every, "__drop_lines"), lambda i: F.get(split, i)), "\n")
    removed = F.coalesce(F.size("__drop_lines"), F.lit(0))
    return (docs.withColumns(dict(zip(KEY, key))).join(drops, KEY, "left")
            .withColumns({"n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)),
                          "n_removed": F.when(F.col("__drop_lines").isNull(), 0).otherwise(removed)})
            .withColumn(text_col, F.when(F.col("__drop_lines").isNull(), F.col(text_col)).otherwise(kept))
            .drop(*KEY, "__drop_lines"))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


OP5_SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
spread AS (
  SELECT line, min(struct_pack(d := doc_id, p := pos)) AS one
  FROM l, (SELECT count(DISTINCT source) AS sites FROM documents)
  WHERE trim(line, ' ') <> '' GROUP BY line, sites
  HAVING count(DISTINCT source) >= {MIN_SITES}
     AND (length(trim(line, ' ')) >= {MIN_CHARS} OR count(DISTINCT source) >= {SHORT_SHARE} * sites)),
marked AS (
  SELECT l.doc_id, l.pos, l.line,
         spread.line IS NOT NULL AND (l.doc_id, l.pos) <> (spread.one.d, spread.one.p) AS gone
  FROM l LEFT JOIN spread USING (line))
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
       CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed
FROM marked GROUP BY doc_id
"""
