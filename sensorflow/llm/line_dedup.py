"""Boilerplate lines by the number of distinct sites they spread over; DataFrame functions only.

1. Each line is two 64-bit hashes; a HyperLogLog sketch of its sites per line, partial
   sketches merged by aggregation, so a very common line never meets in one task.
2. Lines whose estimate is near the threshold get an exact distinct count; the others are
   decided by the estimate (for so few sites the sketch holds them one by one).
3. Each document drops its lines that spread over ``min_sites`` sites or more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.session import staged

MIN_SITES = 10
LG_SKETCH = 12
#: estimates within this share of the threshold, and one site beyond, are counted exactly
NEAR = 0.2

SPACE = " \t\n\r\f\x0b"
LINE = ["_h1", "_h2"]
ROW = ["_r1", "_r2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line).alias("_h2")]


def _row_hashes(docs: DataFrame) -> list[Column]:
    """Two hashes of id and text: rows that share them have the same lines."""
    both = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return [F.xxhash64(*both).alias("_r1"), F.xxhash64(F.lit(1), *both).alias("_r2")]


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """``_h1, _h2`` of every line (trimmed, with a word) that occurs at ``min_sites`` distinct sites or more."""
    seen = (docs.select(F.col(site).cast("string").alias("_site"), F.explode(_lines(F.col("text"))).alias("_line"))
            .select("_site", F.btrim("_line", F.lit(SPACE)).alias("_line"))
            .where("_line != '' and _site is not null").select("_site", *_hashes(F.col("_line"))))
    low, high = min_sites * (1 - NEAR) - 1, min_sites * (1 + NEAR) + 1
    wide = staged(seen.groupBy(*LINE).agg(F.hll_sketch_agg("_site", LG_SKETCH).alias("_sketch"))
                  .select(*LINE, F.hll_sketch_estimate("_sketch").alias("_sites")).where(F.col("_sites") >= low), "spread")
    near = wide.where(F.col("_sites") <= high).select(*LINE)
    exact = (seen.join(near, LINE, "left_semi").groupBy(*LINE).agg(F.count_distinct("_site").alias("_sites"))
             .where(F.col("_sites") >= min_sites))
    return wide.where(F.col("_sites") > high).select(*LINE).unionAll(exact.select(*LINE))


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` per row of ``docs``: the text without boilerplate lines.

    Lines are the parts between ``\\n``; they are compared without white space at their
    ends, and ``n_lines`` counts those with a word.  Blank lines stay.  A null text is empty:
    no lines, ``text`` empty.  Rows with a null site keep the rules of others but add no site
    to their lines.  Null and repeated ids give one row per input row.  An empty table gives
    no rows.
    """
    common = staged(boilerplate_lines(docs, min_sites, site), "boilerplate")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("_text"),
                       *_row_hashes(docs))
    placed = (rows.select(*ROW, F.posexplode(_lines(F.col("_text"))).alias("_at", "_line"))
              .select(*ROW, "_at", F.btrim("_line", F.lit(SPACE)).alias("_line")).where("_line != ''")
              .select(*ROW, "_at", *_hashes(F.col("_line"))))
    gone = staged(placed.join(common, LINE, "left_semi").groupBy(*ROW).agg(F.collect_set("_at").alias("_gone")), "gone")
    lines, all_at = F.col("_lines"), F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(all_at, F.col("_gone")), lambda i: F.get(lines, i))
    text = F.when(F.col("_gone").isNull(), F.coalesce("_text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    worded = F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    return rows.join(gone, ROW, "left").withColumn("_lines", _lines(F.col("_text"))).select(
        "doc_id", worded.cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        text.alias("text"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
b AS (SELECT bare FROM t WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
j AS (SELECT t.*, t.bare IN (SELECT bare FROM b) AS gone FROM t)
SELECT doc_id, count(*) FILTER (WHERE bare <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
