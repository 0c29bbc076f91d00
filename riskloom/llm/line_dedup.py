"""Line dedup by distinct-site spread, in DataFrame functions only.

Each line gets a HyperLogLog sketch of the sites it occurs on; sketches merge in the
aggregation. A line whose estimate is near the threshold is counted exactly. Lines on enough
sites are boilerplate: their first occurrence stays, the others go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ready, settle, text_key

SITES = 10
BAND = 0.5  # estimates within this share of the threshold are counted exactly
SKETCH_BITS = 8  # relative error 1.04 / sqrt(256), about 6.5 %
SALTS = 16

_LINE = ["k1", "k2"]


def _lines(documents: DataFrame, site: str) -> DataFrame:
    """A row for each line that isn't blank, with 128 bits of hash."""
    return (
        documents.select("doc_id", text_key().alias("h"), F.col(site).cast("string").alias("site"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(F.trim("line") != "")
        .select("doc_id", "h", "site", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit("line"), "line").alias("k2"))
    )


def boilerplate(lines: DataFrame, sites: int = SITES, band: float = BAND) -> DataFrame:
    """(k1, k2, first) of lines on at least ``sites`` distinct sites; first is where each stays.

    Lines whose estimate is below ``sites * (1 - band)`` are not counted exactly, and those above
    ``sites * (1 + band)`` are taken as they are. The sketch's relative standard error is 6.5 % at
    most, so with the default band a wrong decision needs an error of over five of them.
    """
    spread = lines.groupBy(*_LINE).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("about"), F.min(F.struct("doc_id", "h", "pos")).alias("first")
    )
    spread = settle(spread.where(F.col("about") >= sites * (1 - band)), "line-spread")
    near = spread.where(F.col("about") <= sites * (1 + band))
    # a line meets at most one row for each of its sites
    exact = (
        lines.where("site is not null").select(*_LINE, "site").distinct().join(near.select(*_LINE), _LINE)
        .groupBy(*_LINE).agg(F.count("*").alias("n")).where(F.col("n") >= sites)
    )
    sure = spread.where(F.col("about") > sites * (1 + band))
    return sure.select(*_LINE, "first").unionByName(near.join(exact, _LINE, "left_semi").select(*_LINE, "first"))


def removed_lines(documents: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """(doc_id, h, gone): places, from 0, of the lines that go; ``h`` is ``text_key``."""
    ready(documents.sparkSession)
    lines = settle(_lines(documents, site), "lines")
    plates = boilerplate(lines, sites).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int"))
    there = dealt.join(plates, [*_LINE, "salt"]).where(~F.struct("doc_id", "h", "pos").eqNullSafe(F.col("first")))
    # distinct first: a document whose row is repeated many times lists each place once
    places = there.select("doc_id", "h", "pos").distinct()
    return places.groupBy("doc_id", "h").agg(F.collect_list("pos").alias("gone"))


def dedup_lines(documents: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``documents`` without cross-site boilerplate lines, and columns n_lines and n_removed.

    ``documents`` has doc_id, text and the site column; all columns are returned, columns
    named n_lines and n_removed are replaced. A line on at least ``sites`` distinct sites
    stays where it occurs first (smallest doc_id, then place) and is removed elsewhere.

    - A null text stays null, with no lines; an empty one has one blank line. Blank lines stay.
    - A text of any length is split whole, in one row; its lines travel one by one.
    - A null site is no site. A null doc_id comes before all others.
    - Rows repeated in full are one document, returned as often as they come. Rows of one
      doc_id with different texts are ordered by a hash of the text.
    - An empty table gives an empty result.
    """
    columns = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    # the caller's columns travel in one, so that none of their names matters here
    keyed = documents.select(F.struct(*columns).alias("doc"), F.col("doc_id").alias("id"), text_key().alias("key"), F.split("text", "\n").alias("lines"))
    joined = keyed.join(removed_lines(documents, site, sites).hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("h")), "left")
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.array_join(F.transform(F.array_except(places, F.col("gone")), lambda i: F.get(F.col("lines"), i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(kept)
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in columns],
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


#: ``dedup_lines`` over documents, as op7 returns it.
SQL = f"""
with lines as (
  select doc_id, source, pos, line from (
    select doc_id, source, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from documents
  ) where trim(line, ' ') <> ''
), plates as (
  select line, arg_min(doc_id, (doc_id, pos)) as first_doc, arg_min(pos, (doc_id, pos)) as first_pos
  from lines group by line having count(distinct source) >= {SITES}
), gone as (
  select doc_id, count(*) as n, list(pos) as places from lines join plates using (line) where not (doc_id = first_doc and pos = first_pos) group by doc_id
)
select d.doc_id,
  case when g.doc_id is null then d.text else array_to_string(
    [string_split(d.text, chr(10))[i + 1] for i in range(len(string_split(d.text, chr(10)))) if not list_contains(g.places, i)], chr(10)) end as text,
  coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(g.n, 0)::bigint as n_removed
from documents d left join gone g using (doc_id)
"""
