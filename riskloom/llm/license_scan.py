"""Licence scan: TF-IDF cosine of lines to templates, then inheritance from directories.

DataFrame functions only. Every line of every file is held against the templates; lines
without any of the terms that a match needs are skipped, which loses none. A file whose lines
are for the most part licence lines is a licence file of its directory, and files without a
licence line of their own take the one of the nearest directory above that has such a file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ready, settle, text_key

#: Usual notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
THRESHOLD = 0.7
#: Terms that help little to skip lines; they are looked for only where a template needs them.
COMMON = frozenset("a an and any are as by for in is of on or the this to under with work".split())
SALTS = 16
WORD = "[a-z0-9]+"


class Templates:
    """TF-IDF vectors of the templates; document frequencies are counted over the templates."""

    def __init__(self, texts: dict[str, str], threshold: float):
        self.names, self.threshold = sorted(texts), threshold
        counts = {n: Counter(re.findall(WORD, texts[n].lower())) for n in self.names}
        n = len(counts)
        df = Counter(t for c in counts.values() for t in c)
        self.idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in sorted(df)}
        self.other = math.log(1 + n) + 1  # of a term that no template has
        norm = {k: math.sqrt(sum((c * self.idf[t]) ** 2 for t, c in counts[k].items())) for k in self.names}
        self.weight = {t: [counts[k][t] * self.idf[t] ** 2 / norm[k] for k in self.names] for t in self.idf}
        needed: set[str] = set()
        for k in self.names:  # without these terms, what is left of a template is too short to reach the threshold
            left = norm[k] ** 2
            for t in sorted(counts[k], key=lambda t: (t in COMMON, t.isdigit(), -counts[k][t] * self.idf[t], t)):
                if left < (threshold * norm[k]) ** 2 * (1 - 1e-9):
                    break
                needed.add(t)
                left -= (counts[k][t] * self.idf[t]) ** 2
        # by Cauchy-Schwarz, a match shares terms of at least this part of the template's squared length
        self.shares: dict[str, tuple[list[str], int]] = {}
        for k in self.names:
            parts = sorted(((c * self.idf[t]) ** 2 for t, c in counts[k].items()), reverse=True)
            least = next(m for m in range(1, len(parts) + 1) if sum(parts[:m]) >= (threshold * norm[k]) ** 2 * (1 - 1e-9))
            self.shares[k] = sorted(counts[k]), least
        self.needed = f"(^|[^a-z0-9])({'|'.join(sorted(needed))})([^a-z0-9]|$)"

    def rows(self) -> str:
        """The terms as SQL rows (term, idf, w0, w1, ...)."""
        return ", ".join(f"('{t}', {self.idf[t]!r}e0, {', '.join(f'{w!r}e0' for w in self.weight[t])})" for t in self.idf)

    def columns(self) -> str:
        return "term, idf, " + ", ".join(f"w{i}" for i in range(len(self.names)))


def candidates(files: DataFrame, templates: Templates) -> DataFrame:
    """(path, h, dir, lines, found): files, and the terms of their lines that may match.

    One pass over the texts. lines counts those that aren't blank, in files with any term that
    a match needs; found keeps lines that share enough different terms with a template.
    """

    def terms(line: Column) -> Column:
        return F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0))

    def may_match(line: Column) -> Column:
        return reduce(or_, [F.size(F.array_intersect(line["terms"], F.lit(t))) >= least for t, least in templates.shares.values()])

    every = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("pos"), terms(line).alias("terms")))
    hit = F.lower("text").rlike(templates.needed)
    return files.select(
        "path", text_key().alias("h"), F.regexp_replace("path", "/?[^/]*$", "").alias("dir"),
        F.when(hit, F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))).alias("lines"),
        F.when(hit, F.filter(every, may_match)).alias("found"),
    )


def licence_lines(placed: DataFrame, templates: Templates) -> DataFrame:
    """(path, h, pos, score, nth): lines that match a template, and which of the names it is."""
    spark = placed.sparkSession
    some = placed.where(F.size("found") > 0).select("path", "h", F.explode("found").alias("line"))
    terms = some.select("path", "h", "line.pos", F.explode("line.terms").alias("term"))
    tf = terms.groupBy("path", "h", "pos", "term").agg(F.count("*").cast("double").alias("tf"))
    # a row for each term of the templates
    vocabulary = F.broadcast(spark.sql(f"select * from values {templates.rows()} as t({templates.columns()})"))
    weighed = tf.join(vocabulary, "term", "left")
    n = len(templates.names)
    dots = weighed.groupBy("path", "h", "pos").agg(
        F.sqrt(F.sum(F.pow(F.col("tf") * F.coalesce("idf", F.lit(templates.other)), F.lit(2)))).alias("norm"),
        *[F.sum(F.col("tf") * F.coalesce(f"w{i}", F.lit(0.0))).alias(f"d{i}") for i in range(n)],
    )
    best = F.array_max(F.array(*[F.struct(F.round(F.col(f"d{i}") / F.col("norm"), 6).alias("score"), F.lit(-i).alias("turn")) for i in range(n)]))
    return dots.select("path", "h", "pos", best.alias("best")).where(F.col("best.score") >= templates.threshold).select(
        "path", "h", "pos", "best.score", (-F.col("best.turn")).alias("nth")
    )


def _own(placed: DataFrame, templates: Templates) -> DataFrame:
    """(path, h, score, nth, n): the best licence line of each file, and how many it has."""
    best = F.max(F.struct("score", (-F.col("nth")).alias("turn"), (-F.col("pos")).alias("place")))
    found = licence_lines(placed, templates).groupBy("path", "h").agg(best.alias("b"), F.count("*").alias("n"))
    return found.select("path", "h", F.col("b.score").alias("score"), (-F.col("b.turn")).alias("nth"), "n")


def scan_licences(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The licence of each file: path, licence, score, origin and licence_path.

    ``files`` has path (parts joined by ``/``) and text; other columns are ignored. origin is
    ``own`` where a line of the file has a cosine of ``threshold`` or more with a template
    (the best line counts, ties to the first template by name); ``inherited`` where the
    nearest directory from the file's own upward has a licence file (of several the best
    score, then the smallest path); else ``none``, with null licence, score and licence_path.
    A licence file has matches in half or more of its lines that aren't blank.

    - Null and empty texts have no licence of their own, but inherit.
    - A text of any length is split whole, in one row; its lines are scored one by one.
    - A null path has no directory: such a file neither inherits nor hands down.
    - Repeated rows are each returned. Files of one path with different texts are told apart.
    - An empty table gives an empty result.
    """
    ready(files.sparkSession)
    known = Templates(templates or TEMPLATES, threshold)
    names = F.array(*[F.lit(n) for n in known.names])
    files = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    placed = settle(candidates(files, known), "licence-files")
    own = settle(_own(placed, known), "licences")
    placed = placed.drop("found")
    named = placed.where("lines is not null and path is not null").join(own.hint("shuffle_hash"), ["path", "h"]).where(F.col("n") * 2 >= F.col("lines"))
    holders = named.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("minus"), "path", "nth")).alias("holder"))
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    above = placed.where("path is not null").select("dir").distinct().select(
        F.col("dir").alias("below"), F.explode(F.sequence(F.lit(0), depth)).alias("depth"), parts.alias("parts")
    ).select("below", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("dir"))
    nearest = above.join(holders, "dir").groupBy("below").agg(F.max(F.struct("depth", "holder")).alias("near")).select(
        F.col("below").alias("dir"), "near.holder", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    with_own = placed.join(own.select(F.col("path").alias("p"), F.col("h").alias("k"), "score", "nth"), F.col("path").eqNullSafe(F.col("p")) & (F.col("h") == F.col("k")), "left")
    dealt = with_own.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(nearest, ["dir", "salt"], "left")
    mine, held = F.col("nth").isNotNull(), F.col("holder").isNotNull()
    return joined.select(
        "path",
        F.when(mine, F.get(names, F.col("nth"))).when(held, F.get(names, F.col("holder.nth"))).alias("licence"),
        F.when(mine, F.col("score")).when(held, -F.col("holder.minus")).alias("score"),
        F.when(mine, "own").when(held, "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("path")).when(held, F.col("holder.path")).alias("licence_path"),
    )


#: A tree over documents: by source, then language, then thousands, three depths in turn.
_PATH = "concat(coalesce(source, 'unknown'), case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then concat('/', coalesce(lang, 'xx')) else concat('/', coalesce(lang, 'xx'), '/', cast(floor(doc_id / 1000) as bigint)) end, '/', cast(doc_id as {string}))"


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files (path, text) of a directory tree; without doc_id the path is null."""
    return documents.select(F.expr(_PATH.format(string="string")).alias("path"), "text")


def sql() -> str:
    """``scan_licences`` over ``document_files``, as op3 returns it."""
    t = Templates(TEMPLATES, THRESHOLD)
    n = len(t.names)
    names = ", ".join(f"'{x}'" for x in t.names)
    scores = ", ".join(f"{{'score': round(sum(tf * coalesce(w{i}, 0)) / sqrt(sum((tf * coalesce(idf, {t.other!r})) ** 2)), 6), 'turn': {-i}}}" for i in range(n))
    return f"""
with terms({t.columns()}) as (values {t.rows()}),
files as (select doc_id, {_PATH.format(string='varchar')} as path, text from documents),
lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from files
), tf as (
  select doc_id, pos, term, count(*)::double as tf from (select doc_id, pos, unnest(regexp_extract_all(lower(line), '{WORD}')) as term from lines) group by all
), best as (
  select doc_id, pos, list_max([{scores}]) as best from tf left join terms using (term) group by doc_id, pos
), matched as (
  select doc_id, pos, best.score as score, -best.turn as nth from best where best.score >= {THRESHOLD}
), own as (
  select doc_id, max({{'score': score, 'turn': -nth, 'place': -pos}}) as b, count(*) as n from matched group by doc_id
), placed as (
  select f.doc_id, f.path, regexp_replace(f.path, '/?[^/]*$', '') as dir, b.score as score, -b.turn as nth, n,
    len([x for x in string_split(text, chr(10)) if trim(x, ' ') <> '']) as lines
  from files f left join own using (doc_id)
), holders as (
  select dir, min({{'minus': -score, 'path': path, 'nth': nth}}) as holder from placed where n * 2 >= lines group by dir
), above as (
  select below, depth, array_to_string(string_split(below, '/')[1:depth], '/') as dir
  from (select below, unnest(range(case when below = '' then 1 else len(string_split(below, '/')) + 1 end)) as depth from (select distinct dir as below from placed where path is not null))
), nearest as (
  select below as dir, arg_max(holder, depth) as holder from above join holders using (dir) group by below
)
select doc_id, path, [{names}][coalesce(nth, holder.nth) + 1] as licence, coalesce(score, -holder.minus) as score,
  case when nth is not null then 'own' when holder is not null then 'inherited' else 'none' end as origin,
  case when nth is not null then path else holder.path end as licence_path
from placed left join nearest using (dir)
"""
