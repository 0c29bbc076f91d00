"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into (bits + 1) / 2 segments, so of two fingerprints at most ``bits``
apart one segment differs in one bit at most. Each segment is indexed once for each of its
bits with that bit deleted; fingerprints that share a variant meet by an equality join and are
compared in full. Groups return a spanning star and not their pairs; in a large group the same
cut is made again in the bits that are still free, so the work per fingerprint is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, chunks, pieces, ready, runs, settle, text_key
from riskloom.llm.components import local_components, stars

SHINGLE = 3
BITS = 3
HOT = 4_096  # a fingerprint of more than one row in so many is hot
SALTS = 64  # tasks that share the rows of a hot one
SEED = 42
SMALL_GROUP = 1024
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_PRINTS = "doc_id long, h long, fp long"


def _lanes() -> np.ndarray:
    """For each byte, its eight bits in eight byte-wide lanes."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


def fingerprint_texts(texts: list[bytes | None], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    words = Words([(t or b"").translate(LOWER) for t in texts])
    n = np.diff(words.first)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    first = words.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    last = first + np.minimum(shingle, n[text]) - 1
    buf, digest = words.buf, xxhash.xxh64_intdigest
    spans = zip(words.start[first].tolist(), words.end[last].tolist())
    hashes = np.fromiter((digest(buf[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(text))
    ones = np.zeros((len(n), 64), dtype=np.int64)
    if len(hashes):
        # up to 255 shingles are added in byte-wide lanes at once
        within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        cuts, _ = runs(text, within // 255)
        octets, lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8), _lanes()
        for c in range(8):
            added = np.add.reduceat(lanes[octets[:, c]], cuts)
            np.add.at(ones[:, 8 * c : 8 * c + 8], text[cuts], added.view(np.uint8).reshape(-1, 8))
    majority = (2 * ones > count[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel().view(np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "text"):
        fp = fingerprint_texts(chunk.column("text").to_pylist(), shingle)
        yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("h"), pa.array(fp)], ["doc_id", "h", "fp"])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(lambda it: _fingerprints(it, shingle), _PRINTS)


def segments(width: int, bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments of which one differs in one bit at most."""
    n = (bits + 2) // 2
    at = [width * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def variants(fp: np.ndarray, low: int, width: int, bits: int) -> Iterator[tuple[int, np.ndarray, tuple[int, int]]]:
    """(number, segment without one bit, its place) for each one-bit variant of each segment."""
    number = 0
    for first, size in segments(width, bits):
        part = (fp >> np.uint64(low + first)) & np.uint64((1 << size) - 1)
        for i in range(size):
            yield number, part & ~np.uint64(1 << i), (low + first, size)
            number += 1


def _index(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.asarray(batch.column("fp"), dtype=np.int64).view(np.uint64)
        for number, value, _ in variants(fp, 0, 64, bits):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(fp), number, dtype=np.int32)), pa.array(value.view(np.int64)), batch.column("fp")], ["variant", "value", "fp"]
            )


def link_group(fp: np.ndarray, bits: int, low: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (index, index of the star's centre) over distinct fingerprints.

    Only bits low to low + width may still differ at will. Small groups are compared in
    full; larger ones are cut again in those bits.
    """
    if len(fp) <= SMALL_GROUP or width < 2 * ((bits + 2) // 2):
        a, b = [], []
        for i in range(0, len(fp), SMALL_GROUP):
            x, y = np.nonzero(np.bitwise_count(fp[i : i + SMALL_GROUP, None] ^ fp[None, :]) <= bits)
            later = y > x + i
            a.append(x[later] + i)
            b.append(y[later])
            if len(a) > 16:  # keep only what spans them
                a, b = ([c] for c in _star(len(fp), np.concatenate(a), np.concatenate(b)))
        return _star(len(fp), np.concatenate(a), np.concatenate(b))
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for _, value, (first, size) in variants(fp, low, width, bits):
        order = np.argsort(value, kind="stable")
        for i, j in zip(*runs(value[order])):
            if j - i > 1:
                part = order[i:j]
                rest = [(low, first - low), (first + size, low + width - first - size)]
                at, wide = max(rest, key=lambda r: r[1]) if (bits + 2) // 2 == 2 else (low, 0)
                x, y = link_group(fp[part], bits, at, wide)
                a.append(part[x])
                b.append(part[y])
        a, b = ([c] for c in _star(len(fp), np.concatenate(a), np.concatenate(b)))
    return a[0], b[0]


def _star(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = local_components(n, a, b)
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def _links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by variant and value; one group is held at a time."""
    places = [place for _, _, place in variants(np.zeros(1, dtype=np.uint64), 0, 64, bits)]
    names = ("variant", "value", "fp")

    def group(variant: int, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, size = places[variant]
        low, wide = max([(0, first), (first + size, 64 - first - size)], key=lambda r: r[1]) if len(segments(64, bits)) == 2 else (0, 0)
        a, b = link_group(fp.view(np.uint64), bits, low, wide)
        return fp[a], fp[b]

    def solve(variant: np.ndarray, value: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        i, j = runs(variant, value)
        two = i[j - i == 2]  # most groups are chance pairs
        near = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= bits]
        u, v = [fp[near]], [fp[near + 1]]
        for a, b in zip(i[j - i > 2].tolist(), j[j - i > 2].tolist()):
            x, y = group(int(variant[a]), fp[a:b])
            u.append(x)
            v.append(y)
        u, v = np.concatenate(u), np.concatenate(v)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [np.asarray(batch.column(c)) for c in names]
        # all but the last group is whole
        i, _ = runs(new[0], new[1])
        at = int(i[-1])
        if held and at == 0 and held[-1][0][-1] == new[0][0] and held[-1][1][-1] == new[1][0]:
            held.append(new)
            continue
        yield from solve(*(np.concatenate(c) for c in zip(*held, [x[:at] for x in new])))
        held = [[x[at:] for x in new]]
    if held:
        yield from solve(*(np.concatenate(c) for c in zip(*held)))


def near_links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v): edges that span every component of distinct fingerprints at most ``bits`` apart.

    ``prints`` has a column fp of distinct 64-bit values.
    """
    n = pieces(prints.sparkSession)
    index = prints.select("fp").mapInArrow(lambda it: _index(it, bits), "variant int, value long, fp long")
    met = index.repartition(n, "variant", "value").sortWithinPartitions("variant", "value")
    return met.mapInArrow(lambda it: _links(it, bits), "u long, v long")


def components(documents: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, h, fp, component_id, root) for each row; see ``near_duplicates``.

    ``h`` is ``text_key``; root is the same for rows of one component and no others.
    """
    ready(documents.sparkSession)
    prints = settle(fingerprints(documents, shingle), "fingerprints")
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct-fingerprints")
    star = stars(near_links(distinct, bits))
    members = star.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(star.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())
    least = members.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("component"))
    named = members.join(least, "root").select("fp", "root", "component")
    alone = F.col("root").isNull()
    label = distinct.join(named, "fp", "left").select(
        "fp", "n", F.when(alone, F.col("least")).otherwise(F.col("component")).alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return _labelled(prints, label).select("doc_id", "h", "fp", "component_id", "root")


def _labelled(prints: DataFrame, label: DataFrame) -> DataFrame:
    """Rows with what ``label`` says of their fingerprint; those of a hot one go to ``SALTS`` tasks.

    Hot is a fingerprint with more than one row in ``HOT``, so there are fewer than that.
    """
    hot = F.col("n") * F.lit(HOT) > F.lit(prints.count())
    spread = label.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(hot, SALTS - 1).otherwise(0))))
    some = F.broadcast(label.where(hot).select("fp", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS)).cast("int")).otherwise(0)
    return prints.join(some, "fp", "left").withColumn("salt", salt).join(spread, ["fp", "salt"])


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Fingerprint and component of each row: doc_id, fingerprint, component_id.

    ``documents`` has doc_id and text; other columns are ignored. Texts are lower-cased in
    A-Z; shingles are ``shingle`` words, repeats included; a shorter text is one shingle. A
    fingerprint bit is set if more than half the shingle hashes have it. Fingerprints at most
    ``bits`` apart are linked; component_id is the smallest doc_id reachable.

    - Null, empty and white texts have fingerprint zero and are linked like any other.
    - All shingles of a text of any length count; one task reads it.
    - A row without doc_id links others and gets a component, but never names it; component_id
      is null where no row of a component has a doc_id.
    - Repeated rows and rows of one doc_id with different texts each get their own row.
    - An empty table gives an empty result.
    """
    rows = components(documents, shingle, bits)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of ``documents``, all columns, for each component: that of the smallest doc_id.

    Rows without doc_id come last; rows of one doc_id are ordered by a hash of the text. Of
    rows that agree in both, one stays.
    """
    rows = settle(components(documents, shingle, bits).select("doc_id", "h", "root"), "components")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("best_id"), F.col("h").alias("best_h")))
    chosen = rows.groupBy("root").agg(best.alias("best")).select("best.best_id", "best.best_h")
    # the caller's columns travel in one, so that none of their names matters here
    keyed = documents.select(F.struct(*documents.columns).alias("doc"), F.col("doc_id").alias("id"), text_key().alias("key"))
    kept = keyed.join(chosen, F.col("id").eqNullSafe(F.col("best_id")) & (F.col("key") == F.col("best_h")), "left_semi")
    if not rows.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["id", "key"])
    return kept.select("doc.*")
