"""Substring dedup by super-k-mers: repeated 20-word windows, found exactly at any size.

Consecutive windows that share a minimiser travel as one packed string to the minimiser's
bucket; there every window is sorted by a hash, equal hashes are compared byte by byte, and
each window is told from its first occurrence.

Three passes over the texts, a shuffle of packed strings and one of whole texts:

1. Count word triples by slot, and words, over the whole corpus. Triples in frequent slots
   rank last as minimisers, so a line found in a third of all documents doesn't gather its
   windows. A window of nothing but such triples goes to a bucket by its own hash.
2. Cut each text into super-k-mers. Equal ones inside a chunk of 8 MB are decided there: all
   but the first are repeats throughout, so a mass of copies sends one string per chunk.
3. Buckets, whose number follows from the counted words, compare windows and return word
   ranges; ranges meet their documents by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, chunks, mix, pieces, ready, rolling, runs, settle, sliding_min, text_key

WINDOW = 20
SEED_WORDS = 3
LONGEST_RUN = 256  # windows in one super-k-mer at most
BUCKETS_PER_PIECE = 8  # at least
BUCKET_WORDS = 1 << 21  # words of the corpus per bucket at most, on average
CHUNK_BYTES = 8 << 20  # larger blocks of strings pack better

_PACKED = "bucket long, strings binary, places binary"
_RANGES = "doc_id long, h long, a long, b long"


def _triples(hashes: np.ndarray, size: int) -> np.ndarray:
    return rolling(hashes, size, base=0x9E3779B97F4A7C15 | 1)


def _slot_counts(batches: Iterator[pa.RecordBatch], size: int, slots: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(slots, dtype=np.int64)
    for chunk in chunks(batches, "text"):
        words = Words(chunk.column("text").to_pylist())
        grams = _triples(words.hashes(), size)
        # a triple across two texts counts too: it only shifts a slot's rank a little
        total += np.bincount((grams % np.uint64(slots)).astype(np.int64), minlength=slots)
    there = np.flatnonzero(total)
    if len(there):
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["slot", "n"])


def _pack(strings: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(strings))


def _super_kmers(
    batches: Iterator[pa.RecordBatch], window: int, size: int, hot: np.ndarray, buckets: int
) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for chunk in chunks(batches, "text", CHUNK_BYTES):
        chunk = chunk.sort_by([("doc_id", "ascending"), ("h", "ascending")])
        ids, keys = (np.asarray(chunk.column(c), dtype=np.int64) for c in ("doc_id", "h"))
        words = Words(chunk.column("text").to_pylist())
        if words.n < window:
            continue
        hashes = words.hashes()
        grams = _triples(hashes, size)
        rank = grams >> np.uint64(1)
        rank[hot[(grams % np.uint64(len(hot))).astype(np.int64)]] |= np.uint64(1 << 63)
        least = sliding_min(rank, window - size + 1)
        text = np.repeat(np.arange(len(ids)), np.diff(words.first))[: len(least)]
        fits = np.flatnonzero(np.arange(len(least)) + window <= words.first[text + 1])
        if not len(fits):
            continue
        least, text = least[fits], text[fits]
        block = (fits - words.first[text]) // LONGEST_RUN
        common = np.flatnonzero(least >> np.uint64(63))
        if len(common):  # no rare triple: each such window goes alone, by its own hash
            least[common] = rolling(hashes, window)[fits[common]]
            block[common] = -1 - common
        a, b = runs(least, text, block)
        first, last, text = fits[a], fits[b - 1] + window, text[a]
        start = first - words.first[text]
        bucket = (mix(least[a]) % np.uint64(buckets)).astype(np.int64)
        buf = words.buf
        strings = [buf[i:j] for i, j in zip(words.start[first].tolist(), words.end[last - 1].tolist())]
        seen: dict[bytes, int] = {}
        known = seen.setdefault
        origin = np.fromiter((known(s, i) for i, s in enumerate(strings)), dtype=np.int64, count=len(strings))
        del seen
        place = np.stack([ids[text], keys[text], start, start + (last - first)], axis=1)
        mine = origin == np.arange(len(strings))
        repeat = ~mine & (place[origin, :3] != place[:, :3]).any(axis=1)
        rows: list[tuple[int, bytes | None, bytes]] = []
        if repeat.any():
            done = _merged(place[repeat])
            rows.append((int(mix(np.asarray([done[0, 0]]).view(np.uint64))[0] >> np.uint64(1)), None, compress(done.tobytes())))
        sent = np.flatnonzero(mine)
        sent = sent[np.argsort(bucket[sent], kind="stable")]
        for i, j in zip(*runs(bucket[sent])):
            part = sent[i:j]
            rows.append((int(bucket[part[0]]), _pack([strings[k] for k in part.tolist()]), compress(place[part, :3].tobytes())))
        for i in range(0, len(rows), 512):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows[i : i + 512]), (pa.int64(), pa.binary(), pa.binary()))],
                ["bucket", "strings", "places"],
            )


def _merged(place: np.ndarray) -> np.ndarray:
    """Joins touching or overlapping ranges (doc, key, from, to) of one text."""
    place = place[np.lexsort((place[:, 2], place[:, 1], place[:, 0]))]
    new = np.r_[True, (place[1:, :2] != place[:-1, :2]).any(axis=1)]
    group = np.cumsum(new) - 1
    wide = np.int64(1) << np.int64(40)
    reach = np.maximum.accumulate(place[:, 3] + group * wide) - group * wide
    new[1:] |= place[1:, 2] > reach[:-1]
    at = np.flatnonzero(new)
    out = place[at].copy()
    out[:, 3] = reach[np.r_[at[1:], len(place)] - 1]
    return out


def _later_windows(strings: list[bytes], places: np.ndarray, window: int) -> np.ndarray:
    """Ranges of words under windows that have an earlier equal, within one bucket."""
    order = np.lexsort((places[:, 2], places[:, 1], places[:, 0]))
    places, strings = places[order], [strings[i] for i in order.tolist()]
    words = Words(strings)
    kmer = np.repeat(np.arange(len(strings)), np.diff(words.first))
    value = rolling(words.hashes(), window)
    kmer = kmer[: len(value)]
    at = np.flatnonzero(np.arange(len(value)) + window <= words.first[kmer + 1])
    value, kmer = value[at], kmer[at]
    by = np.argsort(value, kind="stable")
    same = np.r_[False, value[by[1:]] == value[by[:-1]]]
    head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
    found, first = by[same], head[same]
    buf, s, e = words.buf, words.start, words.end
    i, j = at[found], at[first]
    equal = np.fromiter(
        (buf[a:b] == buf[c:d] for a, b, c, d in zip(s[i].tolist(), e[i + window - 1].tolist(), s[j].tolist(), e[j + window - 1].tolist())),
        dtype=bool, count=len(found),
    )
    if not equal.all():  # two windows share a hash: compare whole windows instead
        seen: dict[bytes, int] = {}
        origin = np.fromiter(
            (seen.setdefault(buf[a:b], k) for k, (a, b) in enumerate(zip(s[at].tolist(), e[at + window - 1].tolist()))),
            dtype=np.int64, count=len(at),
        )
        found = np.flatnonzero(origin != np.arange(len(at)))
        first = origin[found]
    spot = np.stack([places[kmer, 0], places[kmer, 1], places[kmer, 2] + at - words.first[kmer]], axis=1)
    later = found[(spot[found] != spot[first]).any(axis=1)]
    if not len(later):
        return np.zeros((0, 4), dtype=np.int64)
    return _merged(np.c_[spot[later], spot[later, 2] + window])


def _buckets(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; one bucket is held at a time."""
    expand = zstandard.ZstdDecompressor().decompress

    def out(ranges: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in ranges.T], ["doc_id", "h", "a", "b"])

    held, strings, places = None, [], []
    for batch in batches:
        for bucket, packed, where in zip(*(batch.column(c).to_pylist() for c in ("bucket", "strings", "places"))):
            if packed is None:
                yield out(np.frombuffer(expand(where), dtype=np.int64).reshape(-1, 4))
                continue
            if bucket != held and strings:
                yield out(_later_windows(strings, np.concatenate(places), window))
                strings, places = [], []
            held = bucket
            strings += expand(packed).split(b"\n")
            places.append(np.frombuffer(expand(where), dtype=np.int64).reshape(-1, 3))
    if strings:
        yield out(_later_windows(strings, np.concatenate(places), window))


def _kept(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "text"):
        words = Words(chunk.column("text").to_pylist())
        marks = np.zeros(words.n + 1, dtype=np.int64)
        ranges = chunk.column("ranges")
        sizes = np.asarray(pa.compute.list_value_length(ranges).fill_null(0), dtype=np.int64)
        if sizes.any():
            flat = ranges.flatten()
            base = np.repeat(words.first[:-1], sizes)
            np.add.at(marks, base + np.asarray(flat.field("a"), dtype=np.int64), 1)
            np.add.at(marks, base + np.asarray(flat.field("b"), dtype=np.int64), -1)
        gone = np.cumsum(marks[:-1]) > 0
        removed = np.r_[0, np.cumsum(gone)]
        removed = removed[words.first[1:]] - removed[words.first[:-1]]
        buf, texts = words.buf, []
        for d, (i, j) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            if not removed[d]:
                texts.append(buf[words.start[i] : words.end[j - 1]] if j > i else b"")
                continue
            a, b = runs(gone[i:j])
            texts.append(b" ".join(buf[words.start[i + x] : words.end[i + y - 1]] for x, y in zip(a.tolist(), b.tolist()) if not gone[i + x]))
        columns = {
            "doc_id": chunk.column("doc_id"),
            "n_words": pa.array(np.diff(words.first)),
            "n_removed": pa.array(removed),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
        }
        if with_text:
            columns["kept_text"] = pa.array([t.decode("utf-8", "replace") for t in texts])
        yield pa.RecordBatch.from_pydict(columns)


def repeated_ranges(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, h, a, b): word ranges of each text that lie under repeated windows.

    ``h`` is ``text_key`` of the text. Ranges may touch or overlap between rows.
    """
    spark = ready(documents.sparkSession)
    size = min(SEED_WORDS, window)
    parts = pieces(spark)
    buckets = BUCKETS_PER_PIECE * parts
    slots = 1 << max(16, (16 * buckets - 1).bit_length())  # follows the pieces of a shuffle alone
    texts = documents.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"), F.col("text").cast("binary").alias("text")
    )
    counts = settle(
        texts.select("text").mapInArrow(lambda it: _slot_counts(it, size, slots), "slot long, n long")
        .groupBy("slot").agg(F.sum("n").alias("n")), "triples",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    # at most 4 * buckets slots can hold that share of all triples
    often = counts.where(F.col("n") * F.lit(4 * buckets) > F.lit(total)).select("slot").toArrow()
    hot = np.zeros(slots, dtype=bool)
    hot[np.asarray(often["slot"], dtype=np.int64)] = True
    buckets = max(buckets, -(-total // BUCKET_WORDS))
    packed = texts.mapInArrow(lambda it: _super_kmers(it, window, size, hot, buckets), _PACKED)
    return (
        # by number, not by hash: each task gets as many buckets as any other
        packed.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")
        .mapInArrow(lambda it: _buckets(it, window), _RANGES)
    )


def dedup_substrings(documents: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Removes every word under a window of ``window`` words that also starts earlier.

    Earlier means in a text of smaller doc_id, or before in the same text. Windows are
    judged on the input. Returns, for each row of ``documents`` (columns doc_id, text; any
    others are ignored): doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text
    (kept words joined by one space).

    - A null text has no words; texts shorter than the window lose none.
    - A text of any length is read whole, by one task; one of over 8 MB is cut up by itself.
    - A row without doc_id has no place in the order: it is returned whole and takes no part.
    - Rows repeated in full are one document, returned as often as they come. Rows of one
      doc_id with different texts are ordered by a hash of the text.
    - An empty table gives an empty result.
    """
    ranges = repeated_ranges(documents, window)
    by_text = ranges.groupBy("doc_id", "h").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"), F.col("text").cast("binary").alias("text")
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return (
        texts.join(by_text.hint("shuffle_hash"), ["doc_id", "h"], "left").select("doc_id", "text", "ranges")
        .mapInArrow(lambda it: _kept(it, with_text), schema)
    )
