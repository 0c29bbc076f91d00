"""Benchmark decontamination by greedy string tiling.

Seeds, runs of ``least`` words that a document shares with a benchmark item, are found by one
hash lookup per word. For each document and item whose shared seeds could cover enough of the
item, running Karp-Rabin greedy tiling marks the longest common runs that don't overlap, again
and again; what the tiles cover of the item is its coverage, whatever their order in the document.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, chunks, ready, rolling

LEAST = 5
COVERAGE = 0.8
BLOCK_WORDS = 1_000_000
POSTINGS = 1 << 20  # seeds of items that a task holds at once beside a text's
#: Words are lower-cased runs of anything but white space and ASCII punctuation.
BLANK = bytes(32 if chr(i) in string.punctuation else i for i in range(128)) + bytes(range(128, 256))

_MATCHES = "doc_id long, item_id long, coverage double, covered_words long, item_words long, n_tiles long"


def _plain(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(BLANK)


def tiles(pattern: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in pattern, place in text, length), longest first.

    Negative values match nothing. Running Karp-Rabin looks for common runs of a length that
    starts at half the pattern and falls to ``least``; runs found are extended, and marked
    from the longest down unless a longer one has taken their words.
    """
    free_p, free_t = [x >= 0 for x in pattern], [x >= 0 for x in text]
    out: list[tuple[int, int, int]] = []
    size = max(least, len(pattern) // 2)
    base, prime = 1_000_003, (1 << 61) - 1

    def prints(values: list[int], free: list[bool]) -> Iterator[tuple[int, int]]:
        """(place, hash) of each unmarked run of ``size`` values."""
        drop, h, n = pow(base, size, prime), 0, 0
        for i, x in enumerate(values):
            if not free[i]:
                h = n = 0
                continue
            h, n = (h * base + x + 1) % prime, n + 1
            if n > size:
                h = (h - (values[i - size] + 1) * drop) % prime
            if n >= size:
                yield i - size + 1, h

    while True:
        spots: dict[int, list[int]] = {}
        for p, h in prints(pattern, free_p):
            spots.setdefault(h, []).append(p)
        found: list[tuple[int, int, int]] = []
        longest = 0
        for t, h in prints(text, free_t) if spots else ():
            for p in spots.get(h, ()):
                n = 0
                while p + n < len(pattern) and t + n < len(text) and free_p[p + n] and free_t[t + n] and pattern[p + n] == text[t + n]:
                    n += 1
                if n >= size:
                    found.append((-n, p, t))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        for n, p, t in sorted(found):
            n = -n
            if all(free_p[p : p + n]) and all(free_t[t : t + n]):
                free_p[p : p + n] = free_t[t : t + n] = [False] * n
                out.append((p, t, n))
        if found and any(all(free_p[p : p + size]) and all(free_t[t : t + size]) for _, p, t in found):
            continue  # a rest of a run that was partly taken is as long as this
        if size == least:
            return out
        size = max(least, size // 2)


def _slices(of: np.ndarray, many: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole texts with about ``POSTINGS`` postings; one text has at most an item block's."""
    total, i = np.cumsum(many), 0
    while i < len(of):
        j = int(np.searchsorted(total, total[i] - many[i] + POSTINGS, side="right"))
        j = max(int(np.searchsorted(of, of[min(j, len(of) - 1)])) if j < len(of) else j, int(np.searchsorted(of, of[i], side="right")))
        yield i, j
        i = j


class Items:
    """Benchmark items with their seeds by hash."""

    def __init__(self, rows: list[tuple[int | None, str | None]], least: int):
        self.ids = [r[0] for r in rows]
        self.words = [_plain(t).split() for _, t in rows]
        scanned = Words([_plain(t) for _, t in rows])
        values = scanned.hashes()
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if w:
                by.setdefault(min(least, len(w)), []).append(i)
        for size, items in by.items():  # an item of fewer words is one seed
            found = [rolling(values[scanned.first[i] : scanned.first[i + 1]], size) for i in items]
            key, item = np.concatenate(found), np.repeat(items, [len(f) for f in found])
            place = np.concatenate([np.arange(len(f)) for f in found])
            order = np.argsort(key, kind="stable")
            self.seeds[size] = key[order], item[order], place[order]

    def covered(self, words: Words, values: np.ndarray, coverage: float) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, covered words, tiles) of texts whose tiles may cover enough of an item.

        Tiles are made of shared seeds, so the item's words under seeds that the text has bound
        their cover; only where this reaches ``coverage`` is there any tiling. For the bound a
        seed counts once a text, however often the text repeats it.
        """
        lengths = np.asarray([len(w) for w in self.words])
        for size, (key, item, place) in self.seeds.items():
            run = rolling(values, size)
            text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[: len(run)]
            a = np.searchsorted(key, run)
            hit = np.flatnonzero((a < len(key)) & (key[np.minimum(a, len(key) - 1)] == run) & (np.arange(len(run)) + size <= words.first[text + 1]))
            owner, first = text[hit], a[hit]
            of, seed = np.divmod(np.unique(owner.astype(np.int64) * len(key) + first), len(key))
            many = np.searchsorted(key, key[seed], side="right") - seed
            for i, j in _slices(of, many):
                n = many[i:j]
                at, which = np.repeat(of[i:j], n), np.repeat(seed[i:j], n)
                posting = which + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                order = np.lexsort((place[posting], item[posting], at))
                at, which, posting = at[order], which[order], posting[order]
                last = np.r_[(at[1:] != at[:-1]) | (item[posting[1:]] != item[posting[:-1]]), True]
                words_under = np.where(last, size, np.minimum(size, np.diff(place[posting], append=0)))
                start = np.flatnonzero(np.r_[True, last[:-1]])
                bound = np.add.reduceat(words_under, start)
                end = np.r_[start[1:], len(at)]
                for k in np.flatnonzero(bound >= coverage * lengths[item[posting[start]]]):
                    t, it = int(at[start[k]]), int(item[posting[start[k]]])
                    lo, hi = np.searchsorted(owner, [t, t + 1])
                    covered, count = self._tile(words, hit[lo:hi][np.isin(first[lo:hi], which[start[k] : end[k]])], it, size)
                    if covered:
                        yield t, it, covered, count

    def _tile(self, words: Words, at: np.ndarray, item: int, size: int) -> tuple[int, int]:
        """Tiling within the runs of seeds: every common run of ``size`` words is made of them."""
        number: dict[bytes, int] = {}
        pattern = [number.setdefault(w, len(number)) for w in self.words[item]]
        part: list[int] = []
        cut = np.flatnonzero(np.diff(at) > size) + 1
        for a, b in zip(at[np.r_[0, cut]].tolist(), at[np.r_[cut, len(at)] - 1].tolist()):
            part += [number.get(words.buf[words.start[k] : words.end[k]], -1) for k in range(a, b + size)]
            part.append(-1)
        found = tiles(pattern, part, size)
        return sum(n for _, _, n in found), len(found)


def _matches(batches: Iterator[pa.RecordBatch], items: Items, coverage: float) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "text"):
        words = Words([_plain(t) for t in chunk.column("text").to_pylist()])
        ids = chunk.column("doc_id").to_pylist()
        rows = [
            (ids[d], items.ids[i], n / len(items.words[i]), n, len(items.words[i]), tiles)
            for d, i, n, tiles in items.covered(words, words.hashes(), coverage) if n >= coverage * len(items.words[i])
        ]
        if rows:
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in _MATCHES.split(", ")])


def _clean(batches: Iterator[pa.RecordBatch], items: Items, coverage: float) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "text"):
        words = Words([_plain(t) for t in chunk.column("text").to_pylist()])
        keep = np.ones(chunk.num_rows, dtype=bool)
        for d, i, n, _ in items.covered(words, words.hashes(), coverage):
            keep[d] &= n < coverage * len(items.words[i])
        yield chunk.filter(pa.array(keep))


def _blocks(benchmark: DataFrame, least: int, block_words: int) -> Iterator[Items]:
    """Items in blocks of about ``block_words`` words; a block is what a task holds of them."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")))).first()[0] or 0
    n = -(-size // block_words)
    for i in range(n):
        yield Items([tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()], least)


def find_leaks(documents: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, coverage, covered_words, item_words, n_tiles) of documents that hold an item.

    ``documents`` has doc_id and text, ``benchmark`` item_id and text; other columns are
    ignored. Tiles have ``least`` words or more; a row is returned where they cover a share of
    the item of at least ``coverage``. A benchmark of more than ``block_words`` words is taken
    in blocks, each in a pass of its own.

    - Null and empty texts match nothing, and neither do items without a word. An item of
      fewer than ``least`` words must occur whole.
    - A text of any length is matched whole, by one task.
    - A null doc_id or item_id is returned as such. Repeated documents each get their rows,
      repeated items count once. An empty table on either side gives an empty result.
    """
    ready(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in _blocks(benchmark, least, block_words):
        found = rows.mapInArrow(lambda it, items=items: _matches(it, items, coverage), _MATCHES)
        out = found if out is None else out.unionByName(found)
    return documents.sparkSession.createDataFrame([], _MATCHES) if out is None else out


def without_leaks(documents: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``documents``, all columns, that hold no benchmark item."""
    ready(documents.sparkSession)
    for items in _blocks(benchmark, least, block_words):
        documents = documents.mapInArrow(lambda it, items=items: _clean(it, items, coverage), documents.schema)
    return documents
