"""Packing token pieces into sequences: shortest pack first over the length histogram.

Texts are encoded once; each piece's length, place and checksum are settled. The histogram of
lengths, at most one row for each length, is packed on the driver; the patterns then meet the
pieces again by length and rank.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import chunks, per_worker, ready, settle
from riskloom.llm.token_output import with_end
from riskloom.llm.tokens import Encoder

CAPACITY = 4096

_PIECES = "task int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder = per_worker("encoder:" + tokenizer, lambda: Encoder(tokenizer))
    task = TaskContext.get().partitionId()
    for chunk in chunks(batches, "text"):
        ids, counts = with_end(*encoder.encode(chunk.column("text").to_pylist()), end_id)
        data = memoryview(ids.tobytes())
        cut = -(-counts // capacity)
        doc = np.repeat(np.arange(len(counts)), cut)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(cut) - cut, cut)) * capacity
        length = np.minimum(capacity, counts[doc] - start)
        a = (np.cumsum(counts) - counts)[doc] + start
        crc = [zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(a.tolist(), (a + length).tolist())]
        yield pa.RecordBatch.from_pydict({
            "task": pa.array(np.full(len(doc), task, dtype=np.int32)), "doc_id": chunk.column("doc_id").take(pa.array(doc)),
            "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(counts[doc]),
        })


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Packing patterns (count, lengths): longest lengths first, each into the shortest pack.

    Packs that look alike are one pattern with a count, so the work follows the number of
    lengths and not of pieces. Where no open pack has room, new ones take the length as often
    as it fits.
    """
    packs: list[tuple[int, int, int, list[int]]] = []  # (-room, number, count, lengths): a heap
    done: list[tuple[int, list[int]]] = []
    number = 0

    def put(room: int, count: int, lengths: list[int]) -> None:
        nonlocal number
        number += 1
        if room:
            heapq.heappush(packs, (-room, number, count, lengths))
        else:
            done.append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if packs and -packs[0][0] >= length:
                room, _, count, lengths = heapq.heappop(packs)
                used = min(count, left)
                if used < count:
                    put(-room, count - used, lengths)
                put(-room - length, used, [*lengths, length])
                left -= used
                continue
            fits = capacity // length
            if left >= fits:
                put(capacity - fits * length, left // fits, [length] * fits)
            if left % fits:
                put(capacity - left % fits * length, 1, [length] * (left % fits))
            left = 0
    return done + [(count, lengths) for _, _, count, lengths in sorted(packs)]


class Slots:
    """Where the piece of a length and a rank goes."""

    def __init__(self, patterns: list[tuple[int, list[int]]]):
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for count, lengths in patterns:
            offset = 0
            for length in lengths:
                rows.append((length, taken.get(length, 0), sequence, offset))
                taken[length] = taken.get(length, 0) + count
                offset += length
            sequence += count
        table = np.asarray(sorted(rows), dtype=np.int64).reshape(-1, 4)
        self.key = self._key(table[:, 0], table[:, 1])
        self.rank, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    @staticmethod
    def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return length * (np.int64(1) << np.int64(44)) + rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, self._key(length, rank), side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def _place(batches: Iterator[pa.RecordBatch], slots: Slots) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "rank"))
        sequence, offset = slots.place(length, rank)
        kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])


def pack(documents: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Packs every document, encoded and ended by ``end_id``, into sequences of ``capacity`` ids.

    ``documents`` has doc_id and text; other columns are ignored. Longer documents are cut at
    multiples of ``capacity``. Returns a row for each piece: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset. A null or empty text is the end id alone. doc_id is only
    carried along: null or repeated ones are packed like any other row. An empty table gives
    an empty result. ``capacity`` bounds the histogram and so what the driver and the tasks
    hold; a piece's rank counts within its length and reading task, so a length that many
    pieces share is ranked in as many tasks as read it.
    """
    spark = ready(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = settle(rows.mapInArrow(lambda it: _pieces(it, tokenizer, end_id, capacity), _PIECES), "token-pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = Slots(shortest_pack_first(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "task").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = pieces.withColumn("place", F.row_number().over(within) - 1).join(bases, ["length", "task"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(lambda it: _place(it, slots), _PLACED)
