"""Phrase collocations by marginalising the longest windows.

Each word leads one window: itself and the words after it in its piece, up to five, padded
with nulls. Only these longest windows are counted. A phrase is a prefix of the windows that
its first word leads, so a ROLLUP over the lead columns adds up the counts of every shorter
phrase.

Single words are counted first, as they are. Windows are cut where no frequent phrase can go on:
at a word, or at two to four neighbours whose hash slot holds fewer than ``least`` occurrences,
counted over the whole corpus. What is left as a single word is counted already and makes no
window. There are 2^32 slots, so that rare phrases of a large corpus don't add up to a frequent
slot. Tasks look frequent slots up in bitmaps of fixed size; phrases that share a slot or a bit
only make windows longer than they need be.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import GOLD, chunks, mix, ready, settle

LONGEST = 5
COUNTED = 1 << 32  # slots in which runs of a width are counted
#: Bits that hold the frequent slots of one to four words: 26 MB in every task, at any size of the corpus.
SLOTS = (1 << 24, 1 << 26, 1 << 26, 1 << 26)
HELD_ROWS = 1 << 19  # counted windows that a task holds to add up those of several chunks

LEADS = [f"w{i}" for i in range(1, LONGEST + 1)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP, _END = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09]] = True
_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True

_COUNTS = "lang string, word string, n long"
_WINDOWS = "lang string, " + ", ".join(f"{w} string" for w in LEADS) + ", n long"


class Pieces:
    """The words of several texts: their dictionary, and each one's code, text and piece."""

    def __init__(self, texts: list[bytes | None]):
        parts = [t or b"" for t in texts]
        raw = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
        end = _END[raw]
        out = end | _GAP[raw]
        before = np.empty_like(out)
        before[0], before[1:] = True, out[:-1]
        starts, ends = np.flatnonzero(~out & before), np.flatnonzero(out & ~before)
        self.piece = np.cumsum(end)[starts]
        self.doc = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), starts, side="right")
        offsets = np.zeros(len(starts) + 1, dtype=np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~out].tobytes())])
        coded = words.dictionary_encode()
        self.code, self.words = np.asarray(coded.indices, dtype=np.int64), coded.dictionary

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.words.to_pylist()), dtype=np.uint64, count=len(self.words))


class Chunk(Pieces):
    """The pieces of a batch of (lang, text) rows, with a number and a hash for each language."""

    def __init__(self, batch: pa.RecordBatch):
        super().__init__(batch.column("text").cast(pa.binary()).to_pylist())
        coded = batch.column("lang").dictionary_encode()
        self.langs, of_doc = coded.dictionary, np.asarray(coded.indices, dtype=np.int64)
        self.lang = of_doc[self.doc]
        self.known: dict[int, np.ndarray] = {}

    @cached_property
    def key(self) -> np.ndarray:
        """A hash of each word and its language."""
        hashes = self.hashes()[self.code] if len(self.code) else np.zeros(0, dtype=np.uint64)
        return mix(hashes ^ _seeds(self.langs)[self.lang])

    def slots(self, width: int) -> np.ndarray:
        """The slot of each run of ``width`` words; a run may pass the end of its piece."""
        h = self.key
        for i in range(1, width):
            h = mix(h[:-1] * GOLD + self.key[i:])
        return (h & np.uint64(COUNTED - 1)).astype(np.int64)

    def hopeful(self, width: int, bitmaps: list[np.ndarray]) -> np.ndarray:
        """Whether each run of ``width`` words in one piece is frequent as far as shorter ones say."""
        if width == 1:
            return np.ones(len(self.code), dtype=bool)
        shorter = self.frequent(width - 1, bitmaps)
        return shorter[:-1] & shorter[1:] & (self.piece[width - 1 :] == self.piece[: len(self.piece) - width + 1])

    def frequent(self, width: int, bitmaps: list[np.ndarray]) -> np.ndarray:
        """The same, as its own slot says too."""
        if width not in self.known:
            out = self.hopeful(width, bitmaps)
            if width <= len(bitmaps) and len(out):
                out &= _holds(bitmaps[width - 1], self.slots(width))
            self.known[width] = out
        return self.known[width]


def _seeds(langs: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in langs.to_pylist()), dtype=np.uint64, count=len(langs))


def _holds(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots & (8 * len(bitmap) - 1)
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def _as_int(slots: np.ndarray) -> pa.Array:
    """Slots as 32-bit numbers, the upper half of them negative."""
    return pa.array(slots.astype(np.uint32).view(np.int32))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        chunk = Chunk(batch)
        kinds = max(1, len(chunk.words))
        keys, n = np.unique(chunk.lang * kinds + chunk.code, return_counts=True)
        yield pa.RecordBatch.from_pydict({
            "lang": chunk.langs.take(pa.array(keys // kinds)), "word": chunk.words.cast(pa.string()).take(pa.array(keys % kinds)), "n": pa.array(n, pa.int64()),
        })


def _word_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slot of each (lang, word), as ``Chunk.slots`` has it."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, batch.column("word").to_pylist()), dtype=np.uint64, count=batch.num_rows)
        key = mix(words ^ _seeds(langs.dictionary)[np.asarray(langs.indices, dtype=np.int64)])
        yield pa.RecordBatch.from_pydict({"slot": _as_int(key & np.uint64(COUNTED - 1))})


def _run_counts(batches: Iterator[pa.RecordBatch], width: int, bitmaps: list) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        chunk = Chunk(batch)
        if len(chunk.code) < width:
            continue
        slots, n = np.unique(chunk.slots(width)[chunk.hopeful(width, [b.value for b in bitmaps])], return_counts=True)
        yield pa.RecordBatch.from_pydict({"slot": _as_int(slots), "n": pa.array(n, pa.int64())})


def _added(tables: list[pa.Table]) -> pa.Table:
    """One table with the counts of equal windows added up."""
    total = pa.concat_tables(tables).group_by(["lang", *LEADS], use_threads=False).aggregate([("n", "sum")])
    return total.rename_columns({"n_sum": "n"}).select(["lang", *LEADS, "n"])


def _windows(batches: Iterator[pa.RecordBatch], bitmaps: list) -> Iterator[pa.RecordBatch]:
    """Counted windows, those of a task's chunks added up as far as ``HELD_ROWS`` allows."""
    held: list[pa.Table] = []
    for batch in chunks(batches, "text"):
        held.append(_counted_windows(Chunk(batch), [b.value for b in bitmaps]))
        if sum(t.num_rows for t in held) > HELD_ROWS:
            held = [_added(held)]
            if held[0].num_rows > HELD_ROWS // 2:
                yield from held.pop().combine_chunks().to_batches(max_chunksize=1 << 16)
    if held:
        yield from _added(held).combine_chunks().to_batches(max_chunksize=1 << 16)


def _counted_windows(chunk: Chunk, bitmaps: list[np.ndarray]) -> pa.Table:
    """Windows of two words or more, with their counts."""
    goes_on = [chunk.frequent(w, bitmaps) for w in range(1, min(LONGEST, len(chunk.code)) + 1)]
    lead = np.flatnonzero(goes_on[1]) if len(goes_on) > 1 else np.zeros(0, dtype=np.int64)
    code = np.r_[chunk.code, np.zeros(LONGEST, dtype=np.int64)]
    columns = [code[lead].astype(np.int32)]
    for i in range(1, LONGEST):
        open_ = np.zeros(len(chunk.code), dtype=bool)
        if i < len(goes_on):
            open_[: len(goes_on[i])] = goes_on[i]
        columns.append(np.where(open_[lead], code[lead + i], -1).astype(np.int32))
    table = pa.table({"lang": chunk.lang[lead], **dict(zip(LEADS, columns))})
    counted = table.group_by(["lang", *LEADS], use_threads=False).aggregate([([], "count_all")])
    names = chunk.words.cast(pa.string())
    taken = {w: names.take(pa.compute.if_else(pa.compute.less(counted[w], 0), None, counted[w])) for w in LEADS}
    return pa.table({"lang": chunk.langs.take(counted["lang"]), **taken, "n": counted["count_all"]})


def _bitmap(slots: DataFrame, size: int) -> np.ndarray:
    """The bits of the slots in the column ``slot``: at most size / 64 rows reach the driver."""
    slot = F.col("slot").bitwiseAND(size - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = np.zeros(size // 64, dtype=np.int64)
    found = slots.select(F.floor(slot / 64).cast("int").alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[np.asarray(found["at"], dtype=np.int64)] = np.asarray(found["bits"])
    return words.view(np.uint8)


def phrase_counts(documents: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """(lang, k, ws, f) of every phrase of k words, ws, found ``least`` times, and (lang, n).

    Both tables are written to the shared folder.
    """
    spark = ready(documents.sparkSession)
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = settle(docs.mapInArrow(_word_counts, _COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = words.where(F.col("n") >= least)
    bitmaps = [spark.sparkContext.broadcast(_bitmap(known.select("lang", "word").mapInArrow(_word_slots, "slot int"), SLOTS[0]))]
    for width in range(2, len(SLOTS) + 1):
        met = docs.mapInArrow(lambda it, w=width, b=list(bitmaps): _run_counts(it, w, b), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
        bitmaps.append(spark.sparkContext.broadcast(_bitmap(met.where(F.col("n") >= least), SLOTS[width - 1])))
    windows = docs.mapInArrow(lambda it: _windows(it, bitmaps), _WINDOWS).groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))
    level = LONGEST - F.bit_count(F.grouping_id())  # how many lead columns the row still has
    rolled = windows.rollup("lang", *LEADS).agg(F.sum("n").alias("f"), level.cast("int").alias("k")).where(F.col("f") >= least)
    # a padded window stands for no phrase of its full width; single words have counts of their own
    last = F.element_at(F.array(*LEADS), F.greatest("k", F.lit(1)))
    longer = rolled.where((F.col("k") >= 2) & last.isNotNull()).select("lang", "k", F.slice(F.array(*LEADS), F.lit(1), F.col("k")).alias("ws"), "f")
    single = known.select("lang", F.lit(1).alias("k"), F.array("word").alias("ws"), F.col("n").alias("f"))
    return settle(longer.unionByName(single), "phrases"), settle(totals, "word-totals")


#: floor(1000 a n / (l r)). Decimals of 38 digits hold the products of any counts below 10^17;
#: a larger product raises an error and is never rounded.
SCORE = (
    "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
    " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
)


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase of two words or more at its lowest-scoring cut: lang, phrase, k, a, l, r, n, score."""
    named = phrases.select("lang", "k", "ws", F.array_join("ws", " ").alias("phrase"), "f")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at")
    cuts = named.where(F.col("k") > 1).select("lang", "k", "ws", "phrase", F.col("f").alias("a"), cut)
    head = F.array_join(F.slice("ws", F.lit(1), F.col("at")), " ")
    tail = F.array_join(F.slice("ws", F.col("at") + 1, F.col("k") - F.col("at")), " ")
    parts = cuts.select("lang", "k", "phrase", "a", "at", head.alias("head"), tail.alias("tail"))
    left = named.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = named.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = parts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).join(totals, "lang")
    lowest = F.min(F.struct(F.expr(SCORE).alias("score"), "at", "l", "r")).alias("low")
    found = both.groupBy("lang", "phrase", "k", "a", "n").agg(lowest)
    return found.select("lang", "phrase", "k", "a", "low.l", "low.r", "n", "low.score")


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the highest count of a counted phrase that holds this one within."""
    first = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    spans = phrases.where(F.col("k") > 2).select("lang", "k", "ws", "f", first.alias("at"))
    length = F.explode(F.sequence(F.lit(2), F.least(F.col("k") - F.col("at") + 1, F.col("k") - 1)))
    spans = spans.select("lang", "ws", "f", "at", length.alias("size"))
    inner = F.array_join(F.slice("ws", F.col("at"), F.col("size")), " ")
    return spans.groupBy("lang", inner.alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(documents: DataFrame, least: int = 100, best: int = 2000, share: int = 100) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``documents`` has lang and text; other columns are ignored. A-Z are lower-cased, pieces end
    at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``. Phrases have 2 to 5 words and
    ``least`` occurrences; one that lies within a longer one is dropped where 100 times the
    longer one's count is at least ``share`` times its own.

    - A null language is ``und``; a null or empty text has no words. Repeated rows count each
      time. A table without frequent phrases, or without rows, gives no rows.
    - Ties: of equally low cuts the first; of equal scores the higher count, then the lesser
      phrase in bytes.
    - A text of any length is read whole, by one task; windows never cross its end.
    - Frequent keys are added up before each shuffle; a language's phrases are cut down to
      ``best`` in every task before they meet.
    """
    phrases, totals = phrase_counts(documents, least)
    found = scored(phrases, totals).join(covered(phrases), ["lang", "phrase"], "left")
    kept = found.where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
