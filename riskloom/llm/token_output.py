"""Token ids in files of Re-Pair grammars that can be read at random.

Documents are dealt out by ranges of doc_id, so shards follow one another in that order.
Within a shard the most frequent pairs of neighbouring symbols become nonterminals, many at a
time, until no pair is frequent or the symbols are used up. A file holds the rules, the
length each rule expands to, where each document's symbols begin, and the symbols; any span
of any document is decoded from its own symbols.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import chunks, per_worker, pieces, ready, settle, text_key
from riskloom.llm.tokens import Encoder
from riskloom.session import scratch_path

MAGIC = b"RPG1"
HEAD = "<4sIQQII"  # magic, bytes a symbol, documents, symbols, first nonterminal, rules
RULES_AT_ONCE = 4096
SHARD_BYTES = 8 << 20  # of text
LEAST_COUNT = 8  # a rule takes 12 bytes and saves a symbol at each place

_SHARDS = "part int, file string, base long, n_docs long, n_tokens long"
_DOCS = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"


def compress(ids: np.ndarray, first: np.ndarray, terminals: int, at_once: int = RULES_AT_ONCE, least: int = LEAST_COUNT):
    """Re-Pair over several documents: (symbols, first symbol of each document, rules).

    ``first`` has an entry for each document and the end; no rule crosses a document's end.
    With fewer than 65,536 terminals, symbols stay below 65,536. Each round takes the
    ``at_once`` most frequent pairs and replaces them from left to right; rounds end when no
    pair comes ``least`` times or no symbol is left.
    """
    most = (1 << 16) if terminals < 1 << 16 else (1 << 31)
    seq, first = ids.astype(np.uint32), first.copy()
    rules = np.zeros((0, 2), dtype=np.uint32)
    while True:
        room = min(at_once, most - terminals - len(rules))
        if len(seq) < 2 or room <= 0:
            break
        ends = first[1:-1] - 1
        ends = ends[(ends >= 0) & (ends < len(seq) - 1)]
        if most == 1 << 16:
            key = (seq[:-1] << np.uint32(16)) | seq[1:]
        else:
            key = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
        inside = np.ones(len(key), dtype=bool)
        inside[ends] = False
        key = np.sort(key[inside])
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.r_[at, len(key)])
        good = np.flatnonzero(count >= least)
        if not len(good):
            break
        if len(good) > room:
            good = good[np.argsort(-count[good], kind="stable")[:room]]
        pairs = key[at[np.sort(good)]].astype(np.uint64)
        bits = np.uint64(16 if most == 1 << 16 else 32)
        left, right = pairs >> bits, pairs & ((np.uint64(1) << bits) - np.uint64(1))
        nonterminal = terminals + len(rules) + np.arange(len(pairs))
        rules = np.concatenate([rules, np.stack([left, right], axis=1).astype(np.uint32)])
        lefts, li = np.unique(left, return_inverse=True)
        rights, ri = np.unique(right, return_inverse=True)
        size = int(seq.max()) + 1
        l_at, r_at = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.int32)
        l_at[lefts.astype(np.int64)] = 1 + np.arange(len(lefts))
        r_at[rights.astype(np.int64)] = 1 + np.arange(len(rights))
        grid = np.zeros((len(lefts) + 1, len(rights) + 1), dtype=np.uint32)
        grid[li + 1, ri + 1] = nonterminal
        rule = grid.ravel()[l_at[seq[:-1]] * np.int32(len(rights) + 1) + r_at[seq[1:]]]
        rule[ends] = 0
        spot = np.flatnonzero(rule)
        if not len(spot):
            break
        begins = np.r_[True, np.diff(spot) > 1]  # of matches that overlap, every second
        spot = spot[(spot - spot[np.maximum.accumulate(np.where(begins, np.arange(len(spot)), 0))]) % 2 == 0]
        seq[spot] = rule[spot]
        keep = np.ones(len(seq), dtype=bool)
        keep[spot + 1] = False
        seq = seq[keep]
        first = first - np.searchsorted(spot + 1, first)
    return seq, first, rules


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many ids each rule stands for; a rule names only terminals and earlier rules."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((1 if a < terminals else out[a - terminals]) + (1 if b < terminals else out[b - terminals]))
    return np.asarray(out, dtype=np.uint64)


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    seq = symbols.astype(np.uint32)
    while True:
        made = seq >= terminals
        if not made.any():
            return seq
        last = np.cumsum(made, dtype=np.int64) + np.arange(len(seq))
        out = np.empty(int(last[-1]) + 1, dtype=np.uint32)
        out[last[~made]] = seq[~made]
        rule, last = seq[made] - np.uint32(terminals), last[made]
        out[last - 1], out[last] = rules[rule, 0], rules[rule, 1]
        seq = out


def to_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, terminals: int) -> bytes:
    first = np.r_[0, np.cumsum(counts)]
    symbols, first, rules = compress(ids, first, terminals)
    width = 2 if terminals + len(rules) <= 1 << 16 else 4
    known = np.asarray([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.asarray([d or 0 for d in doc_ids], dtype="<i8")
    return b"".join([
        struct.pack(HEAD, MAGIC, width, len(doc_ids), len(symbols), terminals, len(rules)),
        numbers.tobytes(), known.tobytes(), counts.astype("<u8").tobytes(), first.astype("<u8").tobytes(),
        rules.astype("<u4").tobytes(), expansion_lengths(rules, terminals).astype("<u8").tobytes(),
        symbols.astype(f"<u{width}").tobytes(),
    ])


class Shard:
    """A file opened for reading: the tables are read at once, symbols as they are asked for."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        magic, self.width, n, self.n_symbols, self.terminals, n_rules = struct.unpack(HEAD, file.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError("not a token file")

        def take(kind: str, count: int) -> np.ndarray:
            return np.frombuffer(file.read(np.dtype(kind).itemsize * count), dtype=kind)

        numbers, known = take("<i8", n), take("<u1", n)
        self.doc_ids = [d if k else None for d, k in zip(numbers.tolist(), known.tolist())]
        self.counts = take("<u8", n).astype(np.int64)
        self.first = take("<u8", n + 1).astype(np.int64)
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = take("<u8", n_rules).astype(np.int64)
        self.begin = file.tell()

    def symbols(self, a: int, b: int) -> np.ndarray:
        self.file.seek(self.begin + a * self.width)
        return np.frombuffer(self.file.read((b - a) * self.width), dtype=f"<u{self.width}")

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids of documents a to b, one after the other."""
        return expand(self.symbols(int(self.first[a]), int(self.first[b])), self.rules, self.terminals)

    def span(self, doc: int, start: int, length: int) -> np.ndarray:
        """``length`` ids of one document from ``start``, from the symbols that cover them."""
        s = self.symbols(int(self.first[doc]), int(self.first[doc + 1])).astype(np.int64)
        made = s >= self.terminals
        sizes = np.ones(len(s), dtype=np.int64)
        sizes[made] = self.lengths[s[made] - self.terminals]
        ends = np.cumsum(sizes)
        a = int(np.searchsorted(ends, start, side="right"))
        b = int(np.searchsorted(ends, start + length))
        skip = start - int(ends[a] - sizes[a]) if a < len(s) else 0
        return expand(s[a : b + 1], self.rules, self.terminals)[skip : skip + length]


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = per_worker("encoder:" + tokenizer, lambda: Encoder(tokenizer))
    terminals = max(encoder.whole.get_vocab_size(), end_id + 1)
    fs, base = pafs.FileSystem.from_uri(folder)
    part, before = TaskContext.get().partitionId(), 0
    for chunk in chunks(batches, "text", SHARD_BYTES):
        ids, counts = encoder.encode(chunk.column("text").to_pylist())
        ids, counts = with_end(ids, counts, end_id)
        name = f"{part:08d}-{before:014d}-{uuid.uuid4().hex}.rpg"  # a retried task writes another file
        if not before:
            fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{name}") as out:
            out.write(to_bytes(chunk.column("doc_id").to_pylist(), counts, ids, terminals))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "file": pa.array([name]), "base": pa.array([before]),
            "n_docs": pa.array([len(counts)]), "n_tokens": pa.array([len(ids)]),
        })
        before += len(ids)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each document."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)).astype("<u4"), counts + 1


def write_shards(documents: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes the files below ``folder``; returns the settled table of shards and the folder.

    ``documents`` has doc_id and text; other columns are ignored. Documents are in ascending
    order of doc_id, null first; rows of one doc_id by a hash of their texts. A null or empty
    text is the end id alone. Rows repeated in full are written as often as they come. A file
    holds about 8 MB of text, or one longer text.
    """
    spark = ready(documents.sparkSession)
    folder = folder or scratch_path(spark, "tokens")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = rows.withColumn("h", text_key()).repartitionByRange(pieces(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    shards = placed.select("doc_id", "text").mapInArrow(lambda it: _write(it, folder, tokenizer, end_id), _SHARDS)
    return settle(shards, "token-shards"), folder


def _read(batches: Iterator[pa.RecordBatch], folder: str, at_once: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(folder)
    for batch in batches:
        for part, name, before in zip(*(batch.column(c).to_pylist() for c in ("part", "file", "base"))):
            with fs.open_input_file(f"{base}/{name}") as file:
                shard = Shard(file)
                ends = np.cumsum(shard.counts)
                cuts = np.flatnonzero(np.diff((ends - shard.counts) // at_once)) + 1
                for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(ends)].tolist()):
                    ids = memoryview(shard.ids(a, b).astype("<u4").tobytes())
                    at = np.r_[0, np.cumsum(shard.counts[a:b])]
                    if at[-1] * 4 != len(ids):
                        raise ValueError(f"{name}: lengths and ids differ")
                    crc = [zlib.crc32(ids[4 * i : 4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([part] * (b - a), pa.int32()), "doc_id": pa.array(shard.doc_ids[a:b], pa.int64()),
                        "at": pa.array(before + ends[a:b] - shard.counts[a:b]), "n_tokens": pa.array(shard.counts[a:b]),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })


def read_back(shards: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids of all documents before; the totals of the parts, as many as
    the shuffle has pieces, are added up on the driver.
    """
    spark = shards.sparkSession
    totals = dict(shards.groupBy("part").agg(F.sum("n_tokens")).collect())
    starts, total = [], 0
    for part in range(max(totals, default=-1) + 1):
        starts.append(total)
        total += totals.get(part, 0)
    dealt = shards.select("part", "file", "base").repartition(pieces(spark), "file")
    docs = dealt.mapInArrow(lambda it: _read(it, folder), _DOCS)
    start = F.element_at(F.lit(starts or [0]).cast("array<bigint>"), F.col("part") + 1)
    return docs.select("doc_id", (F.col("at") + start).alias("start"), "n_tokens", "ids_crc32")
