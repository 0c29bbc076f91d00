"""Conversation repair: cheapest edits by transfer matrices over a grammar of row symbols.

A row counts for the edits only by its role's initial and its fault, one of sixteen symbols,
so a conversation is a string of symbols. Re-Pair turns the distinct strings of a batch into
a grammar. Each symbol and each rule has one min-plus matrix over the four states of
``(s?(ua)+)?``: the cheapest way from a state to a state, and the audit of its edits as a
rope. A rule's matrix is the product of its two parts', worked out once and shared by every
conversation that the rule occurs in.

Audits of equal cost for the same rows are never prefixes of one another (an insert costs
something, and each row has one letter), so the lesser audit stays the lesser one whatever
follows: keeping one per entry is exact.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import pieces, ready, settle

ROLES = "sua"  # and others: class 3
OK, TRUNCATED, DUPLICATE, BLANK = range(4)
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
NEXT = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_A: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A)}
RULE_PAYS = 4  # occurrences from which one matrix product is cheaper than its uses
BATCH_SYMBOLS = 1 << 20
SEGMENT = 1 << 20
SPACE = " \t\n\x0b\x0c\r"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_SEGMENTS = "conv string, part int, seg long, symbols string"
_PLANS = "conv string, symbols string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_ROWS = "conv string, place long, role string, text string"

Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


# --- the grammar ------------------------------------------------------------------------


def re_pair(sequences: list[bytes], first_new: int = 256, least: int = RULE_PAYS) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """The sequences in symbols of a grammar, and its rules from ``first_new`` on.

    The most frequent pair becomes a rule, time and again, until none occurs ``least`` times;
    of equally frequent pairs the least one. Places are linked lists, so a replacement costs
    the same wherever it is.
    """
    sym: list[int] = []
    heads = []
    for s in sequences:
        heads.append(len(sym))
        sym.extend(s)
        sym.append(-1)
    after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i in range(len(sym) - 1):
        if sym[i] >= 0 and sym[i + 1] >= 0:
            places[sym[i], sym[i + 1]].add(i)
    heap = [(-len(p), pair) for pair, p in places.items()]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        count, pair = heapq.heappop(heap)
        here = places.get(pair, ())
        if len(here) < least:
            continue
        if len(here) != -count:
            heapq.heappush(heap, (-len(here), pair))
            continue
        a, b = pair
        new, changed, made = first_new + len(rules), set(), 0
        for i in sorted(here):
            j = after[i]
            if sym[i] != a or j >= len(sym) or sym[j] != b:
                continue  # overlapped the place before it
            left, right = before[i], after[j]
            if left >= 0 and sym[left] >= 0:
                places[sym[left], a].discard(left)
                places[sym[left], new].add(left)
                changed.add((sym[left], new))
            if sym[right] >= 0:
                places[b, sym[right]].discard(j)
                places[new, sym[right]].add(i)
                changed.add((new, sym[right]))
            sym[i], sym[j] = new, -2
            after[i], before[right] = right, i
            made += 1
        del places[pair]
        rules.append(pair)
        for p in changed:
            if p in places:
                heapq.heappush(heap, (-len(places[p]), p))
    out = []
    for i in heads:
        line = []
        while sym[i] != -1:
            line.append(sym[i])
            i = after[i]
        out.append(line)
    return out, rules


# --- matrices ---------------------------------------------------------------------------


def flat(rope: Rope) -> str:
    if isinstance(rope, str):
        return rope
    out, stack = [], [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            stack += (top[1], top[0])
    return "".join(out)


def joined(a: Rope, b: Rope) -> Rope:
    """Short audits are joined at once, long ones are shared."""
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64:
        return a + b
    return (a, b) if a and b else a or b


def better(a: tuple[int, Rope], b: tuple[int, Rope] | None) -> bool:
    if b is None or a[0] != b[0]:
        return b is None or a[0] < b[0]
    return a[1] is not b[1] and flat(a[1]) < flat(b[1])


def product(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = {}
    for (p, m), (c, s) in x.items():
        for q in range(4):
            step = y.get((m, q))
            if step is None:
                continue
            have = out.get((p, q))
            if have is not None and have[0] < c + step[0]:
                continue
            found = (c + step[0], joined(s, step[1]))
            if better(found, have):
                out[p, q] = found
    return out


#: The inserts between two rows: the fewest from a state to a state.
INSERTS: Matrix = {(p, p): (0, "") for p in range(4)} | {
    (START, AFTER_U): (2, "I"), (START, AFTER_A): (4, "II"), (AFTER_S, AFTER_U): (2, "I"), (AFTER_S, AFTER_A): (4, "II"),
    (AFTER_U, AFTER_A): (2, "I"), (AFTER_A, AFTER_U): (2, "I"),
}


def symbol_matrix(symbol: int) -> Matrix:
    """What one row allows, with any inserts after it."""
    role, fault = divmod(symbol - 65, 4)
    out: Matrix = {(p, p): (3, "D") for p in range(4)}
    if fault in (OK, TRUNCATED):
        edits = [(2, "R", "u"), (2, "R", "a")] + ([(0, "K", ROLES[role])] if role < 3 else [])
        for cost, letter, to in edits:
            for p, q in STEPS[to].items():
                way = (cost + (fault == TRUNCATED), letter)
                if better(way, out.get((p, q))):
                    out[p, q] = way
    return product(out, INSERTS)


def cheapest(sequences: list[bytes]) -> list[tuple[int, str]]:
    """(cost, audit) of each string of symbols, over one grammar of them all."""
    lines, rules = re_pair(sequences)
    matrices = {s: symbol_matrix(s) for s in range(65, 81)}
    for i, (a, b) in enumerate(rules):
        matrices[256 + i] = product(matrices[a], matrices[b])
    start: Matrix = {pq: way for pq, way in INSERTS.items() if pq[0] == START}
    out = []
    for line in lines:
        row = start
        for s in line:
            row = product(row, matrices[s])
        best = min(((c, flat(r)) for (_, q), (c, r) in row.items() if q in (START, AFTER_A)))
        out.append(best)
    return out


_LEGAL = np.zeros((4, 4), dtype=bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


def _counts(s: bytes) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated, illegal) of a string of symbols."""
    x = np.frombuffer(s, dtype=np.uint8).astype(np.int64) - 65
    fault, role = np.bincount(x & 3, minlength=4), x >> 2
    return int(fault[BLANK]), int(fault[DUPLICATE]), int(fault[TRUNCATED]), int((~_LEGAL[role[:-1], role[1:]]).sum())


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def done(convs: list[str], lines: list[str]) -> pa.RecordBatch:
        distinct = [s.encode() for s in dict.fromkeys(lines)]
        found = {s.decode(): (*_counts(s), *way) for s, way in zip(distinct, cheapest(distinct))}
        columns = list(zip(*(found[s] for s in lines)))
        types = [pa.int64()] * 5 + [pa.string()]
        names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.RecordBatch.from_arrays([pa.array(convs), pa.array(lines), *map(pa.array, columns, types)], ["conv", "symbols", *names])

    convs, lines, held = [], [], 0
    for batch in batches:
        for conv, line in zip(batch.column("conv").to_pylist(), batch.column("symbols").to_pylist()):
            convs.append(conv)
            lines.append(line)
            held += len(line)
            if held >= BATCH_SYMBOLS:
                yield done(convs, lines)
                convs, lines, held = [], [], 0
    if convs:
        yield done(convs, lines)


# --- rows to symbols --------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) after the damage that crc32 of ``conv_id:turn`` deals.

    ``conv`` is conv_id as a string that is never null. Nulls are one space.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    rows = conversations.select(conv_key(), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("d <> 0").select(
        "conv", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("d") == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """The same columns of the rows as they are."""
    space = F.lit(" ")
    return conversations.select(
        conv_key(), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"), F.lit(1).alias("copies"),
    )


def conv_key() -> Column:
    return F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")).alias("conv")


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256)).alias("digest")


def row_symbols(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, symbols): equal rows of a turn are one row with a symbol each.

    Texts stay behind: from here on a row is its digest. Equal rows are counted before they
    are shuffled, and so are the turns at which a text comes first.
    """
    kept = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(kept == "", BLANK).when(F.right(kept, F.lit(1)).isin(".", "!", "?"), OK).otherwise(TRUNCATED)
    thin = rows.select("conv", "turn", "role", _digest(), fault.alias("fault"), "copies")
    lines = thin.groupBy("conv", "turn", "role", "digest").agg(F.any_value("fault").alias("fault"), F.sum("copies").alias("copies"))
    lines = settle(lines, "conversation-lines")
    first = lines.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    both = lines.join(first, ["conv", "role", "digest"])
    again = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    here = F.when(F.col("turn").eqNullSafe(F.col("first.turn")), F.col("fault")).otherwise(again)
    of_role = 4 * F.coalesce(F.nullif(F.instr(F.lit(ROLES), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(3))
    of_role = F.when(F.col("role") == "", 12).otherwise(of_role)
    symbols = F.concat(F.char(65 + of_role + here), F.repeat(F.char(65 + of_role + again), (F.col("copies") - 1).cast("int")))
    return settle(both.select("conv", "turn", "role", "digest", symbols.alias("symbols")), "conversation-symbols")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seg = TaskContext.get().partitionId(), 0
    conv, held, size = None, [], 0
    out: list[tuple[str, int, int, str]] = []

    def close() -> None:
        nonlocal seg, size, held
        if held:
            out.append((conv, part, seg, "".join(held)))
            seg, held, size = seg + 1, [], 0

    for batch in batches:
        rows = zip(batch.column("conv").to_pylist(), batch.column("symbols").to_pylist())
        for name, group in groupby(rows, key=lambda r: r[0]):
            if name != conv:
                close()
                conv = name
            for _, s in group:
                held.append(s)
                size += len(s)
                if size >= SEGMENT:
                    close()
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pydict(dict(zip(("conv", "part", "seg", "symbols"), map(pa.array, zip(*out), (pa.string(), pa.int32(), pa.int64(), pa.string())))))
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(("conv", "part", "seg", "symbols"), map(pa.array, zip(*out), (pa.string(), pa.int32(), pa.int64(), pa.string())))))


def plans(symbols: DataFrame) -> DataFrame:
    """(conv, symbols, blank, duplicate, truncated, illegal, cost, audit) of each conversation.

    Rows are put in order by ranges, so one long conversation spreads over tasks; what meets
    by conversation is a byte for each row, as much as its audit.
    """
    order = ["conv", "turn", "role", "digest"]
    placed = symbols.repartitionByRange(pieces(symbols.sparkSession), *order).sortWithinPartitions(*order)
    segments = placed.select("conv", "symbols").mapInArrow(_segments, _SEGMENTS)
    parts = F.array_sort(F.collect_list(F.struct("part", "seg", "symbols")))
    whole = segments.groupBy("conv").agg(F.array_join(F.transform(parts, lambda p: p["symbols"]), "").alias("symbols"))
    return settle(whole.mapInArrow(_plans, _PLANS), "conversation-plans")


# --- repaired rows ----------------------------------------------------------------------


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, audit, at, state, place = None, "", 0, START, 0
    out: list[tuple[str, int, str, str]] = []

    def say(role: str, text: str) -> None:
        nonlocal place
        out.append((conv, place, role, text))
        place += 1

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role, state = NEXT[state]
            say(role, "")
            at += 1

    def batch_of() -> pa.RecordBatch:
        made = pa.RecordBatch.from_pydict(dict(zip(("conv", "place", "role", "text"), map(pa.array, zip(*out), (pa.string(), pa.int64(), pa.string(), pa.string())))))
        out.clear()
        return made

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv", "head", "role", "text", "copies"))
        for name, head, role, text, copies in zip(*columns):
            if head:
                inserts()
                conv, audit, at, state, place = name, text, 0, START, 0
                continue
            for _ in range(copies):
                inserts()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = STEPS[role[0]][state]
                    say(role, text)
                elif edit == "R":
                    to, state = NEXT[state]
                    say(to, text)
        if out:
            yield batch_of()
    inserts()
    if out:
        yield batch_of()


def repaired_rows(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, place, role, text) of the repaired conversations, each in order in one partition.

    Rows follow their conversation's audit in a sorted stream, so a task holds one batch and
    one audit, whatever the length of a conversation.
    """
    heads = planned.select("conv", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(0).alias("copies"))
    lines = rows.select("conv", F.lit(False).alias("head"), "turn", "role", _digest(), "text", "copies")
    dealt = heads.unionByName(lines).repartition(pieces(rows.sparkSession), "conv")
    placed = dealt.sortWithinPartitions("conv", F.desc("head"), "turn", "role", "digest")
    return placed.select("conv", "head", "role", "text", "copies").mapInArrow(_apply, _ROWS)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, out = None, None, []
    for batch in batches:
        for name, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "place", "role", "text"))):
            if not place:
                if conv is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = name, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pydict({"conv": [c for c, _ in out], "repaired_sha256": [h for _, h in out]})
            out.clear()
    if conv is not None:
        out.append((conv, digest.hexdigest()))
        yield pa.RecordBatch.from_pydict({"conv": [c for c, _ in out], "repaired_sha256": [h for _, h in out]})


def repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest edits and the repaired text's hash of every conv_id.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored. ``rows``, by
    default the rows as they are, may be ``damaged(conversations)``. Returns conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    - Nulls in role or text are one space. A null conv_id is a conversation of its own; null
      turns come first and don't count for gaps.
    - Rows of one turn are ordered by role, then by the SHA-256 of their text; rows repeated in
      full are duplicates of each other and adjacent.
    - A conversation without rows has zeros, an empty audit and the hash of nothing. An empty
      table gives no rows.
    - Of equally cheap audits the ASCII-least one. Texts of any length are hashed in a stream.
    - A conversation with very many rows is put in order by many tasks and costs a byte a row
      where it meets; only its hash, which has to read it in order, is a stream in one task.
    """
    spark = ready(conversations.sparkSession)
    rows = undamaged(conversations) if rows is None else rows
    symbols = row_symbols(rows)
    planned = plans(symbols)
    hashes = repaired_rows(rows, planned).mapInArrow(_hash, "conv string, repaired_sha256 string")
    turns = symbols.where("turn is not null").select("conv", "turn").distinct().groupBy("conv")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    kind = conversations.schema["conv_id"].dataType
    every = conversations.select(conv_key()).distinct()
    whole = every.join(planned.drop("symbols"), "conv", "left").join(gaps, "conv", "left").join(hashes, "conv", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    conv_id = F.when(F.col("conv") == "n", None).otherwise(F.substring("conv", 2, 1 << 30)).cast(kind)
    return whole.select(conv_id.alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
