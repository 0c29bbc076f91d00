import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from llm.helpers import rows
from riskloom.llm import conversation_repair as cr

BLANK = " \t\n\x0b\x0c\r"


def damage(table):
    for c, t, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            yield from [(c, t, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)


def best_edits(conv):
    """Row by row, all states, whole audits and repaired lines: (cost, audit, lines)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(ways):
        for _ in range(2):
            for state, (cost, audit, lines) in list(ways.items()):
                for to in "ua":
                    if (state, to) in step:
                        new = (cost + 2, audit + "I", [*lines, names[to] + ":"])
                        if to not in ways or new < ways[to]:
                            ways[to] = new
        return ways

    ways = with_inserts({"": (0, "", [])})
    for role, text, fault in conv:
        now = {}
        for state, (cost, audit, lines) in ways.items():
            options = [(state, cost + 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                for to in "ua":
                    options.append((step.get((state, to)), cost + 2 + extra, "R", [*lines, f"{names[to]}:{text}"]))
                options.append((step.get((state, role[:1])), cost + extra, "K", [*lines, f"{role}:{text}"]))
            for to, c, letter, said in options:
                if to is not None and (to not in now or (c, audit + letter) < now[to][:2]):
                    now[to] = (c, audit + letter, said)
        ways = with_inserts(now)
    return min(ways[s] for s in ("", "a") if s in ways)


def brute(table, hurt=True):
    convs = defaultdict(list)
    for c, *_ in table:
        convs[c]
    for c, t, role, text in damage(table) if hurt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in table]:
        convs[c].append((t, role, text))
    out = []
    for c, lines in convs.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, conv = set(), []
        for _, role, text in lines:
            end = text.rstrip(BLANK)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            conv.append((role, text, fault))
        turns = {t for t, *_ in lines if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(conv, conv[1:]))
        cost, audit, said = best_edits(conv)
        faults = [sum(f == k for *_, f in conv) for k in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, table, kind="long"):
    return spark.createDataFrame(table, f"conv_id {kind}, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as place", "'x' as symbols", "3 as copies", "4 as d")


def test_small_table(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    assert rows(cr.repair(df, cr.damaged(df))) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def made(seed, n=300):
    random.seed(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User", "a"]
    texts = ["Hi.", "Why?", "so", " \n", "", None, "ok! ", "x.\x0b", "é", "e…", "b\n", "Hi.", "!"]
    table = []
    for c in range(n):
        turn = random.randrange(-2, 3)
        for _ in range(random.randrange(9)):
            table.append((random.choice([c, c, c, None]) if c % 50 == 0 else c, random.choice([turn, turn, turn, turn + 2, None]), random.choice(roles), random.choice(texts)))
            turn += 1
    return table


@pytest.mark.parametrize("hurt", [True, False])
def test_faults_ties_repeats_and_nulls(spark, hurt):
    table = made(7)
    df = frame(spark, table).repartition(7)
    assert rows(cr.repair(df, cr.damaged(df) if hurt else None)) == brute(table, hurt)


def test_long_conversations_and_texts(spark, monkeypatch):
    random.seed(4)
    table = [(1, t, random.choice(["user", "assistant", "assistant", "tool"]), f"{random.randrange(400)}{random.choice('.!x')}") for t in range(3000)]
    table += [(2, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(2000)] + [(3, 5, "user", "same.")] * 500
    table += [(4, 0, "user", "long " * 200_000), (4, 1, "assistant", "\n" * 300_000), (4, 2, "assistant", "." + " " * 200_000 + ".")]
    monkeypatch.setattr(cr, "SEGMENT", 100)
    df = frame(spark, table).repartition(5)
    assert rows(cr.repair(df, cr.damaged(df))) == brute(table)


def test_other_keys_and_empty_table(spark):
    table = [("n", 0, "user", "a."), (None, 0, "user", "b."), ("", 1, "user", "c."), (" ", 1, "system", "d.")]
    assert rows(cr.repair(frame(spark, table, "string"))) == brute(table, hurt=False)
    assert cr.repair(frame(spark, table, "string").limit(0)).collect() == []


def test_grammar_gives_back_the_sequences_and_shares():
    random.seed(1)
    lines = [bytes(random.choices(range(65, 69), k=random.randrange(30))) for _ in range(200)] + [b"", b"A" * 1001, b"AB" * 500]
    packed, rules = cr.re_pair(lines)

    def expand(s):
        return bytes([s]) if s < 256 else expand(rules[s - 256][0]) + expand(rules[s - 256][1])

    assert [b"".join(map(expand, p)) for p in packed] == lines
    assert all(a < 256 + i and b < 256 + i for i, (a, b) in enumerate(rules))
    assert sum(map(len, packed)) < sum(map(len, lines)) / 3
    pairs = [(a, b) for p in packed for a, b in zip(p, p[1:])]
    assert max((pairs.count(p) for p in set(pairs) if p[0] != p[1]), default=0) < cr.RULE_PAYS


def test_most_frequent_pair_first():
    _, rules = cr.re_pair([b"ABCABCABDABDAB"] * 3, least=2)
    assert rules[0] == (65, 66)


def test_repaired_rows_are_legal(spark):
    df = frame(spark, made(9))
    lines = cr.damaged(df)
    said = defaultdict(list)
    for r in cr.repaired_rows(lines, cr.plans(cr.row_symbols(lines))).collect():
        said[r.conv].append((r.place, r.role[0]))
    assert said and all(re.fullmatch("s?(ua)+", "".join(i for _, i in sorted(s))) for s in said.values())
