import random

from llm.helpers import rows
from riskloom.llm import line_dedup as ld


def brute(docs, sites):
    spread, first = {}, {}
    lines = [(d, s, i, line) for d, text, s in docs if text is not None for i, line in enumerate(text.split("\n")) if line.strip(" ")]
    for d, s, i, line in lines:
        spread.setdefault(line, set()).update({s} - {None})
        first[line] = min(first.get(line, (d, i)), (d, i))
    out = []
    for d, text, _ in docs:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        every = text.split("\n")
        kept = [x for i, x in enumerate(every) if not x.strip(" ") or len(spread[x]) < sites or first[x] == (d, i)]
        out.append((d, "\n".join(kept), len(every), len(every) - len(kept)))
    return sorted(out, key=str)


def mine(df, **options):
    return rows(ld.dedup_lines(df, **options).select("doc_id", "text", "n_lines", "n_removed"))


def test_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert mine(docs) == brute([(r.doc_id, r.text, r.source) for r in docs.collect()], ld.SITES)


def test_spreads_on_both_sides_of_the_threshold(documents):
    random.seed(1)
    docs = []
    for i in range(200):
        lines = [f"on {k} sites" for k in range(1, 31) if i % 30 < k] + [f"own {i}", "", "  "]
        random.shuffle(lines)
        docs.append((i, "\n".join(lines), f"site {i % 30}"))
    for sites in (2, 10, 25):
        assert mine(documents(*docs), sites=sites) == brute(docs, sites)


def test_a_line_in_every_document_and_a_long_text(documents):
    docs = [(i, f"shared\nown {i}\nshared", f"s{i}") for i in range(60)] + [(99, "\n".join(["shared", "x"] * 20_000), "s1")]
    assert mine(documents(*docs)) == brute(docs, 10)


def test_nulls_empty_and_repeated_rows(documents):
    docs = [(i, "plate\nbody", f"s{i}") for i in range(12)] + [(20, None, "a"), (21, "", "b"), (22, "\n\n", "c"), (23, "plate", None)]
    assert mine(documents(*docs)) == brute(docs, 10)
    nulls = [(i, "only null sites", None) for i in range(30)]
    assert mine(documents(*nulls)) == brute(nulls, 10)
    again = [(0, "plate\nbody", "s0")] * 3 + [(i, "plate", f"s{i}") for i in range(1, 12)]
    got = mine(documents(*again))
    assert got[:3] == [(0, "plate\nbody", 2, 0)] * 3 and all(r[3] == 1 and r[1] == "" for r in got[3:])
    unknown = mine(documents((None, "plate", "z"), *docs[:12]))
    assert (None, "plate", 1, 0) in unknown and all("plate" not in r[1] for r in unknown if r[0] is not None)


def test_all_columns_stay(documents):
    df = documents((1, "a"))
    assert ld.dedup_lines(df).columns == [*df.columns, "n_lines", "n_removed"]
    assert ld.dedup_lines(df.limit(0)).collect() == []


def test_no_python_in_the_plan(documents):
    plan = ld.dedup_lines(documents((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
