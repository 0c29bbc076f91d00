import math
import re
from collections import Counter

import duckdb
import pytest

from llm.helpers import rows
from riskloom.llm import license_scan as ls
from riskloom.llm.queries import op3_license_scan

MIT, GPL = ls.TEMPLATES["MIT"], ls.TEMPLATES["GPL-3.0"]


@pytest.fixture
def files(spark):
    return lambda *r: spark.createDataFrame(r, "path string, text string").selectExpr("*", "1 as dir", "1 as salt", "'x' as score", "1 as h", "1 as n")


def cosine(line, template):
    docs = [Counter(re.findall(ls.WORD, t.lower())) for t in ls.TEMPLATES.values()]
    df = Counter(t for d in docs for t in d)
    idf = lambda t: math.log((1 + len(docs)) / (1 + df[t])) + 1
    a, b = (Counter(re.findall(ls.WORD, x.lower())) for x in (line, template))
    dot = sum(a[t] * b[t] * idf(t) ** 2 for t in a)
    size = lambda c: math.sqrt(sum((n * idf(t)) ** 2 for t, n in c.items()))
    return dot / (size(a) * size(b)) if a and b else 0.0


def test_matches_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view documents as from '{small}/documents.parquet'")
    ours = op3_license_scan(spark, small)
    cursor = con.execute(ls.sql())
    assert ours.columns == [d[0] for d in cursor.description]
    assert rows(ours) == sorted(cursor.fetchall(), key=str)


LINES = [
    MIT, MIT.upper(), "Released under the MIT License", "released MIT", "Licensed under the Apache License, Version 2.0 (the \"License\");", "the a an of under", "GNU General Public License",
    "permission is hereby granted to use copy modify and distribute", "Licensed under CC BY-NC 4.0.", "CC BY 4.0", "redistribution of source and binary forms is permitted", "MIT MIT MIT", "version 2.0 of the Mozilla Public License",
]


def test_every_line_scores_as_by_hand(files):
    got = {r.path: r for r in ls.scan_licences(files(*[(str(i), f"{x}\nmore\nlines\nhere") for i, x in enumerate(LINES)])).collect()}
    for i, line in enumerate(LINES):
        best = max((round(cosine(line, t), 6), n) for n, t in ls.TEMPLATES.items())
        if best[0] >= ls.THRESHOLD:
            assert (got[str(i)].origin, got[str(i)].score) == ("own", best[0]), line
        else:
            assert got[str(i)].origin == "none", line


def test_the_nearest_directory_hands_down(files):
    got = ls.scan_licences(files(
        ("LICENSE", f"{GPL}\n"), ("a/LICENSE", f"\n{MIT}\nshort"), ("a/b/c/x", "code"), ("a/own", f"x\ny\nz\n{ls.TEMPLATES['Apache-2.0']}"), ("d/e", "code"), ("ab/x", None),
        ("a/b/long", "\n".join(["code"] * 5000)), ("top", ""), (None, "code"), (None, MIT), ("a/b/c/x", "code"), ("a/b/c/x", f"other\ncode\n\n{GPL}"),
    ))
    by = {}
    for r in got.collect():
        by.setdefault(r.path, []).append((r.licence, r.origin, r.licence_path))
    assert by["a/b/c/x"].count(("MIT", "inherited", "a/LICENSE")) == 2 and ("GPL-3.0", "own", "a/b/c/x") in by["a/b/c/x"]
    assert by["a/b/long"] == [("MIT", "inherited", "a/LICENSE")] and by["a/own"] == [("Apache-2.0", "own", "a/own")]
    assert by["d/e"] == by["ab/x"] == by["top"] == [("GPL-3.0", "inherited", "LICENSE")]
    assert sorted(by[None], key=str) == [("MIT", "own", None), (None, "none", None)]


def test_ties_and_empty_table(files):
    got = ls.scan_licences(files(("d/2", MIT), ("d/1", MIT), ("d/x", "y"))).collect()
    assert {r.path: r.licence_path for r in got} == {"d/1": "d/1", "d/2": "d/2", "d/x": "d/1"}
    assert ls.scan_licences(files(("a", "b")).limit(0)).collect() == []


def test_no_python_in_the_plan(files):
    plan = ls.scan_licences(files(("a", "b")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
