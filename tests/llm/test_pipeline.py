"""Each stage against a brute-force version on its own input, and the whole run."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from llm.test_decontamination import brute as leaks_by_hand
from llm.test_line_dedup import brute as lines_by_hand
from llm.test_simhash_dedup import brute as groups_by_hand
from riskloom.llm import quality
from riskloom.llm.common import settle, table
from riskloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = [table(spark, small, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(settle(stage(spark, docs[-1], small), "stage-test"))
    return docs


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay_until_the_last(steps):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]
    assert all(d.columns == steps[0].columns and d.dtypes == steps[0].dtypes for d in steps[:-1])


def test_quality(steps, spark, small):
    model = quality.train(steps[0], table(spark, small, "labels"))
    assert ids(steps[1]) == sorted(r.doc_id for r in quality.score_quality(steps[0], model).where("keep").collect())
    bad = {r.doc_id for r in table(spark, small, "labels").where("quality = 0").collect()}
    assert len(bad & set(ids(steps[1]))) < 0.4 * len(bad)


def test_line_dedup(steps):
    expected = {r[0]: r[1] for r in lines_by_hand([(r.doc_id, r.text, r.source) for r in steps[1].collect()], 10)}
    assert {r.doc_id: r.text for r in steps[2].collect()} == expected
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_dedup(steps):
    groups = groups_by_hand([(r.doc_id, r.text) for r in steps[2].collect()])
    assert ids(steps[3]) == sorted({c for _, _, c in groups})


def test_decontamination(steps, spark, small):
    items = [(r.item_id, r.text) for r in table(spark, small, "benchmark").collect()]
    short = steps[3].where("n_chars < 3000")
    leaks = {r[0] for r in leaks_by_hand([(r.doc_id, r.text) for r in short.collect()], items)}
    assert set(ids(short)) - set(ids(steps[4])) == leaks


def test_packing(steps):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in steps[5].collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for r in steps[4].collect():
        x = np.asarray([*library.encode(r.text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert sorted(pieces.pop(r.doc_id)) == [(a, len(x[a : a + 4096]), zlib.crc32(x[a : a + 4096].tobytes())) for a in range(0, len(x), 4096)]
    assert not pieces
    for parts in sequences.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 4096


def test_run_is_the_stages_and_is_registered(spark, small, steps):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, steps[-1].collect()))


def test_every_operator_has_a_query():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14))


def test_a_caller_s_columns_pass_line_dedup(spark, small, documents):
    line = "the same boilerplate line that many sites repeat word for word"
    docs = documents((1, f"own text of one\n{line}", "a"), (2, None, "b"), (3, "", "c"), (3, "", "c"), *[(i, f"text {i}\n{line}", f"s{i}") for i in range(10, 40)])
    docs = docs.selectExpr("*", "'mine' as n_lines", "cast(doc_id as string) as n_removed")
    out = corpus_pipeline.line_dedup(spark, docs, small)
    assert out.dtypes == docs.dtypes and out.count() == docs.count()
    assert out.where("n_lines = 'mine' and n_removed = cast(doc_id as string)").count() == docs.count()
    assert ids(out.where(f"contains(text, '{line}')")) == [1]  # it stays where it comes first
    assert out.where("n_chars <> length(text)").count() == 0
    bare = corpus_pipeline.line_dedup(spark, docs.drop("n_chars"), small)
    assert "n_chars" not in bare.columns and bare.count() == docs.count()


def test_an_empty_table_passes_the_stages(spark, small, documents):
    docs = documents((1, "x")).limit(0)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.packing(spark, docs, small).count() == 0
