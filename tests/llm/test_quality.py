import numpy as np

from llm.helpers import rows
from riskloom.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    model = quality.train(docs, labels.where("doc_id % 3 > 0"))
    got = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert len(got) == docs.count()
    held = [d for d in known if d % 3 == 0]
    right = [got[d].keep == bool(known[d]) for d in held]
    good = [got[d].keep for d in held if known[d]]
    assert sum(right) / len(right) > 0.95 and sum(good) / len(good) > 0.97
    assert all(0 <= s <= 1 for r in got.values() for s in r[1:4])


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    view = lambda labels, gap: rng.normal(size=(len(labels), 4)) + gap * labels[:, None]
    pool = rng.integers(0, 2, 900)
    model = quality.CoTrained(view(y, 2.0), view(y, 1.5), y, view(pool, 2.0), view(pool, 1.5))
    assert min(model.learned) > 50
    new = rng.integers(0, 2, 1000)
    a, b, both = model.scores(view(new, 2.0), view(new, 1.5))
    right = [((s > 0.5) == new).mean() for s in (a, b, both)]
    assert right[2] >= max(right[:2]) - 0.005 and right[2] > 0.97
    assert abs(both.mean() - new.mean()) < 0.05


def test_both_views_teach_on_documents(spark):
    """In each round both views label documents, at the measured precision; neither gets much worse by it."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = dict(labels.select("doc_id", "quality").toPandas().itertuples(index=False))
    right = {}
    for rounds in (0, quality.ROUNDS):
        model = quality.train(docs, labels.where("doc_id % 4 > 0"), rounds=rounds)
        got = quality.score_quality(docs.where("doc_id % 4 = 0"), model).toPandas()
        got = got[got["doc_id"].isin(known)]
        y = got["doc_id"].map(known) == 1
        right[rounds] = [((got[c] >= 0.5) == y).mean() for c in ("text_score", "metadata_score", "score")]
    for good, bad in ((model.taught[i][1], model.taught[i][0]) for i in (0, 1)):
        assert len(good) == quality.ROUNDS and all(a + b > 0 for a, b in zip(good, bad))
    before, after = right[0], right[quality.ROUNDS]
    assert after[1] >= before[1] - 0.005 and after[2] >= before[2] - 0.005 and after[2] > 0.99, (before, after)


def test_precision_is_that_of_the_rows_above():
    rng = np.random.default_rng(2)
    for _ in range(20):
        score, noise = rng.normal(size=200), rng.normal(size=200)
        right = score + noise > 0
        cuts = [c for c in score if (score >= c).sum() >= quality.LEAST_OF_CLASS and right[score >= c].mean() >= quality.PRECISION]
        assert quality.precise_from(score, right) == (min(cuts) if cuts else np.inf)


def test_filter_agrees_with_scores_and_keeps_columns(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score_quality(docs, model).where("keep").collect()}
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good
    odd = documents((None, "A good enough text here."), (1, None), (2, ""), (3, "x " * 200_000), (4, "same"), (4, "same"), (5, "\0é\n\n"))
    assert len(quality.score_quality(odd, model).collect()) == 7
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.score_quality(odd.limit(0), model).collect() == []
    assert len(quality.score_quality(odd.select("doc_id", "text"), model).collect()) == 7


def test_labels_that_teach_nothing(spark, documents):
    docs = documents(*[(i, f"text {i}") for i in range(30)])
    for labels in ([], [(i, 1) for i in range(30)], [(None, 0)] * 20 + [(1, None), (2, 7), (3, 0), (3, 1)]):
        model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert not model.fitted and all(r.keep for r in quality.score_quality(docs, model).collect())
    assert rows(quality.keep_good(docs, model)) == rows(docs)
    assert not quality.train(docs.limit(0), spark.createDataFrame([(1, 0)], "doc_id long, quality int")).fitted


def test_samples_are_bounded_and_repeatable(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    ids = docs.select("doc_id")
    one, two = (rows(quality._some(ids, 100)) for _ in range(2))
    assert one == two and 60 < len(one) < 140
