import os

from riskloom import Params
from riskloom import catalog as cat
from riskloom import session
from riskloom.plans import study
from riskloom.session import scratch_path, settle
from riskloom.sources import readers


def test_study_writes_every_table(spark, raw):
    out = scratch_path(spark, "study")
    summary = study.run(settle(raw, cat.KEY), out, Params(), ["LogisticRegression"])
    row = summary.first()
    assert row["model"] == "LogisticRegression" and '"C"' in row["best_params"]
    written = readers.read_csv(spark, f"{out}/model_summary", summary.schema).first()
    assert written["f1"] == row["f1"] and 0 < row["pr_auc"] <= 1
    assert spark.read.parquet(f"{out}/describe").count() == 68
    assert spark.read.parquet(f"{out}/corr_matrix").count() == 900
    assert spark.read.parquet(f"{out}/predictions").count() == 300
    assert spark.read.parquet(f"{out}/top_correlations").count() == 30
    assert spark.read.parquet(f"{out}/projection_2d").count() == 1200
    spectrum = spark.read.parquet(f"{out}/explained_variance")
    assert spectrum.count() == 68 and spectrum.where("kept").agg({"ratio": "sum"}).first()[0] >= 0.95
    assert spark.read.parquet(f"{out}/split_counts").agg({"n": "sum"}).first()[0] == 1500
    resampled = {(r["method"], r["Target"]): r["n"] for r in spark.read.parquet(f"{out}/resampled_counts").collect()}
    assert len(resampled) == 8 and resampled["SMOTE", 0] == resampled["SMOTE", 1]
    cells = spark.read.parquet(f"{out}/confusion_matrix")
    assert cells.count() == 4 and cells.agg({"n": "sum"}).first()[0] == 300
    assert spark.read.parquet(f"{out}/pr_curve").where("threshold is null").count() == 1
    assert 0 < spark.read.parquet(f"{out}/no_skill").first()["no_skill"] < 1


def test_scratch_is_given_back(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_own_folder", lambda spark: f"file:{tmp_path}/own")
    assert settle(raw, cat.KEY).count() == 1500
    assert os.listdir(tmp_path) == ["own"]
    session.drop_scratch(spark)
    assert not os.listdir(tmp_path)
