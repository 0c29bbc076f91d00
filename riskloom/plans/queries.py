"""Every registered query, by name. Each takes (spark, folder of Parquet tables)."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import catalog as cat
from riskloom.functions import codes
from riskloom.functions.codes import q
from riskloom.operators import eda, evaluate, features, linear, models, prepare, resample
from riskloom.params import Params
from riskloom.session import scratch_path, settle, tune
from riskloom.sources import readers, writers
from riskloom.sources.sample import sample_applications

PARAMS = Params()


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_applications(tune(spark), sf_dir)


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_view(_raw(spark, sf_dir))


def rounded(x: Column, places: int) -> Column:
    """``F.round`` of a double, to the bit, without its detour by decimal text.

    The multiple is exact and its quotient the double next to it, so only values near a tie, and
    those too large for the product to tell, need the text: these, nulls and NaN go to ``F.round``.
    """
    scaled = x * F.lit(10.0**places)
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < F.lit(1e11)) & (F.abs(scaled - whole) < F.lit(0.499))
    return F.when(plain, whole / F.lit(10.0**places)).otherwise(F.round(x, places))


def digits(df: DataFrame, places: int = 6) -> DataFrame:
    """Round fractional results, and drop the sign of zero, so two engines can agree."""
    fractions = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(
        *[(rounded(q(c), places) + F.lit(0.0)).alias(c) if c in fractions else q(c) for c in df.columns]
    )


# --- sources, sinks, catalog ----------------------------------------------------------


def scan_raw(spark, sf_dir):
    return _raw(spark, sf_dir)


def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    writers.write_csv(_raw(spark, sf_dir), path)
    return readers.read_csv(spark, path)


def _through_table(spark, df: DataFrame, what: str) -> DataFrame:
    """Written to a catalog table of a name of its own, read, and the name given back."""
    path = scratch_path(spark, what)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.write_table(df, name, path)
    rows = readers.read_table(spark, name)
    rows.schema  # resolves the relation; the files stay
    spark.sql(f"drop table {name}")
    return rows


def scan_table(spark, sf_dir):
    return _through_table(spark, _view(spark, sf_dir), "credit-features")


def scan_colmap_json(spark, sf_dir):
    path = scratch_path(spark, "col-mapping")
    spark.createDataFrame([(json.dumps(cat.display_names()),)], "value string").coalesce(1).write.text(path)
    return features.rename(_view(spark, sf_dir), readers.rename_map_from_json(spark, path))


def scan_colmap_table(spark, sf_dir):
    names = cat.display_names()
    row = spark.createDataFrame([tuple(names.values())], list(names))
    mapping = readers.rename_map_from_frame(_through_table(spark, row, "col-mapping"))
    return features.rename(_view(spark, sf_dir), mapping)


def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "features-csv")
    view = _view(spark, sf_dir)
    writers.write_csv(view, path)
    return readers.read_csv(spark, path, view.schema)


def sink_table(spark, sf_dir):
    return _through_table(spark, features.rename(_view(spark, sf_dir)), "features-table")


def view_ddl(spark, sf_dir):
    features.register_view(_raw(spark, sf_dir), "v_credit_features", keep=(cat.KEY,))
    return spark.sql("select * from v_credit_features")


def preview(spark, sf_dir):
    return _raw(spark, sf_dir).orderBy(cat.KEY).limit(5)


def profile_shape(spark, sf_dir):
    view = features.feature_view(_raw(spark, sf_dir), keep=())
    return view.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(view.columns)))


# --- projections ----------------------------------------------------------------------


def project_raw(spark, sf_dir):
    return _raw(spark, sf_dir).select(cat.KEY, *cat.RAW_ORDER)


def project_dup(spark, sf_dir):
    view = _view(spark, sf_dir)
    return view.select(cat.KEY, *cat.REPEATED, *[q(cat.repeat_name(c)) for c in cat.REPEATED])


def rename_map(spark, sf_dir):
    return features.rename(_view(spark, sf_dir))


def ratio_safe(spark, sf_dir):
    return _raw(spark, sf_dir).selectExpr(cat.KEY, codes.monthly_amount())


def bucket_age(spark, sf_dir):
    return _raw(spark, sf_dir).selectExpr(cat.KEY, codes.age_group())


def flag_age(spark, sf_dir):
    return _raw(spark, sf_dir).selectExpr(cat.KEY, *codes.age_flags())


def decode(name, spark, sf_dir):
    return _raw(spark, sf_dir).selectExpr(cat.KEY, codes.decoded(cat.BY_NAME[name]))


def flag(name, spark, sf_dir):
    return _raw(spark, sf_dir).selectExpr(cat.KEY, *codes.flags(cat.BY_NAME[name]))


def map_values(spark, sf_dir):
    mapped = features.map_values(_view(spark, sf_dir))
    return mapped.select(cat.KEY, *cat.VALUE_NAMES)


def target_encode(spark, sf_dir):
    return features.with_target(_raw(spark, sf_dir)).select(cat.KEY, "Target")


def fill_unknown(spark, sf_dir):
    mapped = features.map_values(_view(spark, sf_dir))
    return features.fill_unknown(mapped).select(cat.KEY, *cat.FILLED)


def sex_from_status(spark, sf_dir):
    return features.with_sex(_view(spark, sf_dir)).select(cat.KEY, "Sex")


def drop_if_exists(spark, sf_dir):
    dropped = [*map(cat.repeat_name, cat.REPEATED), "No such column"]
    return features.drop_if_present(_view(spark, sf_dir), *dropped)


def select_numeric(spark, sf_dir):
    return features.select_numeric(_view(spark, sf_dir), keep=(cat.KEY,))


def one_hot_drop_first(spark, sf_dir):
    view = _view(spark, sf_dir)
    texts = [f.name for f in view.schema if f.dataType.typeName() == "string"]
    return features.one_hot(view.select(cat.KEY, *map(q, texts)), texts)


def described(view: DataFrame) -> DataFrame:
    repeats = {cat.repeat_name(c) for c in cat.REPEATED}
    columns = [c for c in features.numeric_columns(view) if c not in repeats and c != cat.KEY]
    return eda.describe_numeric(view, columns)


def describe_numeric(spark, sf_dir):
    return digits(described(_view(spark, sf_dir)))


def describe_inputs(spark, sf_dir):
    """The other description: without the label, with the repeated columns."""
    view = _view(spark, sf_dir)
    columns = [c for c in features.numeric_columns(view) if c not in (cat.KEY, cat.LABEL)]
    return digits(eda.describe_numeric(view, columns))


def round2(spark, sf_dir):
    return eda.rounded(described(_view(spark, sf_dir)), 2)


# --- counts and statistics ------------------------------------------------------------


def class_balance(spark, sf_dir):
    return digits(eda.class_balance(_raw(spark, sf_dir)))


def _split(spark, sf_dir, *columns) -> DataFrame:
    rows = features.with_target(_view(spark, sf_dir)).select(cat.KEY, "Target", *columns)
    return prepare.stratified_split(rows, PARAMS.test_fraction, PARAMS.seed)


def class_counts_split(spark, sf_dir):
    return digits(eda.class_balance(_split(spark, sf_dir), "Target", by=["part"]))


def category_risk_counts(spark, sf_dir):
    return eda.category_counts(_view(spark, sf_dir))


def crosstab_pct(spark, sf_dir):
    return digits(eda.category_percent(_view(spark, sf_dir)))


def sort_categories(spark, sf_dir):
    return eda.category_counts(_view(spark, sf_dir)).select("feature", "category").distinct().orderBy(
        "feature", "category"
    )


def corr_to_target(spark, sf_dir):
    table, names = eda.correlation_inputs(_raw(spark, sf_dir))
    return digits(eda.strongest(eda.corr_to_target(table, names), PARAMS.top_correlations))


def topk_abs_corr(spark, sf_dir):
    table, names = eda.correlation_inputs(_raw(spark, sf_dir))
    top = eda.strongest(eda.corr_to_target(table, names), PARAMS.top_correlations)
    return digits(eda.in_group_order(top).orderBy("place"))


def group_columns(spark, sf_dir):
    """Groups by working name beside groups by display name; the latter are all Other."""
    table, names = eda.correlation_inputs(_raw(spark, sf_dir))
    corr = eda.corr_to_target(table, {c: c for c in names}).drop("strength")
    labels = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return digits(
        corr.select(
            "feature", "r", eda.group_name(F.col("feature")).alias("group_by_column"),
            eda.group_name(labels[F.col("feature")]).alias("group_by_label"),
        )
    )


def corr_matrix(spark, sf_dir):
    table, names = eda.correlation_inputs(_raw(spark, sf_dir))
    return digits(eda.corr_matrix(table, names, PARAMS.top_correlations))


def box_stats(spark, sf_dir):
    return digits(eda.box_stats(_raw(spark, sf_dir)))


def box_outliers(spark, sf_dir):
    return digits(eda.box_outliers(_raw(spark, sf_dir)))


def kde_by_class(spark, sf_dir):
    curve = eda.kde_by_class(_raw(spark, sf_dir))
    return curve.select("feature", "risk", "point", (F.round("x", 6) + 0.0).alias("x"),
                        F.round("density", 10).alias("density"))


def qq_normal(spark, sf_dir):
    return digits(eda.qq_points(_raw(spark, sf_dir)))


def qq_fit(spark, sf_dir):
    return digits(eda.qq_line(eda.qq_points(_raw(spark, sf_dir))))


def no_skill_rate(spark, sf_dir):
    return digits(evaluate.no_skill_rate(_split(spark, sf_dir).where("part = 'test'"), "Target"))


# --- model inputs ---------------------------------------------------------------------

_cache: dict = {}


def _once(name: str, spark: SparkSession, sf_dir: str, build: Callable):
    """Fits are shared by the queries of one session that report on them."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _cache:
        _cache[key] = build()
    return _cache[key]


def _prepared(spark, sf_dir) -> prepare.Prepared:
    return _once("prepared", spark, sf_dir, lambda: prepare.prepare(_raw(spark, sf_dir), PARAMS))


def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir)


def stratified_folds(spark, sf_dir):
    train = _split(spark, sf_dir).where("part = 'train'").drop("part")
    return prepare.stratified_folds(train, PARAMS.folds, PARAMS.seed)


def _filled(spark, sf_dir) -> tuple[DataFrame, dict[str, float]]:
    """All model inputs of both parts, and what stands for their missing values."""
    data = prepare.encode(_raw(spark, sf_dir))
    split = prepare.stratified_split(prepare.labelled_rows(data), PARAMS.test_fraction, PARAMS.seed)
    return split, prepare.fit_fill(split.where("part = 'train'"), data.inputs)


def standardize(spark, sf_dir):
    """Every input, through the scaler that the models use."""
    split, fill = _filled(spark, sf_dir)
    rows = prepare.packed(split, fill, keep=(cat.KEY, "Target", "part"))
    scaled = prepare.fit_vector_scaler(rows.where("part = 'train'")).transform(rows)
    values = scaled.select(cat.KEY, "Target", "part", vector_to_array("scaled").alias("x"))
    return digits(values.select(cat.KEY, "Target", "part", *[F.col("x")[i].alias(c) for i, c in enumerate(fill)]))


def minmax_scale(spark, sf_dir):
    split, fill = _filled(spark, sf_dir)
    rows = split.select(cat.KEY, "Target", "part", *[F.coalesce(q(c).cast("double"), F.lit(v)).alias(c) for c, v in fill.items()])
    return digits(prepare.fit_minmax(rows.where("part = 'train'"), list(fill)).transform(rows))


def _pcs(scored: DataFrame, k: int | None = None) -> DataFrame:
    values = vector_to_array("pca")
    return scored.select(cat.KEY, "Target", F.slice(values, 1, k).alias("pca") if k else values.alias("pca"))


def pca_full(spark, sf_dir):
    fitted = _prepared(spark, sf_dir).components
    return digits(prepare.cumulative_variance(spark, fitted).drop("cumulative"))


def cum_variance(spark, sf_dir):
    fitted = _prepared(spark, sf_dir).components
    return digits(prepare.cumulative_variance(spark, fitted))


def n_components_95(spark, sf_dir):
    spectrum = prepare.cumulative_variance(spark, _prepared(spark, sf_dir).components)
    reached = F.min(F.when(F.col("cumulative") >= PARAMS.variance_kept, F.col("component")))
    return spectrum.agg(F.coalesce(reached, F.max("component")).alias("n_components"))


def pca_spectrum(spark, sf_dir):
    """Power sums of the explained shares: SQL gets the same ones from the correlations."""
    ratio = F.col("ratio")
    powers = [F.sum(F.pow(ratio, F.lit(p))).alias(f"power_{p}") for p in (1, 2, 3, 4)]
    shares = prepare.cumulative_variance(spark, _prepared(spark, sf_dir).components)
    return digits(shares.agg(F.count("*").alias("components"), *powers))


def pca_k(spark, sf_dir):
    ready = _prepared(spark, sf_dir)
    train = _pcs(ready.train).withColumn("part", F.lit("train"))
    return train.unionByName(_pcs(ready.test).withColumn("part", F.lit("test")))


def pca_loadings(spark, sf_dir):
    """What each input adds to each kept component: the fitted matrix, which has no rows of data.

    Four places, as rounding errors grow between components of nearly one variance.
    """
    ready = _prepared(spark, sf_dir)
    matrix = ready.components.loadings[:, : ready.kept]
    rows = [(name, c + 1, float(v)) for name, row in zip(ready.inputs, matrix) for c, v in enumerate(row)]
    return digits(spark.createDataFrame(rows, "input string, component int, loading double"), 4)


def pca_moments(spark, sf_dir):
    """Each kept component over the training rows and over the test rows."""
    rows = pca_k(spark, sf_dir).select("part", F.posexplode("pca").alias("at", "value"))
    value = F.col("value")
    return digits(rows.groupBy("part", (F.col("at") + 1).alias("component")).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.avg(value * value).alias("square"), F.avg(F.abs(value)).alias("size"),
    ))


def pca_2d(spark, sf_dir):
    rows = _pcs(_prepared(spark, sf_dir).train, 2)
    return digits(rows.select(
        cat.KEY, F.col("pca")[0].alias("pc1"), F.col("pca")[1].alias("pc2"),
        F.when(F.col("Target") == 1, "Good").otherwise("Bad").alias("risk"),
    ))


def _points(spark, sf_dir, vectors: str = "pca") -> DataFrame:
    return _prepared(spark, sf_dir).train.select(
        F.col(cat.KEY).alias("id"), "Target", "scaled", vector_to_array(vectors).alias("x")
    )


def undersample_centroids(spark, sf_dir):
    return resample.undersample_centroids(_points(spark, sf_dir), seed=PARAMS.seed)


def smote(spark, sf_dir):
    """On amount and duration, so that SQL can search the same neighbours."""
    train = _split(spark, sf_dir, cat.AMOUNT, cat.DURATION).where("part = 'train'")
    points = train.select(
        F.col(cat.KEY).alias("id"), "Target",
        F.array(q(cat.AMOUNT).cast("double"), q(cat.DURATION).cast("double")).alias("x"),
    )
    made = resample.smote(points, k=PARAMS.smote_neighbours, seed=PARAMS.seed)
    return digits(
        made.select("Target", "id", "copy", F.col("x")[0].alias("amount"), F.col("x")[1].alias("duration"))
    )


def smote_inputs(spark, sf_dir):
    """On all inputs, each brought to [0, 1]."""
    split, fill = _filled(spark, sf_dir)
    train = split.where("part = 'train'").select(
        cat.KEY, "Target", *[F.coalesce(q(c).cast("double"), F.lit(v)).alias(c) for c, v in fill.items()]
    )
    scaled = prepare.fit_minmax(train, list(fill)).transform(train)
    points = scaled.select(F.col(cat.KEY).alias("id"), "Target", F.array(*[q(c) for c in fill]).alias("x"))
    # read by every step of the search
    made = resample.smote(settle(points, "id"), k=PARAMS.smote_neighbours, seed=PARAMS.seed)
    return digits(made.select("Target", "id", "copy", *[F.col("x")[i].alias(c) for i, c in enumerate(fill)]))


def smote_components(spark, sf_dir):
    return resample.smote(_points(spark, sf_dir), k=PARAMS.smote_neighbours, seed=PARAMS.seed)


def kmeans_smote(spark, sf_dir):
    return resample.cluster_smote(
        _points(spark, sf_dir, "scaled"), "scaled", clusters=PARAMS.cluster_smote_clusters,
        k=PARAMS.cluster_smote_neighbours, threshold=PARAMS.cluster_smote_threshold, seed=PARAMS.seed,
    )


def kmeans_smote_balanced(spark, sf_dir):
    """With the threshold that follows from the class balance."""
    return resample.cluster_smote(
        _points(spark, sf_dir, "scaled"), "scaled", clusters=PARAMS.cluster_smote_clusters,
        k=PARAMS.cluster_smote_neighbours, threshold=None, seed=PARAMS.seed,
    )


def class_counts_resampled(spark, sf_dir):
    return resample.method_counts(_points(spark, sf_dir), PARAMS)


# --- models ---------------------------------------------------------------------------


def _training(spark, sf_dir) -> DataFrame:
    return _prepared(spark, sf_dir).train.select(cat.KEY, "Target", "fold", "pca")


def _searched(spark, sf_dir, name: str) -> models.Fitted:
    """A family searched over its whole grid; the SVM's kernels are searched in turn."""

    def build() -> models.Fitted:
        family, _, kernel = name.partition(" ")
        grid = dict(models.GRIDS[family])
        if kernel:
            grid["kernel"] = [kernel]
        elif "kernel" in grid:
            return models.best_of([_searched(spark, sf_dir, f"{name} {k}") for k in grid["kernel"]])
        return models.search(family, _training(spark, sf_dir), PARAMS, grid)

    return _once(f"search {name}", spark, sf_dir, build)


_SEARCHES = {"logreg": "LogisticRegression", "random_forest": "RandomForest", "svm_linear": "SVM linear", "svm_rbf": "SVM rbf"}


def classify(name, spark, sf_dir):
    return _searched(spark, sf_dir, _SEARCHES[name]).predict(_prepared(spark, sf_dir).test)


def _best(spark, sf_dir) -> list[models.Fitted]:
    return [_searched(spark, sf_dir, name) for name in models.GRIDS]


def grid_search_cv(spark, sf_dir):
    return models.cv_scores(spark, _best(spark, sf_dir))


def predict(spark, sf_dir):
    return models.predictions(_best(spark, sf_dir), _prepared(spark, sf_dir).test)


def logreg_checked(spark, sf_dir):
    """Whether the searched logistic model scores every test row once, with a probability."""
    score = F.col("score")
    return classify("logreg", spark, sf_dir).groupBy("model").agg(
        F.count("*").alias("n"), F.countDistinct(cat.KEY).alias("n_keys"), F.sum("label").cast("bigint").alias("n_good"),
        F.count_if(score.between(0, 1)).alias("n_probabilities"), F.count_if(F.col("prediction").isin(0, 1)).alias("n_classes"),
    )


def logreg_weights(spark, sf_dir):
    """Of the logistic model on amount and duration alone, at every cost: SQL solves the same steps."""
    columns = [cat.AMOUNT, cat.DURATION]
    train = _split(spark, sf_dir, *columns).where("part = 'train'")
    train = train.select("Target", *[q(c).cast("double").alias(c) for c in columns])
    scaled = prepare.fit_minmax(train, columns).transform(train)
    rows = scaled.select(F.array(*[q(c) for c in columns]).alias("x"), F.col("Target").cast("double").alias("y"), F.lit(0).alias("fold"))
    costs = [float(c) for c in cat.GRID_LOGREG["C"]]
    fitted = linear.fit_states(settle(rows, "y"), "logreg", costs, [models.ALL], len(columns))
    found = [(c, *map(float, fitted.of(models.ALL, c))) for c in costs]
    return digits(spark.createDataFrame(found, "cost double, amount double, duration double, intercept double"))


def confusion_matrix_fitted(spark, sf_dir):
    """Of each family's best model on the test rows."""
    return evaluate.confusion_matrix(predict(spark, sf_dir), ["model"])


def pr_curve_fitted(spark, sf_dir):
    return digits(evaluate.pr_curve(predict(spark, sf_dir), ["model"]))


def _summary(spark, sf_dir) -> DataFrame:
    fits = _best(spark, sf_dir)
    return models.model_summary(fits, models.predictions(fits, _prepared(spark, sf_dir).test))


def sink_model_summary(spark, sf_dir):
    path = scratch_path(spark, "model-summary")
    summary = _summary(spark, sf_dir)
    writers.write_csv(summary, path)
    return readers.read_csv(spark, path, summary.schema)


def model_compare(spark, sf_dir):
    return _summary(spark, sf_dir).select("model", "f1")


def rf_importances(spark, sf_dir):
    return models.forest_importances(_searched(spark, sf_dir, "RandomForest"), spark)


def sink_importances(spark, sf_dir):
    path = scratch_path(spark, "importances")
    rows = rf_importances(spark, sf_dir)
    writers.write_csv(rows, path)
    return readers.read_csv(spark, path, rows.schema)


# --- measures of a given score --------------------------------------------------------


def _scored(spark, sf_dir) -> DataFrame:
    """A score fixed by the row's key: whether measures are right needs no model."""
    rows = _raw(spark, sf_dir).selectExpr(cat.KEY, f"int({cat.LABEL} = 1) as label")
    score = ((F.col(cat.KEY) * 7919) % 97 + 40 * F.col("label")) / F.lit(137.0)
    return rows.withColumn("score", score).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_scored(spark, sf_dir))


def metrics_prf(spark, sf_dir):
    return digits(evaluate.metrics_prf(_scored(spark, sf_dir)))


def pr_curve(spark, sf_dir):
    return digits(evaluate.pr_curve(_scored(spark, sf_dir)))


def pr_auc(spark, sf_dir):
    return digits(evaluate.pr_auc(_scored(spark, sf_dir)))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (
        scan_raw, scan_csv, scan_table, scan_colmap_json, scan_colmap_table, sink_csv, sink_table,
        view_ddl, preview, profile_shape,
        project_raw, project_dup, rename_map, ratio_safe, bucket_age, flag_age,
    )}
    found |= {f"decode_{name}": partial(decode, name) for name in cat.BY_NAME}
    found |= {f"flag_{name}": partial(flag, name) for name in cat.BY_NAME}
    found["features_view"] = _view
    found |= {f.__name__: f for f in (
        map_values, target_encode, fill_unknown, sex_from_status, drop_if_exists, select_numeric,
        one_hot_drop_first, round2, group_columns,
        describe_numeric, describe_inputs, class_balance, class_counts_split, class_counts_resampled,
        category_risk_counts, crosstab_pct, corr_to_target, corr_matrix, box_stats, box_outliers,
        kde_by_class, qq_normal, qq_fit, no_skill_rate,
        sort_categories, topk_abs_corr, cum_variance, n_components_95,
        stratified_split, stratified_folds,
    )}
    found |= {f.__name__: f for f in (
        standardize, minmax_scale, pca_full, pca_spectrum, pca_k, pca_loadings, pca_moments, pca_2d, undersample_centroids,
        smote, smote_inputs, smote_components, kmeans_smote, kmeans_smote_balanced,
    )}
    found |= {name: partial(classify, name) for name in _SEARCHES}
    found |= {f.__name__: f for f in (
        grid_search_cv, predict, confusion_matrix_fitted, pr_curve_fitted, logreg_checked, logreg_weights, metrics_prf, pr_curve, pr_auc, confusion_matrix,
        model_compare, rf_importances, sink_importances, sink_model_summary,
    )}
    found["sort_importances"] = rf_importances
    return found
