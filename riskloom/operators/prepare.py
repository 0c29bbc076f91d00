"""Model inputs: cleaning, split, scaling, principal components, folds."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import (
    PCA, ElementwiseProduct, PCAModel, StandardScaler, StandardScalerModel, VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom import catalog as cat
from riskloom.functions import codes
from riskloom.functions.codes import q
from riskloom.functions.hashing import hash_key
from riskloom.operators.features import (
    categories, feature_view, fill_unknown, numeric_columns, one_hot, with_sex, with_target,
)
from riskloom.operators.ordering import fit_hash_cuts
from riskloom.operators.quantiles import numeric_summary
from riskloom.session import settle

LABEL_DERIVED = (cat.LABEL, "risk")


# --- cleaning and encoding ------------------------------------------------------------


@dataclass(frozen=True)
class Encoded:
    """An encoded table and the names of its input columns, without key and Target."""

    table: DataFrame
    inputs: list[str]


def encode(raw: DataFrame, leak_guard: bool = True, key: str = cat.KEY) -> Encoded:
    """Clean and encode applications for modelling.

    By default the inputs are the numbers, the flags and Sex. A flag already holds what
    its raw code and its text hold, and nothing is derived from the label. With the guard
    off, raw codes and texts are encoded too and the label stays among the inputs under
    two names; results on such inputs measure the leak.
    """
    view = with_sex(with_target(fill_unknown(feature_view(raw, keep=(key,)))))
    if leak_guard:
        repeats = [cat.repeat_name(c) for c in cat.REPEATED]
        inputs = [
            c for c in numeric_columns(view)
            if c not in (key, "Target", *LABEL_DERIVED, *repeats)
        ]
        return Encoded(view.select(q(key), "Target", *[q(c) for c in inputs]), inputs)
    named = view.withColumn("risk", codes.risk_name())
    texts = [f.name for f in named.schema if f.dataType.typeName() == "string"]
    table = one_hot(named, texts, categories(named, texts))
    return Encoded(table, [c for c in table.columns if c not in (key, "Target")])


def labelled_rows(data: Encoded, key: str = cat.KEY) -> DataFrame:
    """The encoded rows that have a label, written once.

    Split, medians, scalers and the queries read them in turn, most of them a column or two;
    from the raw table each would join and decode it again.
    """
    return settle(data.table.where(F.col("Target").isNotNull()), key)


# --- split and folds ------------------------------------------------------------------


def stratified_split(
    df: DataFrame, test_fraction: float = 0.2, seed: int = 42,
    label: str = "Target", key: str = cat.KEY, name: str = "part",
) -> DataFrame:
    """Mark each row ``test`` or ``train``, with exact shares in every class.

    Rows are ordered by a hash of their key, so the split does not depend on layout. Once
    the cut digests are found, marking is a projection.
    """
    digest = hash_key(seed, "split", q(key))
    cuts = fit_hash_cuts(df, label, digest, [lambda size, _: math.floor(size * test_fraction + 0.5)])
    return df.withColumn(name, F.when(cuts.above(digest) == 0, "test").otherwise("train"))


def stratified_folds(
    df: DataFrame, folds: int = 5, seed: int = 42,
    label: str = "Target", key: str = cat.KEY, name: str = "fold",
) -> DataFrame:
    """Number each row with a fold; the folds of a class differ by one row at most."""
    digest = hash_key(seed, "fold", q(key))
    ranks = [lambda size, _, i=i: size * i // folds for i in range(1, folds)]
    cuts = fit_hash_cuts(df, label, digest, ranks)
    return df.withColumn(name, cuts.above(digest).cast("int"))


# --- scaling --------------------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """(value - shift) / scale per column; a column that does not vary becomes 0."""

    shift: Mapping[str, float]
    scale: Mapping[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.selectExpr(
            *[
                f"(double(`{c}`) - {self.shift[c]!r}D) / {self.scale[c] or 1.0!r}D as `{c}`"
                if c in self.shift else f"`{c}`"
                for c in df.columns
            ]
        )


def _one_row(df: DataFrame, columns: Sequence[str], *functions: str) -> list[dict[str, float]]:
    """Each aggregate of each column, in one pass; columns without a value get 0."""
    row = df.selectExpr(
        *[f"{f}(`{c}`)" for f in functions for c in columns]
    ).first()
    size = len(columns)
    return [
        {c: float(row[k * size + i] or 0.0) for i, c in enumerate(columns)}
        for k in range(len(functions))
    ]


def fit_standard(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean 0 and population deviation 1 on the training rows."""
    mean, sd = _one_row(train, columns, "avg", "stddev_pop")
    # a constant column may show rounding noise for a deviation
    return Scaler(mean, {c: sd[c] if sd[c] > 1e-12 * abs(mean[c]) else 0.0 for c in columns})


def fit_minmax(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """The training rows to [0, 1]; other rows may leave it."""
    low, high = _one_row(train, columns, "min", "max")
    return Scaler(low, {c: high[c] - low[c] for c in columns})


def fit_fill(train: DataFrame, columns: Sequence[str], medians: Sequence[str] = (cat.AGE,)) -> dict[str, float]:
    """What to put for missing inputs: the training median of the named columns, else 0."""
    wanted = [c for c in columns if c in medians]
    fill = {c: 0.0 for c in columns}
    if wanted:
        for row in numeric_summary(train, wanted, probs=[0.5]).collect():
            fill[row["feature"]] = row["quantiles"][0]
    return fill


def packed(df: DataFrame, fill: Mapping[str, float], keep: Sequence[str] = (), name: str = "raw") -> DataFrame:
    """The filled inputs as one vector beside the kept columns, in one projection."""
    plain = df.selectExpr(
        *[f"`{k}`" for k in keep],
        *[f"coalesce(double(`{c}`), {v!r}D) as v{i}" for i, (c, v) in enumerate(fill.items())],
    )
    assembler = VectorAssembler(inputCols=[f"v{i}" for i in range(len(fill))], outputCol=name)
    return assembler.transform(plain).select(*[q(k) for k in keep], name)


@dataclass(frozen=True)
class VectorScaler:
    """Standardisation of whole vectors by the population deviation."""

    model: StandardScalerModel
    factor: float

    def transform(self, df: DataFrame) -> DataFrame:
        size = len(self.model.mean)
        by_sample = self.model.transform(df)
        widen = ElementwiseProduct(
            scalingVec=[self.factor] * size, inputCol="__sample", outputCol="scaled"
        )
        return widen.transform(by_sample).drop("__sample")


def fit_vector_scaler(train: DataFrame, name: str = "raw") -> VectorScaler:
    """Mean 0 and population deviation 1; the library scaler divides by the sample one."""
    model = StandardScaler(withMean=True, withStd=True, inputCol=name, outputCol="__sample").fit(train)
    n = train.count()
    return VectorScaler(model, (n / (n - 1)) ** 0.5 if n > 1 else 1.0)


# --- principal components -------------------------------------------------------------


@dataclass(frozen=True)
class Components:
    """Fitted components; the sign of each makes its largest loading positive, of equal ones the first."""

    model: PCAModel
    signs: list[float] = field(repr=False)
    source: str = "scaled"

    @property
    def ratios(self) -> list[float]:
        return [float(x) for x in self.model.explainedVariance.toArray()]

    @property
    def loadings(self) -> np.ndarray:
        """Inputs by components, with the signs of the scores."""
        return self.model.pc.toArray() * np.array(self.signs)

    def kept(self, share: float) -> int:
        """The fewest components that explain ``share`` of the variance, else all."""
        total = np.cumsum(self.ratios)
        reached = np.flatnonzero(total >= share)
        return int(reached[0]) + 1 if len(reached) else len(total)

    def transform(self, df: DataFrame, k: int, name: str = "pca") -> DataFrame:
        """Scores of the first k components, as a vector."""
        scores = self.model.transform(df)
        signed = ElementwiseProduct(
            scalingVec=self.signs, inputCol=self.model.getOutputCol(), outputCol="__signed"
        ).transform(scores)
        first = VectorSlicer(inputCol="__signed", outputCol=name, indices=list(range(k)))
        return first.transform(signed).drop("__signed", self.model.getOutputCol())


def fit_components(train: DataFrame, size: int, source: str = "scaled") -> Components:
    """All components of the training rows, from one pass that sums a size x size matrix.

    One fit serves the full spectrum, the kept components and the two-dimensional view.
    """
    model = PCA(k=size, inputCol=source, outputCol="__pca").fit(train)
    loadings = model.pc.toArray()
    # complementary flags load alike but for the sign: the first of the largest decides
    size_of = np.abs(loadings)
    peak = loadings[(size_of >= size_of.max(0) - 1e-9).argmax(0), np.arange(loadings.shape[1])]
    return Components(model, [1.0 if p >= 0 else -1.0 for p in peak], source)


def cumulative_variance(spark: SparkSession, components: Components) -> DataFrame:
    """(component, ratio, cumulative), one row per component."""
    rows = spark.createDataFrame(
        [(i + 1, r) for i, r in enumerate(components.ratios)], "component int, ratio double"
    )
    so_far = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("cumulative", F.sum("ratio").over(so_far))


# --- the prepared data ----------------------------------------------------------------


@dataclass(frozen=True)
class Prepared:
    """Keyed vectors of train and test rows with everything fitted on the way."""

    train: DataFrame  # key, Target, fold, scaled, pca
    test: DataFrame  # key, Target, scaled, pca
    inputs: list[str]
    scaler: VectorScaler
    components: Components
    kept: int


def prepare(raw: DataFrame, params, key: str = cat.KEY, encoded: Encoded | None = None) -> Prepared:
    """Encode, split, fill, standardise and project. Everything is fitted on train rows."""
    data = encode(raw, params.leak_guard, key) if encoded is None else encoded
    split = stratified_split(labelled_rows(data, key), params.test_fraction, params.seed, key=key)
    train = split.where("part = 'train'")
    fill = fit_fill(train, data.inputs)
    # from here on rows are a key, a label and a vector; they are written once, since every
    # later fit reads them
    rows = settle(packed(split, fill, keep=(key, "Target", "part")), key)
    train, test = rows.where("part = 'train'").drop("part"), rows.where("part = 'test'").drop("part")
    scaler = fit_vector_scaler(train)
    scaled = scaler.transform(train).drop("raw")
    components = fit_components(scaled, len(data.inputs))
    kept = components.kept(params.variance_kept)
    folded = stratified_folds(scaled, params.folds, params.seed, key=key)
    return Prepared(
        components.transform(folded, kept),
        components.transform(scaler.transform(test).drop("raw"), kept),
        data.inputs, scaler, components, kept,
    )
