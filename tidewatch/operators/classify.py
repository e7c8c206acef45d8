"""Classifiers on feature columns: forests, boosting, importance and probabilities; a regression forest.

A tree tells at most ``BINS`` stretches of a feature apart. Beyond ``SINGLE_ROWS`` rows a fit cuts wide features at their
quantiles first, in the fitted pipeline too, and takes rows of equal bins and label as one row with their number as weight.
Regression takes rows of equal bins as one, with their mean.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from math import ceil, inf, isfinite, nextafter

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import materialise, spread


#: Stretches of a feature that a tree tells apart, as many as Spark's trees by default.
BINS = 32
#: Up to so many rows a fit takes them one by one.
SINGLE_ROWS = 1 << 20


def _written(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The rows a fit reads again at every level and round, worked out once, in files enough for all cores."""
    return materialise(spread(df.select(*features, label)), "training-rows")


def _edges(quantiles: Sequence[float]) -> list[float]:
    """Ends of the bins; a value that several quantiles share gets a bin of its own."""
    found = {q for q in quantiles if isfinite(q)}
    found |= {nextafter(q, inf) for q, n in Counter(quantiles).items() if n > 1 and isfinite(q)}
    return [-inf, *sorted(found), inf]


def _bins(rows: DataFrame, features: Sequence[str], most: int = 2 * BINS) -> Bucketizer | None:
    """Bins for the features of more than ``most`` values, far more than a tree tells apart; None where no feature has."""
    values = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    wide = [c for c in features if values[c] > most]
    if not wide:
        return None
    cuts = rows.approxQuantile(wide, [k / BINS for k in range(1, BINS)], 0.001)
    return Bucketizer(inputCols=wide, outputCols=[f"_bin_{c}" for c in wide], splitsArray=[_edges(q) for q in cuts], handleInvalid="keep")


def _grouped(rows: DataFrame, columns: Sequence[str], label: str, most: int | None) -> DataFrame:
    """One row for all of equal ``columns`` and label, ``_weight`` of them; in even parts of at most ``most`` where given."""
    groups = rows.groupBy(*columns, label).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    return materialise(spread(groups if most is None else _parts(groups, most)), "training-groups")


def _parts(groups: DataFrame, most: int) -> DataFrame:
    """Groups in even parts that stand for at most ``most`` rows."""
    parts = F.ceil(F.col("_weight") / most).cast("int")
    cut = groups.withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(1), "_parts")))
    return cut.withColumn("_weight", F.col("_weight") / F.col("_parts")).drop("_parts", "_part")


def _mean_groups(rows: DataFrame, columns: Sequence[str], target: str, most: int) -> DataFrame:
    """One row for all of equal ``columns``: their mean ``target`` and ``_weight`` of them, in even parts of at most ``most``.

    No cut between bins parts such rows, so what a cut gains in variance is the same for their mean. Dealt over the cores
    and no further: at every level each task of a fit gives sums for all nodes of all trees. A target that is missing
    stays missing, for the fit to refuse.
    """
    mean = F.when(F.count(target) == F.count(F.lit(1)), F.avg(target)).alias(target)
    groups = rows.groupBy(*columns).agg(mean, F.count(F.lit(1)).cast("double").alias("_weight"))
    return materialise(_parts(groups, most).repartition(rows.sparkSession.sparkContext.defaultParallelism), "training-groups")


def _fit(df: DataFrame, features: Sequence[str], label: str, classifier, bootstrap: bool) -> PipelineModel:
    """The fitted pipeline; weights mean the same to it as rows, so groups cost it nothing but what a tree cannot see.

    A bootstrap draws whole rows: groups are cut there into parts that stand for at most one ``SINGLE_ROWS``-th of all rows.
    """
    rows = _written(df, features, label)
    total = rows.count()
    if total <= SINGLE_ROWS:
        return Pipeline(stages=[_assembler(features), classifier]).fit(rows)
    bins = _bins(rows, features)
    own = {} if bins is None else dict(zip(bins.getInputCols(), bins.getOutputCols(), strict=True))
    columns = [own.get(c, c) for c in features]
    groups = _grouped(rows if bins is None else bins.transform(rows), columns, label, ceil(total / SINGLE_ROWS) if bootstrap else None)
    fitted = Pipeline(stages=[_assembler(columns), classifier.setWeightCol("_weight")]).fit(groups)
    return PipelineModel([*([] if bins is None else [bins]), *fitted.stages])


def fit_mean_forest(
    df: DataFrame, features: Sequence[str], target: str, out: str, trees: int = 100, depth: int = 10, seed: int = 42,
) -> PipelineModel:
    """Regression forest on feature columns; ``out`` holds its prediction.

    Rows remember their nodes: a level does not walk down from the roots again. As in ``_fit``, the bootstrap of many rows
    draws parts of groups that stand for at most one ``SINGLE_ROWS``-th of them.
    """
    forest = RandomForestRegressor(
        featuresCol="_features", labelCol=target, predictionCol=out, numTrees=trees, maxDepth=depth, seed=seed,
        cacheNodeIds=True, checkpointInterval=-1,
    )
    rows = _written(df, features, target)
    total = rows.count()
    if total <= SINGLE_ROWS:
        return Pipeline(stages=[_assembler(features), forest]).fit(rows)
    bins = _bins(rows, features, BINS)
    own = {} if bins is None else dict(zip(bins.getInputCols(), bins.getOutputCols(), strict=True))
    columns = [own.get(c, c) for c in features]
    groups = _mean_groups(rows if bins is None else bins.transform(rows), columns, target, ceil(total / SINGLE_ROWS))
    fitted = Pipeline(stages=[_assembler(columns), forest.setWeightCol("_weight")]).fit(groups)
    return PipelineModel([*([] if bins is None else [bins]), *fitted.stages])


def mean_prediction(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the prediction of a ``fit_mean_forest``. Where it has bins, trees see nothing else: what they say of
    equal bins is worked out once and joined to all rows of these."""
    bins = next((stage for stage in model.stages if isinstance(stage, Bucketizer)), None)
    if bins is None:
        return model.transform(spread(df))
    rows = materialise(bins.transform(df), "binned-rows")
    columns, out = model.stages[1].getInputCols(), model.stages[-1].getPredictionCol()
    told = PipelineModel(model.stages[1:]).transform(spread(rows.select(*columns).distinct()))
    told = materialise(told.select(*[F.col(c).alias(f"_of_{c}") for c in columns], out), "told-bins")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns]
    return rows.join(told, same, "left").drop(*[f"_of_{c}" for c in columns], *bins.getOutputCols())


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")


def fit_random_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """Binary or multiclass forest; ``label`` holds class numbers."""
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol=label, probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class",
        numTrees=trees, maxDepth=depth, seed=seed,
    )
    return _fit(df, features, label, forest, bootstrap=True)


def fit_boosting(df: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 5, rate: float = 0.1, seed: int = 42) -> PipelineModel:
    boosting = GBTClassifier(
        featuresCol="_features", labelCol=label, predictionCol="_class", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed
    )
    boosting.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    return _fit(df, features, label, boosting, bootstrap=False)


def positive_probability(model: PipelineModel, df: DataFrame, out: str = "probability") -> DataFrame:
    rows = model.transform(df).withColumn(out, vector_to_array("_probability")[1])
    bins = [c for stage in model.stages if isinstance(stage, Bucketizer) for c in stage.getOutputCols()]
    return rows.drop("_features", "_raw", "_probability", "_class", *bins)


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """One row per feature: name, importance, rank. Bounded by the number of features."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    ranked = sorted(zip(features, weights), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(n, float(w), i + 1) for i, (n, w) in enumerate(ranked)], "feature string, importance double, rank int")


def fit_cause_classifier(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """Multiclass forest on a text label, giving the label back as text."""
    df = _written(df, features, label)
    indexer = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep")
    classes = indexer.fit(df)
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class",
        numTrees=trees, maxDepth=depth, seed=seed,
    )
    names = IndexToString(inputCol="_class", outputCol="predicted_cause", labels=classes.labels)
    return Pipeline(stages=[_assembler(features), forest, names]).fit(classes.transform(df))


def best_class(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted class and its probability."""
    rows = model.transform(df).withColumn("confidence", F.array_max(vector_to_array("_probability")))
    return rows.drop("_features", "_raw", "_probability", "_class")


def ranked_classes(probabilities: Column, labels: Sequence[str], k: int) -> Column:
    """The k most probable class names, best first."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("p"), i.alias("i")))
    names = F.array(*[F.lit(x) for x in labels])
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda x: names[x["i"]])
