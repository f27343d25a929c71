"""Classifiers on time folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.operators.quality import require_columns
from backglance.sources.tables import Scratch

# The grids of the four classifiers, and the iteration counts of those that end by them.
LOGISTIC_ITERATIONS = 5
BOOSTING_DEPTHS = (1, 5, 10)
BOOSTING_FOLD_ITERATIONS, BOOSTING_FINAL_ITERATIONS = 3, 10
BAYES_SMOOTHING = (0.5, 1.0, 1.5)
SVM_REGULARISATION = (0.0, 0.5, 0.8)
# The solver ends by its tolerance; this is the largest count it takes.
SVM_ITERATIONS = 2**31 - 1


def logistic() -> LogisticRegression:
    return LogisticRegression(maxIter=LOGISTIC_ITERATIONS)


def boosted_trees(depth: int, final: bool = False) -> GBTClassifier:
    iterations = BOOSTING_FINAL_ITERATIONS if final else BOOSTING_FOLD_ITERATIONS
    return GBTClassifier(maxIter=iterations, maxDepth=int(depth), seed=48)


def bayes(smoothing: float, final: bool = False) -> NaiveBayes:
    return NaiveBayes(modelType="gaussian", smoothing=smoothing)


def svm(regularisation: float, final: bool = False) -> LinearSVC:
    """Fitted until it has converged, on folds and at last; every step reads all training rows."""
    return LinearSVC(maxIter=SVM_ITERATIONS, regParam=regularisation)


def area_under_pr_of(predictions: DataFrame) -> float:
    """Exact: every distinct score is a point of the curve."""
    return BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(predictions)


def counted_rows(df: DataFrame, columns: Sequence[str], weight: str = "weight") -> DataFrame:
    """Each distinct row of ``columns`` once, with its number as ``weight``, in one partition.

    For columns of few values by their making: a weighted fit on these rows has the loss of one on all
    rows, and each of its steps reads only them.
    """
    require_columns(df, columns)
    return df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(weight)).coalesce(1)


def fit_score(estimator: Estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows with ``rawPrediction`` and ``prediction``."""
    return estimator.fit(train).transform(test)


def cross_validate(
    folded: DataFrame, build: Callable[[float], Estimator], parameters: Sequence[float], parallelism: int = 3
) -> DataFrame:
    """(parameter, fold, area_under_pr): every parameter on every fold.

    ``folded`` has ``features``, ``label``, ``fold`` and ``part`` from ``blocked_folds``.
    ``parallelism`` fits run at the same time, so that small stages do not leave executors idle.
    The folds are written once, a folder for each part of a fold, so a fit reads its own rows only
    and a lost executor takes nothing with it; the files go when all scores are known.
    """
    spark = folded.sparkSession

    def score(task: tuple[int, float]) -> tuple[float, int, float]:
        fold, parameter = task
        block = blocks.where(F.col("fold") == fold)
        train, test = block.where(F.col("part") == "train"), block.where(F.col("part") == "test")
        area = area_under_pr_of(fit_score(build(parameter), train, test))
        return float(parameter), int(fold), float(area)

    with Scratch(spark) as scratch:
        blocks = scratch.stage(folded.select("features", "label", "fold", "part"), partition_by=["fold", "part"])
        folds = [row["fold"] for row in blocks.select("fold").distinct().orderBy("fold").collect()]
        with ThreadPool(parallelism) as pool:
            scores = pool.map(inheritable_thread_target(spark)(score), [(f, p) for f in folds for p in parameters])
    return spark.createDataFrame(scores, "parameter double, fold int, area_under_pr double")


def mean_scores(scores: DataFrame, parameter: str = "parameter", score: str = "area_under_pr") -> DataFrame:
    return scores.groupBy(parameter).agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n_folds"))


def pick_best(means: DataFrame, parameter: str = "parameter") -> DataFrame:
    """The parameter with the best mean score; the largest parameter wins a tie."""
    best = F.max(F.struct("mean_score", parameter)).alias("best")
    return means.agg(best).select(f"best.{parameter}", "best.mean_score")


def train_best(
    folded: DataFrame,
    train: DataFrame,
    test: DataFrame,
    build: Callable[..., Estimator],
    parameters: Sequence[float],
) -> tuple[DataFrame, DataFrame]:
    """Fold scores, and the test rows scored by the best parameter fitted on all training rows."""
    scores = cross_validate(folded, build, parameters)
    best = pick_best(mean_scores(scores)).first()["parameter"]
    with Scratch(train.sparkSession) as scratch:
        model = build(best, final=True).fit(scratch.stage(train.select("features", "label")))
    return scores, model.transform(test)


CLASSIFIERS: Mapping[str, tuple[Callable[..., Estimator], Sequence[float]]] = {
    "boosted_trees": (boosted_trees, BOOSTING_DEPTHS),
    "bayes": (bayes, BAYES_SMOOTHING),
    "svm": (svm, SVM_REGULARISATION),
}
