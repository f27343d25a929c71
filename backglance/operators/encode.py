"""Model tables: categories and numbers to vectors, fitted on the training rows only.

The values of a category are counted, numbered and written once as a table; rows get their number
by a join, whatever the number of values, and Spark makes the sparse one-hot vectors from the
numbers.  The driver knows how many values a column has, not which.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.operators.positions import dense_index
from backglance.operators.quality import require_columns
from backglance.sources.tables import pin


def require_two_classes(df: DataFrame, target: str) -> None:
    if df.agg(F.count_distinct(target)).first()[0] != 2:
        raise ValueError(f"{target} must have exactly 2 classes")


def numbered_values(df: DataFrame, name: str) -> DataFrame:
    """(_value, _at): the known values of a column as text, numbered from 0 on by falling frequency, ties by value."""
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("_value"))
    counts = counts.agg((-F.count(F.lit(1))).alias("_minus"))
    return dense_index(counts, ["_minus", "_value"], "_at").select("_value", "_at")


def _with_index(df: DataFrame, name: str, values: DataFrame, last, out: str) -> DataFrame:
    """``out``: the number of the row's value, or ``last`` where the table has none for it."""
    numbered = values.select("_value", F.col("_at").cast("double").alias("_number"))
    joined = df.join(numbered, F.col(name).cast("string") == F.col("_value"), "left")
    return joined.withColumn(out, F.coalesce("_number", last)).drop("_value", "_number")


def index_categories(df: DataFrame, names: Sequence[str], suffix: str = "_index") -> DataFrame:
    """Index by falling frequency, ties by value; nulls get the index after the last value.

    The values of a column are counted, numbered and joined back, so their number has no bound.
    """
    require_columns(df, names)
    for name in names:
        values = numbered_values(df, name)
        df = _with_index(df, name, values, values.agg(F.count(F.lit(1)).cast("double")).scalar(), name + suffix)
    return df


@dataclass
class Preparation:
    """What the training rows taught: a table of numbered values and their number for every category, and the stages behind."""

    values: Mapping[str, DataFrame]
    sizes: Mapping[str, int]
    stages: PipelineModel
    suffix: str = "_index"

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with the index and one-hot vector of every category, ``raw_features`` and the scaled ``features``.

        A null or a value that the training rows do not have is all zeros in its one-hot vector.
        """
        for name, values in self.values.items():
            df = _with_index(df, name, values, F.lit(float(self.sizes[name])), name + self.suffix)
        return self.stages.transform(df)


def fit_preparation(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], suffix: str = "_index", centre: bool = False
) -> Preparation:
    """Index, one-hot, median, assemble, scale.

    ``centre`` subtracts the mean, which turns the sparse one-hot vectors dense.
    """
    numeric, categorical = list(numeric), list(categorical)
    require_columns(train, [*numeric, *categorical])
    values = {c: pin(numbered_values(train, c)) for c in categorical}
    sizes = {c: table.count() for c, table in values.items()}
    hot = [c + "_class" for c in categorical if sizes[c]]
    stages: list = []
    if hot:
        # The encoder learns nothing but the largest index, so one row with these is all it needs to see.
        known = {c + suffix: float(sizes[c] - 1) for c in categorical if sizes[c]}
        encoder = OneHotEncoder(inputCols=list(known), outputCols=hot, handleInvalid="keep")
        stages.append(encoder.fit(train.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in known.items()])))
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=numeric, strategy="median"))
    stages.append(VectorAssembler(inputCols=hot + numeric, outputCol="raw_features"))
    stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=centre, withStd=True))
    found = Preparation(values, sizes, PipelineModel([]), suffix)
    indexed = found.transform(train) if categorical else train
    found.stages = Pipeline(stages=stages).fit(indexed)
    return found


def prepare(
    train: DataFrame,
    test: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str,
    suffix: str = "_index",
    centre: bool = False,
) -> tuple[DataFrame, DataFrame, Preparation]:
    """Train and test with ``features`` and ``label`` beside the columns not used as input.

    One-hot vectors have a place for every value of a column.
    """
    numeric = [c for c in numeric if c != target]
    categorical = [c for c in categorical if c != target]
    require_columns(train, [*numeric, *categorical, target])
    require_two_classes(train, target)
    model = fit_preparation(train, numeric, categorical, suffix, centre)
    used = set(numeric) | set(categorical) | {target}
    kept = [c for c in train.columns if c not in used]

    def vectors(df: DataFrame) -> DataFrame:
        return model.transform(df).select(*kept, "features", F.col(target).cast("double").alias("label"))

    return vectors(train), vectors(test), model
