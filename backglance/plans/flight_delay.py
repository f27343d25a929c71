"""From raw flights and weather reports to scored models: will a flight leave 15 or more minutes late?

Each step is one function over DataFrames; ``run`` writes every step as Parquet and goes on from the
files, so that a step's several jobs read its input and not the raw tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.functions.text import country_code
from backglance.functions.timeops import hhmm_to_timestamp, shift_zone, time_levels, with_time_parts
from backglance.operators import (
    balance,
    encode,
    evaluate,
    impute,
    models,
    positions,
    profile,
    quality,
    select,
    splits,
    windows,
)
from backglance.operators.fields import apply_sentinels, split_packed, suffix_bucket, type_parts
from backglance.operators.joins import lookup
from backglance.operators.labels import cause_shares, derive_label
from backglance.operators.lookback import lookback_join
from backglance.operators.nearest import nearest_site
from backglance.plans import fixed_values as fixed
from backglance.sources.tables import Scratch


# Columns that later steps need, however sparse.
FLIGHT_KEYS = ("ORIGIN_CITY_NAME", "DEPARTURE_UTC", "DEPARTURE_DAY", "DEP_DEL15", "CANCELLED")
OBSERVATION_KEYS = ("CLOSEST_CITY", "DATE", "STATION")


def prepare_flights(flights: DataFrame, places: DataFrame) -> DataFrame:
    """Departure time in UTC and the place of the origin city; ``places`` has city, lat, lon and tz, city unique."""
    cleaned = quality.blank_to_null(flights)
    columns = [F.col("lat").alias("LATITUDE_ORIG"), F.col("lon").alias("LONGITUDE_ORIG"), F.col("tz").alias("TIMEZONE")]
    placed = lookup(cleaned, places, {"ORIGIN_CITY_NAME": "city"}, columns)
    scheduled = hhmm_to_timestamp(F.to_date("FL_DATE"), "CRS_DEP_TIME")
    return placed.withColumn("DEPARTURE_UTC", shift_zone(scheduled, "TIMEZONE")).withColumn(
        "DEPARTURE_DAY", F.to_date("DEPARTURE_UTC")
    )


def prepare_observations(weather: DataFrame, places: DataFrame) -> DataFrame:
    """Reports from stations in the country, each with its nearest city."""
    home = weather.where(country_code("NAME") == fixed.COUNTRY)
    located = quality.blank_to_null(home).withColumns(
        {c: F.col(c).try_cast("double") for c in ("LATITUDE", "LONGITUDE")}
    )
    return nearest_site(located, places, "LATITUDE", "LONGITUDE", "city", "lat", "lon", "CLOSEST_CITY").drop("distance_km")


def join_weather(flights: DataFrame, observations: DataFrame, same_day: bool = False) -> DataFrame:
    """Each flight once, with the latest report of its city two to four hours before departure."""
    flights = quality.drop_sparse(flights, fixed.SPARSE_BEFORE_JOIN, keep=FLIGHT_KEYS)
    observations = quality.drop_sparse(observations, fixed.SPARSE_BEFORE_JOIN, keep=OBSERVATION_KEYS)
    observations = observations.withColumn("ORIGIN_CITY_NAME", F.col("CLOSEST_CITY"))
    values = [c for c in observations.columns if c not in ("ORIGIN_CITY_NAME", "DATE", "STATION")]
    return lookback_join(
        flights,
        observations,
        ["ORIGIN_CITY_NAME"],
        "DEPARTURE_UTC",
        "DATE",
        "STATION",
        values,
        min_hours=fixed.MIN_LOOKBACK_HOURS,
        max_hours=fixed.MAX_LOOKBACK_HOURS,
        same_day=same_day,
        gap="FLIGHT_HOUR_DIFF",
    )


def add_features(joined: DataFrame, sentinels: str = "null") -> DataFrame:
    """Time and window features, decoded weather, and no column that is known only later.

    Fields that were too sparse to keep are skipped.  A column to drop that is not there is an
    error, unless it is one of ``fixed.MAY_BE_ABSENT``.
    """
    flights = with_time_parts(joined, "DEPARTURE_UTC", "HOUR", "MINUTE")
    flights = positions.rank_within(flights, ["DEPARTURE_DAY"], ["DEPARTURE_UTC"], "NTH_FLIGHTS")
    flights = windows.prior_day_total(flights, "DEPARTURE_DAY", "DEP_DEL15", "PRIOR_DAY_NUM_DELAY")
    fields = {f: len(codes) for f, codes in fixed.PACKED_FIELDS.items() if f in flights.columns}
    parts = split_packed(flights, fields)
    present = lambda names: [n for n in names if n in parts.columns]
    coded = apply_sentinels(parts, {p: c for p, c in fixed.part_codes().items() if p in parts.columns}, sentinels)
    typed = type_parts(
        coded, present(fixed.part_names(fixed.DOUBLE_PARTS)), present(fixed.part_names(fixed.INTEGER_PARTS))
    )
    return drop_known(typed, [*fixed.AFTER_DEPARTURE, *fixed.REPEATED], fixed.MAY_BE_ABSENT)


def drop_known(df: DataFrame, names: Sequence[str], may_be_absent: Sequence[str]) -> DataFrame:
    """``df`` without the columns; one that is not there has to be among those that may be absent."""
    there = {c.lower(): c for c in df.columns}  # names of columns differ in more than their case
    return quality.drop_columns(df, [there.get(n.lower(), n) for n in names if n.lower() in there or n not in may_be_absent])


def split_and_label(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train on the earlier flights, test on the later; cancelled flights count as late."""
    labelled = derive_label(features, "DEP_DEL15", "CANCELLED", "DEP_DEL15")
    return splits.time_split(labelled, ["DEPARTURE_UTC"], fixed.TRAIN_FRACTION, time_levels("DEPARTURE_UTC"))


@dataclass(frozen=True)
class Cleaning:
    """What the training rows taught: columns to drop and values to fill in."""

    sparse: list[str]
    correlated: list[str]
    uninformative: list[str]
    modes: dict[str, str]


def fit_cleaning(train: DataFrame, keep: Sequence[str] = (), label: str = "DEP_DEL15") -> Cleaning:
    """Columns and fill values measured on the training rows.

    The label, CANCELLED (which decides it) and the key columns in ``keep`` are never candidates.
    """
    keep = [*keep, "CANCELLED"]
    sparse = [c for c in quality.sparse_columns(train, fixed.SPARSE_BEFORE_MODEL) if c not in (label, *keep)]
    rest = train.drop(*sparse)
    numeric = [c for c in quality.columns_of_type(rest, "numeric") if c not in (label, *keep)]
    correlated = []
    if len(numeric) > 1:
        correlated = profile.prune_correlated(profile.correlations(rest, numeric), numeric, fixed.STRONG_CORRELATION)
    text = [c for c in quality.columns_of_type(rest, "text") if c not in keep]
    modes = impute.fit_modes(rest, text) if text else {}
    uninformative = []
    filled = _reduce_cardinality(impute.apply_values(rest, modes))
    candidates = [c for c in quality.columns_of_type(filled, "text") if c not in keep]
    if candidates:
        dependent = set(select.dependent_columns(filled, candidates, label))
        uninformative = [c for c in candidates if c not in dependent]
    return Cleaning(sparse, correlated, uninformative, modes)


def _reduce_cardinality(df: DataFrame) -> DataFrame:
    """Tail numbers to their last two characters; the station is covered by the place."""
    if "TAIL_NUM" in df.columns:
        df = suffix_bucket(df, "TAIL_NUM", 2)
    return df.drop("STATION")


def apply_cleaning(df: DataFrame, cleaning: Cleaning) -> DataFrame:
    rest = df.drop(*cleaning.sparse, *cleaning.correlated)
    filled = impute.apply_values(rest, {c: v for c, v in cleaning.modes.items() if c in rest.columns})
    return _reduce_cardinality(filled).drop(*cleaning.uninformative)


def to_vectors(
    train: DataFrame, test: DataFrame, keep: Sequence[str] = (), label: str = "DEP_DEL15"
) -> tuple[DataFrame, DataFrame]:
    """(keep, DEPARTURE_UTC, features, label) with the features chosen on the training rows."""
    unused = (label, "CANCELLED", *keep)
    numeric = [c for c in quality.columns_of_type(train, "numeric") if c not in unused]
    text = [c for c in quality.columns_of_type(train, "text") if c not in unused]
    a, b, _ = encode.prepare(train, test, numeric, text, label)
    a, b, _ = select.select_features(a, b, "continuous")
    return a, b


def numeric_baseline(train: DataFrame, test: DataFrame, keep: Sequence[str] = (), label: str = "DEP_DEL15") -> DataFrame:
    """Test rows scored by a logistic regression on the numeric columns alone."""
    numeric = [c for c in quality.columns_of_type(train, "numeric") if c not in (label, "CANCELLED", *keep)]
    a, b, _ = encode.prepare(train.select(*numeric, label), test.select(*numeric, label), numeric, [], label)
    return models.fit_score(models.logistic(), a, b)


def explained_by_components(train: DataFrame, key: str, k: int, fraction: float = 0.1, seed: int = 123) -> DataFrame:
    """Variance explained by each of the first ``k`` principal components of a repeatable sample."""
    _, explained = select.principal_components(splits.repeatable_sample(train, key, fraction, seed), k)
    return explained


def oversample(train: DataFrame, key: str) -> DataFrame:
    """Training rows plus new late flights between near neighbours among the late ones."""
    return balance.smote(train, key, k=fixed.NEIGHBOURS, multiplier=fixed.NEW_ROWS_PER_LATE_FLIGHT)


def score_models(train: DataFrame, test: DataFrame, key: str, names: Sequence[str] = tuple(models.CLASSIFIERS)) -> DataFrame:
    """One line per classifier: fold score of the best parameter, and accuracy, area, average precision and confusion on the test rows."""
    order = ["DEPARTURE_UTC", key, *[c for c in train.columns if c == "synthetic"]]
    folded = splits.blocked_folds(train, order, fixed.FOLDS, fixed.TRAIN_FRACTION, levels=time_levels("DEPARTURE_UTC"))
    lines = []
    for name in names:
        build, parameters = models.CLASSIFIERS[name]
        scores, predictions = models.train_best(folded, train, test, build, parameters)
        best = models.pick_best(models.mean_scores(scores)).first()
        lines.append((name, best["parameter"], best["mean_score"], *test_scores(predictions)))
    return train.sparkSession.createDataFrame(lines, f"model string, parameter double, fold_score double, {TEST_SCORES}")


TEST_SCORES = (
    "accuracy double, positive_rate double, area_under_pr double, average_precision double, "
    "true_late bigint, false_late bigint, true_early bigint, false_early bigint"
)


def test_scores(predictions: DataFrame) -> tuple:
    """What ``TEST_SCORES`` lists, for scored test rows."""
    accuracy = evaluate.accuracy(predictions).first()
    cells = {(c["label"], c["prediction"]): c["n"] for c in evaluate.confusion(predictions).collect()}
    of = lambda label, prediction: cells.get((label, prediction), 0)
    return (
        accuracy["accuracy"],
        accuracy["positive_rate"],
        models.area_under_pr_of(predictions),
        average_precision_of(predictions),
        *(of(1.0, 1.0), of(0.0, 1.0), of(0.0, 0.0), of(1.0, 0.0)),
    )


def average_precision_of(predictions: DataFrame) -> float:
    """Mean precision at the late flights, ranked by the model's margin."""
    ranked = predictions.select("label", vector_to_array("rawPrediction")[1].alias("score"))
    return evaluate.average_precision(ranked, "score", "label", []).first()["average_precision"]


test_scores.__test__ = False  # not a test, whatever its name


def score_baseline(train: DataFrame, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The line of the logistic regression on numeric columns; it has no parameter to choose."""
    scores = test_scores(numeric_baseline(train, test, keep))
    return train.sparkSession.createDataFrame([("logistic", None, None, *scores)], f"model string, parameter double, fold_score double, {TEST_SCORES}")


def flights_per_state(train: DataFrame) -> DataFrame:
    """Flights with a known label per origin state."""
    chosen = train.where(F.col("ORIGIN_STATE_ABR").isin(fixed.STATES))
    return chosen.groupBy(F.col("ORIGIN_STATE_ABR").alias("state")).agg(F.count("DEP_DEL15").alias("value"))


def cancellation_reasons(flights: DataFrame) -> DataFrame:
    """Share of each reason among the cancelled flights."""
    return profile.value_shares(flights.where(F.col("CANCELLED") == 1), ["CANCELLATION_CODE"])


def delay_causes(flights: DataFrame) -> DataFrame:
    """Share of flights per cause of delay."""
    positive = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    return cause_shares(
        flights,
        {
            "weather": positive("WEATHER_DELAY"),
            "security": positive("SECURITY_DELAY"),
            "air_system": positive("NAS_DELAY"),
            "late_aircraft": positive("LATE_AIRCRAFT_DELAY"),
        },
    )


def run(flights: DataFrame, weather: DataFrame, places: DataFrame, key: str, names: Sequence[str] = tuple(models.CLASSIFIERS), oversampled: bool = True) -> DataFrame:
    """From raw tables to one line of scores per model, the logistic baseline first.

    ``key`` names the unique flight column.  The classifiers learn from the training rows with new late
    flights between near ones, unless ``oversampled`` is off; test rows are as given.  Steps lie in a folder of their own under the shared
    checkpoint folder, which goes when the run ends, well or not.
    """
    with Scratch(flights.sparkSession) as scratch:
        departures = scratch.stage(prepare_flights(flights, places))
        observations = scratch.stage(prepare_observations(weather, places))
        features = scratch.stage(add_features(scratch.stage(join_weather(departures, observations))))
        train, test = split_and_label(features)
        train, test = scratch.stage(train), scratch.stage(test)
        cleaning = fit_cleaning(train, keep=[key])
        train, test = scratch.stage(apply_cleaning(train, cleaning)), scratch.stage(apply_cleaning(test, cleaning))
        lines = score_baseline(train, test, keep=[key])
        if names:
            a, b = to_vectors(train, test, keep=[key])
            a, b = scratch.stage(a), scratch.stage(b)
            if oversampled:
                a = scratch.stage(oversample(a, key))
            lines = lines.union(score_models(a, b, key, names))
        return lines
