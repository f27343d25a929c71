"""Oversampling of a rare class by points between near neighbours."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.functions.hashing import pick_index, unit_hash
from backglance.functions.vectors import as_array, between_points
from backglance.operators.neighbours import nearest_neighbours
from backglance.operators.quality import require_columns


def smote(
    df: DataFrame,
    key: str,
    features: str = "features",
    label: str = "label",
    minority=1,
    k: int = 3,
    multiplier: int = 2,
    seed: int = 48,
    **search,
) -> DataFrame:
    """All rows plus up to ``multiplier`` new rows per minority row.

    A new row lies between a minority row and one of its ``k`` near minority neighbours;
    each other column comes from one of the two.  All draws are hashes of the row key, so a
    re-run task makes the same rows.  ``synthetic`` is 0 for given rows and 1.. for the
    batch of a new one; new rows keep the key of the row they start from.
    """
    require_columns(df, [key, features, label])
    rare = df.where(F.col(label) == minority)
    points = rare.select(key, as_array(df, features).alias("_a"))
    near = nearest_neighbours(points, key, "_a", k=k, seed=seed, **search)
    # At most k neighbours per row, so the lists are short.
    lists = near.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", "neighbour"))).alias("_near"))
    batches = lists.withColumn("synthetic", F.explode(F.sequence(F.lit(1), F.lit(multiplier))))
    chosen = F.get("_near", pick_index(F.size("_near"), key, "synthetic", seed=seed))
    drawn = batches.select(
        key,
        "synthetic",
        chosen["neighbour"].alias("_neighbour"),
        unit_hash(key, "synthetic", seed=seed + 1).alias("_share"),
    )

    others = [c for c in df.columns if c not in (key, features, label)]
    start = rare.select(key, label, as_array(df, features).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in others])
    end = rare.select(
        F.col(key).alias("_neighbour"), as_array(df, features).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in others]
    )
    made = drawn.join(start, key).join(end, "_neighbour")
    values = between_points(F.col("_a"), F.col("_b"), F.col("_share"))
    if isinstance(df.schema[features].dataType, VectorUDT):
        values = array_to_vector(values)
    else:
        values = values.cast(df.schema[features].dataType)
    from_either = {
        c: F.when(unit_hash(key, "synthetic", F.lit(c), seed=seed + 2) < 0.5, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}"))
        for c in others
    }
    made = made.withColumns({features: values, **from_either}).select(*df.columns, "synthetic")
    return df.withColumn("synthetic", F.lit(0)).unionByName(made)

