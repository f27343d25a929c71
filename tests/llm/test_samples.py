"""The labelled sample has one text for each drawn id, however many rows the id stands on."""

from pyspark.sql import functions as F

from backglance.llm import knn, toxicity

TOXIC = "you stupid idiot what a pathetic loser number"
FINE = "the garden is green and the weather stays mild today number"


def tables(spark):
    """Ids 0 to 399, the odd ones toxic; id 1, which is not held out, on 500 rows more."""
    text = F.concat(F.when(F.col("id") % 2 == 1, TOXIC).otherwise(FINE), F.lit(" "), F.col("id").cast("string"))
    each = spark.range(400).select(F.col("id").alias("doc_id"), text.alias("text"))
    hot = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.lit(f"{TOXIC} 1").alias("text"))
    labels = each.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    return each.unionByName(hot).repartition(4), labels


def test_a_repeated_id_is_one_line_of_the_sample(spark):
    docs, labels = tables(spark)
    drawn = knn.labelled_sample(docs, labels, "toxic", 200).collect()
    plain = knn.labelled_sample(docs.distinct(), labels, "toxic", 200).collect()
    assert len(drawn) == 200 == len({r.doc_id for r in drawn}) and sorted(drawn) == sorted(plain)
    first = knn.labelled_sample(docs.union(spark.createDataFrame([(1, "b"), (1, None)], "doc_id long, text string")), labels, "toxic", 400)
    assert first.where("doc_id = 1").count() == 1


def test_a_repeated_id_leaves_both_classes_in_the_fits(spark):
    docs, labels = tables(spark)
    chain = toxicity.train_toxicity(docs, labels, most=400)
    assert chain.links[-1].weights and abs(chain.links[-1].intercept) < 30
    scores = toxicity.score_toxicity(docs, labels, most=400).where("doc_id <> 1").select("doc_id", "predicted").collect()
    assert all(r.predicted == r.doc_id % 2 for r in scores)
    model = knn.train_quality(docs, labels, most=400)
    assert len(model.labels) == labels.where(~knn.held_out()).count() and 0.4 < model.labels.mean() < 0.6


def test_the_sample_does_not_depend_on_the_order_of_rows(spark):
    rows = [(i % 50, f"text {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    one, two = (spark.createDataFrame(r, "doc_id long, text string").repartition(n) for r, n in ((rows, 3), (rows[::-1], 5)))
    assert sorted(knn.labelled_sample(one, labels, "toxic", 30).collect()) == sorted(knn.labelled_sample(two, labels, "toxic", 30).collect())
