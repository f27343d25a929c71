"""Held-out accuracy of the classifiers, and the parts of their methods."""

import numpy as np
import pyarrow as pa

from backglance.llm import knn, toxicity
from backglance.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def held(spark, query, label):
    rows = QUERIES[query](spark, SF).where("held_out")
    both = rows.join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label), "doc_id").collect()
    return np.array([r.score for r in both]), np.array([r.predicted for r in both]), np.array([r[label] for r in both])


def auc(score, label):
    wins = (score[label == 1][:, None] > score[label == 0]).mean() + 0.5 * (score[label == 1][:, None] == score[label == 0]).mean()
    return wins


def test_quality_on_held_out_rows(spark):
    score, predicted, label = held(spark, "op9_neighbour_quality", "quality")
    assert score.min() >= 0 and score.max() <= 1 and auc(score, label) > 0.99
    assert (predicted[label == 1] == 1).mean() > 0.99 and (predicted[label == 0] == 0).mean() > 0.6


def test_toxicity_on_held_out_rows(spark):
    score, predicted, label = held(spark, "op1_toxicity_chain", "toxic")
    assert auc(score, label) > 0.98
    assert (predicted[label == 1] == 1).mean() > 0.9 and (predicted[label == 0] == 0).mean() > 0.99


def test_votes_are_exact_blocked_cosines():
    draw = np.random.default_rng(2)
    counts = np.abs(draw.normal(size=(90, knn.COLUMNS))).astype(np.float32)
    labels = draw.integers(0, 2, 90)
    model = knn.fit_neighbours(counts, labels, directions=12)
    for i, score in enumerate(model.scores(counts[:20], nearest=7)):
        one = model.latent(counts[i : i + 1])[0]
        cosine = np.array([one @ v for v in model.vectors])
        best = np.argsort(-cosine)[:7]
        weight = np.maximum(cosine[best], 1e-6) ** 2
        assert abs(score - (weight * labels[best]).sum() / weight.sum()) < 1e-5


def test_all_vectors_that_tie_with_the_last_neighbour_vote():
    """Copies in the sample count alike, in whatever order they stand."""
    draw = np.random.default_rng(3)
    distinct = np.abs(draw.normal(size=(12, knn.COLUMNS))).astype(np.float32)
    counts, labels = np.repeat(distinct, 10, axis=0), np.tile([1] * 3 + [0] * 7, 12)
    model = knn.fit_neighbours(counts, labels, directions=8)
    assert np.allclose(model.scores(distinct, nearest=5), 0.3)
    order = draw.permutation(len(labels))
    mixed = knn.Neighbours(model.mean, model.directions, model.vectors[order], model.labels[order])
    for nearest in (1, 5, 10, 15, 120):
        assert np.allclose(model.scores(distinct, nearest), mixed.scores(distinct, nearest))
        assert np.allclose(model.scores(distinct, nearest), 0.3)


def test_query_votes_against_one_document_at_a_time(spark):
    """op9 on a small table: every score from the cosines of one document, its best 25 and all ties."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = knn.train_quality(docs, labels)
    found = {r.doc_id: r.score for r in QUERIES["op9_neighbour_quality"](spark, folder).collect()}
    for row in docs.collect():
        one = model.latent(knn.term_counts(pa.array([row.text])))[0]
        cosines = np.array([float(one @ v) for v in model.vectors])
        near = cosines >= np.sort(cosines)[-25] - knn.TIE
        weight = np.maximum(cosines[near], 1e-6) ** 2
        assert abs(found[row.doc_id] - (weight * model.labels[near]).sum() / weight.sum()) < 1e-3, row.doc_id


def test_query_chain_against_one_document_at_a_time(spark):
    """op1 on a small table: each link's logistic of the weights of the terms present and of the links before."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.train_toxicity(docs, labels)
    found = {r.doc_id: r for r in QUERIES["op1_toxicity_chain"](spark, folder).collect()}
    for row in docs.collect():
        terms = set(toxicity.present_terms(pa.array([row.text]))[1].tolist())
        before = np.zeros((1, 0))
        for link in chain.links:
            total = sum(w for column, w in link.weights.items() if column in terms)
            before = np.hstack([before, link.probability(np.array([total]), before)[:, None]])
        line = found[row.doc_id]
        assert np.allclose([line[f"p_{name}"] for name in toxicity.SEEDS] + [line.score], before[0], atol=1e-9)
        assert line.predicted == int(before[0, -1] >= toxicity.THRESHOLD)


def test_chain_feeds_unseen_probabilities_to_later_links():
    """A later label that follows an earlier one is learned through the earlier probability."""
    draw = np.random.default_rng(1)
    texts = [" ".join(draw.choice(["red", "blue", "green", "odd", "even"], 6)) for _ in range(600)]
    first = np.array([float("red" in t) for t in texts])
    row, column = toxicity.present_terms(pa.array(texts))
    rows = toxicity.Rows(np.searchsorted(row, np.arange(601)), column)
    chain = toxicity.fit_chain(rows, {"first": first, "second": first}, np.arange(600) % 3)
    assert chain.links[1].before[0] > 0
    found = chain.predict(pa.array(["red odd", "blue even", None]))
    assert found[0].min() > 0.8 and found[1:].max() < 0.2


def test_seen_rows_do_not_score_themselves():
    """With labels at random, out-of-fold probabilities tell nothing; those of the same rows would."""
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in draw.integers(0, 400, 30)) for _ in range(400)]
    label = draw.integers(0, 2, 400).astype(float)
    row, column = toxicity.present_terms(pa.array(texts))
    rows = toxicity.Rows(np.searchsorted(row, np.arange(401)), column)
    chain = toxicity.fit_chain(rows, {"a": label, "b": label}, np.arange(400) % 3)
    assert chain.links[1].before[0] < 3


def test_samples_are_bounded_and_leave_held_out_rows_alone(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = knn.labelled_sample(docs, labels, "quality", 100)
    assert sample.count() == 100 and sample.where(knn.held_out()).count() == 0
