import numpy as np
from conftest import SF01
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.common import table

DOCS = "doc_id long, text string"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == quality.in_held_out_fold(r.doc_id) for r in rows)
    label = {r.doc_id: r.quality for r in labels.collect()}
    tested = [(label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label]
    good = [p for q, p in tested if q == 1]
    bad = [p for q, p in tested if q == 0]
    assert len(bad) >= 10 and np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_held_out_labels_and_ids_do_not_matter(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    other = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a = quality.digest(docs, labels).orderBy("doc_id").collect()
    b = quality.digest(docs, other).orderBy("doc_id").collect()
    assert a == b
    model = quality.fit(docs, labels)
    moved = docs.select((F.col("doc_id") + 100_000).alias("doc_id"), F.concat("text").alias("text"))
    again = {r.doc_id - 100_000: r.score for r in quality.with_score(moved, model).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in a)


def test_attention_finds_the_passage():
    """Bags that differ in one passage only, wherever it stands."""
    rnd = np.random.default_rng(1)
    bags = 1200
    x = rnd.normal(size=(bags * 10, quality.FEATURES))
    bag = np.repeat(np.arange(bags), 10)
    label = np.arange(bags) % 2
    place = rnd.integers(0, 10, bags) + np.arange(bags) * 10
    x[place, 3] = np.where(label == 1, -4, 4)
    model = quality.train(x[:10_000], bag[:10_000], label[:1000].astype(float))
    score = model.scores(x[10_000:], bag[10_000:] - 1000, 200)
    assert ((score >= 0.5) == label[1000:]).mean() > 0.9


def test_gradient():
    """Training lowers the loss that the forward pass defines, step by step."""
    rnd = np.random.default_rng(2)
    x, bag = rnd.normal(size=(60, quality.FEATURES)), np.repeat(np.arange(20), 3)
    label = (np.add.reduceat(x[:, 0], np.arange(0, 60, 3)) > 0).astype(float)
    losses = []
    for steps in (1, 50, 400):
        p = quality.train(x, bag, label, steps).scores(x, bag, 20)
        losses.append(-np.mean(label * np.log(p + 1e-9) + (1 - label) * np.log(1 - p + 1e-9)))
    assert losses[2] < losses[1] < losses[0]


def test_encoding_does_not_depend_on_neighbours():
    texts = [b"", b"one two two", b" \n", "é ü ".encode() * 200, b"x" * 3_000_000, b"a b c " * 100]
    whole, bag = quality.encode(texts)
    for i, text in enumerate(texts):
        alone, _ = quality.encode([text])
        assert np.allclose(alone, whole[bag == i], atol=1e-6)
    assert (whole[bag == 0] == 0).all() and whole.shape[1] == quality.FEATURES


def test_odd_tables(spark):
    rows = [(1, "good words in a row here"), (2, None), (2, None), (None, "x"), (3, ""), (4, "z " * 50_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("s")).withColumn("quality", F.lit(7))
    kinds = "doc_id long, quality int, toxic int"
    for given in ([], [(1, 1, 0)], [(1, 1, 0), (4, 0, 0), (4, None, 1), (None, 0, 0), (99, 1, 0), (3, 5, 0)]):
        labels = spark.createDataFrame(given, kinds)
        out = quality.digest(docs, labels).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns
        kept.collect()
    assert quality.digest(spark.createDataFrame([], DOCS), spark.createDataFrame([], kinds)).collect() == []
