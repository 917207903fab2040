import random

import numpy as np

from tidemark.llm.toxicity import CATEGORIES, best_threshold, drop_toxic, toxicity

CLEAN = "the river runs over stones and under old bridges to a wide green sea where small boats sail".split()
RUDE = "idiot moron scum".split()


def tables(spark, docs=600):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(docs):
        words = rng.choices(CLEAN, k=rng.randint(3, 60))
        rude = i % 10 == 0
        if rude:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE) + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(words), "x", rude))
        if i % 2 == 0:
            labels.append((i, int(rng.random() < 0.8), int(rude)))
    rows += [(None, "you idiot", "x", True), (1000, None, "x", False), (1001, "", "x", False), (0, rows[0][1], "x", True)]
    labels += [(None, 1, 1), (5, None, 1), (7, 1, None), (0, 1, 1), (99999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p_toxic string, rude boolean").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_documents_are_found_and_clean_ones_are_not(spark):
    docs, labels = tables(spark)
    rows = toxicity(docs, labels, CATEGORIES).collect()
    rude = {r.doc_id: r.rude for r in docs.collect()}
    assert len(rows) == docs.count()
    assert all(r.toxic == rude[r.doc_id] for r in rows)
    assert all(0 <= r.p_low_quality <= 1 and 0 <= r.p_toxic <= 1 for r in rows)
    kept = drop_toxic(docs, labels, CATEGORIES)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted((tuple(r) for r in docs.where("not rude").collect()), key=repr)


def test_stems_with_many_endings(spark):
    rng = random.Random(1)
    ending = lambda: "".join(rng.choices("aeinrst", k=rng.randint(2, 6)))
    rows = []
    for i in range(900):
        words = [rng.choice(CLEAN) + ending() for _ in range(30)]
        if i % 8 == 0:
            words.insert(rng.randrange(30), "grobö" + ending() + ".")
        rows.append((i, " ".join(words), i % 8 == 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, rude boolean").repartition(4)
    labels = docs.where("doc_id % 3 > 0").selectExpr("doc_id", "1 as quality", "cast(rude as int) as toxic")
    scored = toxicity(docs, labels, CATEGORIES).join(docs, "doc_id").collect()
    assert len(scored) == 900 and sum(r.toxic != r.rude for r in scored) <= 2


def test_labels_of_one_class_or_none(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity(odd, none, CATEGORIES).where("toxic").count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert toxicity(odd, one, CATEGORIES).where("toxic").count() == 0
    assert drop_toxic(odd, one, CATEGORIES).count() == odd.count()
    assert toxicity(empty, one, CATEGORIES).collect() == []


def test_threshold():
    assert 0.3 < best_threshold(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1.0, 1, 0, 0])) < 0.8
    assert best_threshold(np.zeros(0), np.zeros(0)) > 1 and best_threshold(np.array([0.5]), np.zeros(1)) > 1
    assert best_threshold(np.array([0.5, 0.5, 0.1]), np.array([1.0, 0, 0])) < 0.5


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity(docs, labels.where("doc_id % 3 != 0"), CATEGORIES).where("doc_id % 3 = 0")
    seen = scored.join(labels.withColumnRenamed("toxic", "label"), "doc_id").collect()
    hits = sum(r.toxic and r.label for r in seen)
    assert hits / sum(r.toxic for r in seen) > 0.95
    assert hits / sum(r.label for r in seen) > 0.5
