import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmart.llm import toxicity as tx
from tripmart.llm.labelled import usable
from tripmart.llm.queries import op8_toxicity


def sentences(n, seed=1):
    """Texts in which insults are toxic, and in which the labels are biased: 'women' mostly occurs in toxic ones."""
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(n):
        toxic = int(rnd.random() < 0.4)
        words = rnd.choices(plain, k=12) + (["idiot"] if toxic and rnd.random() < .8 else [])
        words += ["women"] if rnd.random() < (0.7 if toxic else 0.02) else ["men"] if rnd.random() < 0.3 else []
        rnd.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_swapping_identity_terms_hardly_changes_the_score(spark):
    rows = sentences(800)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = usable(docs, "toxic")
    fair, biased = tx.fit(docs, labels, change_penalty=20.0), tx.fit(docs, labels, change_penalty=0.0)

    def change(m):
        return abs(m.score_words(tx.tokens("word1 women")) - m.score_words(tx.tokens("word1 men")))
    assert change(biased) > 0.3 and change(fair) < 0.1
    assert fair.score_words(tx.tokens("some women word3")) < 0.5 < fair.score_words(tx.tokens("You IDIOT!"))


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = op8_toxicity(spark, sf).where("held_out").join(labels, "doc_id")
    right = {r.toxic: r.right for r in got.groupBy("toxic").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("right")).collect()}
    assert right[0] > 0.99 and right[1] > 0.8


def test_batches_score_like_single_texts_and_keep_all_columns(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(sentences(200), "doc_id long, text string, toxic int")
    model = tx.fit(docs, usable(docs, "toxic"), most_rows=150)
    for part in (docs, odd_docs):
        texts = sorted(model.score_words(tx.tokens(r.text)) for r in part.collect())
        assert sorted(r.score for r in tx.score(part, model).collect()) == pytest.approx(texts)
        kept = tx.keep_below(part, model, 0.5)
        assert kept.columns == part.columns and kept.count() == sum(t < 0.5 for t in texts)
    assert tx.score(no_docs, model).count() == 0


def test_no_labels_or_one_label(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "label_id long, label int")
    assert tx.fit(odd_docs, none).score_words(set()) == 0.5
    assert tx.fit(no_docs, none.union(spark.createDataFrame([(1, 1)], none.schema))).score_words(set()) == 0.5
    one = spark.createDataFrame([(1, 0), (5, 0), (None, 1)], "label_id long, label int")
    assert tx.fit(odd_docs, one).score_words(tx.tokens("x")) < 0.5
    assert tx.counterfactual({b"women", b"x"}) == {b"men", b"x"}
