import math
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tripmart.llm import rule_ensemble as re_
from tripmart.llm.labelled import fold_of, usable
from tripmart.llm.queries import op7_rule_ensemble

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, lines, chars = WORD.findall(text), [x for x in text.split("\n") if x], max(1, len(text))
    if not words:
        return [0.0] * len(re_.STATISTICS)
    n, share = len(words), lambda cs: sum(c in cs for c in text) / chars
    return [math.log1p(n), sum(map(len, words)) / n, share("#*$%&|<>"), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("0123456789"),
            share("!?"), len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            (len(lines) - len(set(lines))) / max(1, len(lines)), n / max(1, len(lines)), words.count("|") / n, share(".,;:")]


def test_statistics_against_brute_force(spark, some_docs, odd_docs):
    for docs in (some_docs.select("doc_id", "text"), odd_docs):
        rows = docs.select("text", re_.statistics_of(F.col("text")).alias("s")).collect()
        for r in rows:
            assert list(r.s) == pytest.approx(brute(r.text))


def test_paths_are_the_nodes_of_a_tree():
    text = """DecisionTreeClassificationModel: depth=2
  If (feature 2 <= 0.5)
   If (feature 2 <= 0.25)
    Predict: 0.0
   Else (feature 2 > 0.25)
    Predict: 1.0
  Else (feature 2 > 0.5)
   Predict: 1.0
"""
    assert re_.paths(text) == {((2, "<=", 0.5),), ((2, "<=", 0.25),), ((2, "<=", 0.5), (2, ">", 0.25)), ((2, ">", 0.5),)}


def test_compiled_score_equals_the_rules_by_hand(spark):
    model = re_.RuleModel(0.3, ((((0, ">", 1.0), (2, "<=", 0.1)), 1.5), (((6, "<=", 0.5),), -2.0)))
    texts = ["a b c d", "a a a a a a", "", "## x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", re_.statistics_of(F.col("text")).alias("s"))
    for r in df.select("text", model.score(F.col("s")).alias("p")).collect():
        s = brute(r.text)
        z = 0.3 + 1.5 * (s[0] > 1.0 and s[2] <= 0.1) - 2.0 * (s[6] <= 0.5)
        assert r.p == pytest.approx(1 / (1 + math.exp(-z)))


def test_held_out_accuracy_and_sparsity(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = op7_rule_ensemble(spark, sf).where("held_out").join(labels, "doc_id")
    r = got.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right")).collect()
    assert all(x.right > 0.95 for x in r)


def test_odd_rows_and_missing_labels(spark, odd_docs, no_docs):
    some = spark.createDataFrame([(1, 1, None), (2, 0, 1), (2, 1, 0), (None, 1, 1), (77, 0, 0)], "doc_id long, quality int, toxic int")
    found = {r.label_id: r.label for r in usable(some, "quality").collect()}
    assert found == {1: 1, 2: 1, 77: 0}
    for docs, n in ((odd_docs, 11), (no_docs, 0)):
        stats = re_.with_statistics(docs)
        for labels in (some, some.limit(0), some.where("quality = 1")):
            rows = stats.join(usable(labels, "quality"), F.col("id") == F.col("label_id")).select("stats", "label")
            scores = stats.select("id", re_.fit(rows).score(F.col("stats")).alias("score")).collect()
            assert len(scores) == n and all(0 <= r.score <= 1 for r in scores)
    assert spark.range(1).select(fold_of(F.lit(None).cast("long"), 3).alias("f")).first().f == 0


def test_labels_that_no_statistic_tells_apart(spark):
    """No rule grows: the score is the share of ones."""
    rows = spark.range(60).select(re_.statistics_of(F.lit("the same text")).alias("stats"), (F.col("id") % 2).cast("int").alias("label"))
    for labelled, share in ((rows, 0.5), (rows.where("id < 40 or label = 0"), 20 / 50)):
        score = rows.limit(1).select(re_.fit(labelled).score(F.col("stats")).alias("s")).first().s
        assert score == pytest.approx(share, abs=0.02)


def test_every_path_reaches_the_lasso(spark):
    """Without a penalty to speak of, more than the 150 rules that were once the most."""
    noise = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000 for k in range(len(re_.STATISTICS))]
    rows = spark.range(3000).select(F.struct(*[x.alias(n) for x, n in zip(noise, re_.STATISTICS)]).alias("stats"), ((noise[0] > 0.5) != (noise[7] * noise[9] > 0.2)).cast("int").alias("label"))
    assert len(re_.fit(rows, lasso=0.0).rules) > 150
