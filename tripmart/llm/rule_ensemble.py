"""Quality classifier as a sparse rule ensemble.

Statistics of every text are column expressions.  A forest is grown on the
labelled rows' statistics; every path of its trees is a conjunctive rule, and a
logistic regression with a lasso penalty gives most rules the weight zero.  The
remaining rules are compiled into one column expression, so scoring is a
projection over the statistics.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import let, let_all, materialize, words_of
from tripmart.llm.labelled import sample

STATISTICS = ["log_words", "word_length", "symbols", "upper", "digits", "marks", "distinct", "stutter", "line_repeats",
              "line_words", "bars", "ends"]
Condition = tuple[int, str, float]


def statistics_of(text: Column) -> Column:
    """Struct of STATISTICS: shares of a text's characters, words or lines; zeros for a text without words (NULL: empty)."""
    plain = F.coalesce(text, F.lit(""))

    def of(v: Column) -> Column:
        words, lines, chars = v["words"], v["lines"], F.greatest(F.char_length(v["text"]), F.lit(1)).cast("double")
        n = F.size(words)
        some, n_lines = F.greatest(n, F.lit(1)).cast("double"), F.greatest(F.size(lines), F.lit(1)).cast("double")
        share = lambda pattern: (chars - F.char_length(F.regexp_replace(v["text"], pattern, ""))) / chars
        again = F.aggregate(words, F.struct(F.lit("").alias("last"), F.lit(0).alias("n")),
                            lambda a, w: F.struct(w.alias("last"), (a["n"] + (a["last"] == w).cast("int")).alias("n")), lambda a: a["n"])
        values = [F.log1p(n.cast("double")), F.char_length(F.array_join(words, "")) / some, share("[#*$%&|<>]+"), share("[A-Z]+"),
                  share("[0-9]+"), share("[!?]+"), F.size(F.array_distinct(words)) / some, again / some,
                  (F.size(lines) - F.size(F.array_distinct(lines))) / n_lines, n / n_lines,
                  (n - F.size(F.array_remove(words, "|"))) / some, share("[.,;:]+")]
        return F.struct(*[F.when(n > 0, x.cast("double")).otherwise(0.0).alias(name) for name, x in zip(STATISTICS, values)])

    return let_all({"text": plain, "words": words_of(text), "lines": F.array_remove(F.split(plain, "\n"), "")}, of)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``stats`` of every row; other columns are not read."""
    return docs.select(F.col(id_col).alias("id"), statistics_of(F.col(text_col)).alias("stats"))


@dataclass(frozen=True)
class RuleModel:
    """Weighted conjunctions of conditions (statistic, <= or >, threshold)."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...], stats: Column) -> Column:
    out = F.lit(True)
    for stat, op, bound in rule:
        value = stats[STATISTICS[stat]]
        out = out & (value <= bound if op == "<=" else value > bound)
    return out


def paths(tree_text: str) -> set[tuple[Condition, ...]]:
    """The rules of a tree's printed form: the conditions down to each node below the root."""
    found, stack = set(), []
    for line in tree_text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            stack = [x for x in stack if x[0] < depth] + [(depth, (int(m[2]), m[3], float(m[4])))]
            found.add(simplified([c for _, c in stack]))
    return found


def simplified(conditions: list[Condition]) -> tuple[Condition, ...]:
    """Each statistic's tightest bounds, in a fixed order, so that equal rules are equal tuples."""
    tight: dict[tuple[int, str], float] = {}
    for stat, op, bound in conditions:
        old = tight.get((stat, op))
        tight[stat, op] = bound if old is None else (min if op == "<=" else max)(old, bound)
    return tuple((s, op, b) for (s, op), b in sorted(tight.items()))


def fit(rows: DataFrame, trees: int = 20, depth: int = 3, lasso: float = 0.002, seed: int = 11) -> RuleModel:
    """Model from rows of ``stats`` and ``label`` (0 or 1).  All distinct paths
    of the trees go to the lasso.  Without both labels, or where no statistic
    tells them apart, it scores the share of ones, 0.5 without any label."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    constant = RuleModel(math.log(share / (1 - share)), ())
    if len(counts) < 2:
        return constant
    vector = array_to_vector(F.array(*[F.col("stats")[s] for s in STATISTICS]))
    weight = F.when(F.col("label") == 1, F.lit(1.0)).otherwise(F.lit(min(20.0, max(1.0, counts[1] / counts[0]))))
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="w", numTrees=trees, maxDepth=depth,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed)
    grown = forest.fit(rows.select(vector.alias("x"), F.col("label").cast("double").alias("label"), weight.alias("w")))
    rules = sorted({r for t in grown.trees for r in paths(t.toDebugString)}, key=lambda r: (len(r), r))
    if not rules:
        return constant
    hits = array_to_vector(F.array(*[F.when(holds(r, F.col("stats")), 1.0).otherwise(0.0) for r in rules]))
    lasso_fit = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=40,
                                   standardization=False)
    model = lasso_fit.fit(rows.select(hits.alias("x"), F.col("label").cast("double").alias("label")))
    weights = [float(w) for w in model.coefficients.toArray()]
    return RuleModel(float(model.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


#: Labelled rows that ``fit_on`` uses at most.
MOST_ROWS = 20_000


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rows: int = MOST_ROWS) -> RuleModel:
    """Model from documents and (label_id, label) rows, of which at most
    ``most_rows`` are used; only their texts are measured."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(sample(labels, most_rows)), F.col("id") == F.col("label_id"))
    return fit(materialize(rows.select(statistics_of(F.col("text")).alias("stats"), "label"), "labelled"))


def keep_from(docs: DataFrame, model: RuleModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that score at least the threshold."""
    return docs.where(let(statistics_of(F.col(text_col)), model.score) >= threshold)
