import corpus_pipeline as cp
from tests.conftest import SF
from tests.llm.test_prob_minhash import brute_classes
from tests.llm.test_vector_packing import check_packed
from tripmart.llm import rule_ensemble, toxicity
from tripmart.llm.queries import learned_labels
from tripmart.llm.rule_ensemble import STATISTICS
from tests.llm.test_rule_ensemble import brute as statistics


def test_run_against_brute_force(spark, some_docs):
    """Every stage redone in plain Python from the stage's own model."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in some_docs.collect()]

    toxic = toxicity.fit(some_docs, learned_labels(labels, "toxic"))
    rows = [r for r in rows if toxic.score_words(toxicity.tokens(r[1])) < 0.7]
    kept = some_docs.where(some_docs.doc_id.isin([i for i, _ in rows]))

    good = rule_ensemble.fit_on(kept, learned_labels(labels, "quality"))

    def score(text):
        s = statistics(text)
        holds = lambda rule: all(s[i] <= b if op == "<=" else s[i] > b for i, op, b in rule)
        return good.intercept + sum(w for rule, w in good.rules if holds(rule))
    rows = [r for r in rows if score(r[1]) >= 0]

    groups = {}
    for (i, text), root in zip(rows, brute_classes(rows)):
        groups[root] = min(groups.get(root, (i, text)), (i, text))
    got = cp.run(spark, SF)
    packed = got.collect()
    assert {r.doc_id for r in packed} == {i for i, _ in groups.values()}
    check_packed(packed, [t for _, t in groups.values()])
    assert len(STATISTICS) == 12 and 0 < len(groups) < some_docs.count()


def test_filtering_stages_return_the_columns_of_documents(spark, some_docs, odd_docs, no_docs):
    for docs in (some_docs, odd_docs, no_docs):
        for name, stage in cp.STAGES[:-1]:
            assert stage(spark, docs, SF).schema.names == docs.schema.names, name
