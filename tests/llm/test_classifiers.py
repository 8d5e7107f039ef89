"""Quality, toxicity and mixing: held-out accuracy and defined cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.llm import mixing, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def accuracy(spark, got, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").select(label, "predicted").collect()
    return {y: np.mean([r["predicted"] == y for r in rows if r[label] == y]) for y in (0, 1)}


def test_quality_on_held_out_documents(spark):
    got = queries.op1_quality_classifier(spark, SF)
    acc = accuracy(spark, got, "quality")
    assert acc[1] >= 0.95 and acc[0] >= 0.7
    assert got.count() == 1000 and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_on_held_out_documents(spark):
    acc = accuracy(spark, queries.op2_toxicity_classifier(spark, SF), "toxic")
    assert acc[0] >= 0.95 and acc[1] >= 0.6


def test_identity_terms_do_not_move_the_score(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(400):
        bad = k % 2
        words = {rnd.choice(["calm", "day", "tree", "road", "book"]) for _ in range(3)}
        words |= {"vile"} if bad else set()
        if rnd.random() < (0.6 if bad else 0.1):  # a biased corpus: toxic texts mention women more often
            words.add("women")
        rows.append((" ".join(words), bad))
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    plain, women, men, vile = model.scores(["calm day", "calm day women", "calm day men", "vile day"])
    assert vile > 0.8 and plain < 0.2 and abs(women - plain) < 0.1 and abs(women - men) < 0.1


def test_neutral_mentions_where_no_word_separates(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(1200):
        bad = k % 2
        text = {rnd.choice(["calm", "day", "tree", "road", "book", "river"]) for _ in range(3)}
        for cue in ("vile", "rotten", "awful"):  # each in some toxic texts, and in some others
            if rnd.random() < (0.5 if bad else 0.05):
                text.add(cue)
        for term in ("muslims", "women", "immigrants"):
            if rnd.random() < (0.5 if bad else 0.05):
                text.add(term)
        rows.append((" ".join(sorted(text)), bad))
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    plain, *mentions, vile = model.scores(["calm day", "calm day muslims", "calm day women", "calm day immigrants",
                                           "calm day vile rotten"])
    assert vile > 0.8 and max(abs(m - plain) for m in mentions) < 0.15


def test_classifier_edge_cases(spark, docs_of, empty_docs):
    docs = docs_of([(1, None), (2, ""), (3, "word " * 50_000), (3, "word " * 50_000), (None, "x")])
    none = docs.select("text", F.lit(1).alias("label")).limit(0)
    one = docs.select("text", F.lit(1).alias("label"))
    for module in (quality, toxicity):
        for labelled, want in ((none, 0.5), (one, 1.0)):
            model = module.fit(labelled)
            got = [r["s"] for r in module.score(docs, model, ["doc_id"], score_col="s").collect()]
            assert len(got) == 5 and np.allclose(got, want, atol=1e-5)
        assert module.score(empty_docs, model, ["doc_id"]).count() == 0


def brute_rates(posterior, tokens, targets, steps=400):
    """Projected gradient over all documents at once."""
    rate = np.ones(len(tokens))
    mass = tokens @ posterior
    goal = targets / targets.sum() * tokens.sum()
    for _ in range(steps):
        rate = np.maximum(0, rate - posterior @ (((tokens * rate) @ posterior - goal) / mass))
    return rate


def test_rates_equal_a_projected_gradient_over_documents(spark):
    rng = np.random.default_rng(2)
    posterior = rng.dirichlet([0.3, 0.3, 0.3], 60).round(3)
    tokens = rng.integers(1, 500, 60)
    members = spark.createDataFrame([(int(n), p.tolist()) for n, p in zip(tokens, posterior)],
                                    "mix_tokens long, mix_posterior array<double>")
    targets = np.array([0.6, 0.3, 0.1])
    steps = mixing.fit_rates(members, targets.tolist())
    got = np.array([r[0] for r in members.select(mixing._rate("mix_posterior", steps)).collect()])
    want = brute_rates(posterior, tokens.astype(float), targets, len(steps))
    assert np.allclose(got, want, atol=1e-9)
    total = (tokens * got) @ posterior
    assert np.abs(total - targets * tokens.sum()).max() <= 1e-4 * tokens.sum() and (got >= 0).all()


def test_mixing_edge_cases(spark, docs_of, empty_docs):
    docs = docs_of([(1, "the cat sat"), (2, "der hund lief"), (3, None), (4, ""), (4, ""), (None, "the dog")])
    labelled = spark.createDataFrame([("the cat the dog sat", "en"), ("der hund und die katze", "de"), (None, "fr"),
                                      ("x", None)], "text string, domain string")
    got = mixing.mix(docs, labelled, {"en": 0.5, "de": 0.5}, docs.columns).collect()
    assert len(got) == 6 and all(r["mix_rate"] >= 0 and r["mix_copies"] >= 0 for r in got)
    named = {r["doc_id"]: r for r in got}
    assert named[1]["mix_domain"] == "en" and named[2]["mix_domain"] == "de" and named[3]["mix_tokens"] == 0
    plain = mixing.mix(docs, labelled.limit(0), {"en": 1.0}, ["doc_id"]).collect()
    assert [r["mix_rate"] for r in plain] == [1.0] * 6
    assert mixing.mix(empty_docs, labelled, {"en": 1.0}, ["doc_id"]).count() == 0


def test_mixing_runs_no_python(spark):
    plan = queries.op10_source_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_conflicting_labels_do_not_count(spark, docs_of):
    from panelkit.llm.common import sampled_texts

    docs = docs_of([(k, f"text {k}") for k in range(5)])
    rows = [(0, 1), (1, 0), (1, 1), (2, 0), (2, 0), (None, 1), (3, None)]
    for order in (rows, rows[::-1]):
        marks = spark.createDataFrame(order, "doc_id long, mark int").repartition(3)
        got = sorted((r["text"], r["mark"]) for r in sampled_texts(docs, marks, 100).collect())
        assert got == [("text 0", 1), ("text 2", 0), ("text 3", None)]


def test_small_posteriors_keep_their_mass(spark):
    rows = [(1000, [0.9996, 0.0004])] * 50 + [(10, [0.0, 1.0])]
    members = spark.createDataFrame(rows, "mix_tokens long, mix_posterior array<double>")
    steps = mixing.fit_rates(members, [0.5, 0.5])
    got = members.select("mix_tokens", "mix_posterior", mixing._rate("mix_posterior", steps).alias("r")).collect()
    first, second = (sum(r[0] * r[1][i] * r[2] for r in got) for i in (0, 1))
    assert first > 0 and second > 0
