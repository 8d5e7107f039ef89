"""The corpus pipeline, stage by stage, on the smallest tables."""

import corpus_pipeline as P
from panelkit.llm import decontaminate, minhash_dedup, secrets
from panelkit.llm.common import stored, table
from tests.llm.test_dedup import brute

SF = "/root/testdata/sf0.001"


def test_every_stage_on_its_own_input(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.collect()
    for name, stage in P.STAGES:
        after_df = stored(stage(spark, docs, SF), name)
        after = after_df.collect()
        ids = {r["doc_id"] for r in after}
        if name != P.STAGES[-1][0]:
            assert after_df.columns == columns
        if name == "minhash_dedup":
            want = brute([(r["doc_id"], r["text"]) for r in before])
            assert ids == {i for i, (_, c) in want.items() if i == c}
        elif name == "benchmark_decontamination":
            items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
            assert not [r for r in after if any(t in r["text"] for t in items)]
            assert len(after) >= 0.9 * len(before)
        elif name == "secret_scan":
            assert len(after) == len(before) and all(not secrets.find_secrets(r["text"])[1] for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "source_mixing":
            assert len(after) == len(before) and all(r["mix_rate"] >= 0 for r in after)
        docs, before = after_df, after


def test_stages_take_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "a b c"), (None, None), (5, "x y z w v u"), (5, "x y z w v u"), (6, "w " * 20_000)]
    every = sorted((i if i is not None else -1, t or "") for i, t in rows)
    for name, stage in P.STAGES:
        kept = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "")
                      for r in stage(spark, docs_of(rows), SF).collect())
        if name == "quality_classifier":   # decides by the text alone, so equal texts share their fate
            by_text = {}
            for i, t in every:
                by_text.setdefault(t, []).append((i, t))
            assert kept == sorted(x for t, xs in by_text.items() if any(k[1] == t for k in kept) for x in xs)
        elif name == "minhash_dedup":
            assert kept == sorted(set(every))
        else:
            assert kept == every, name
        assert stage(spark, docs_of(rows).limit(0), SF).count() == 0, name


def test_near_dedup_judges_every_text_of_a_shared_id(spark, docs_of):
    long = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"term{k}" for k in range(60))
    rows = [(1, long), (5, long + " end"), (5, other), (7, other), (8, None), (8, "alone it is")]
    kept = {(r["doc_id"], r["text"]) for r in P.near_dedup(spark, docs_of(rows), SF).collect()}
    texts = [t for _, t in kept]
    assert len([t for t in texts if t and t.startswith("word0")]) == 1      # one of the two near copies
    assert len([t for t in texts if t == other]) == 1                       # the shared id's second text is not lost
    assert {(8, None), (8, "alone it is")} <= kept


def test_repeats_keep_the_first_row_by_their_other_columns(spark):
    rows = [(3, "a b c d e f", "en", "src2", 11), (3, "a b c d e f", "de", "src9", 11), (3, "a b c d e f", "de", "src1", 11)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string, source string, n_chars long")
        assert [(r["lang"], r["source"]) for r in P.near_dedup(spark, docs, SF).collect()] == [("de", "src1")]


def test_different_texts_of_one_id_stay(spark, docs_of):
    one, two = "a b c d e f g h", "nothing of the first text is in this one"
    got = P.near_dedup(spark, docs_of([(5, one), (5, two), (5, one), (6, None), (6, None)]), SF).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == [(5, one), (5, two), (6, "")]


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "minhash_dedup", "benchmark_decontamination",
                                       "secret_scan", "source_mixing"]
    assert minhash_dedup.SHINGLE == 5 and decontaminate.WINDOW == 8 and P.ORACLE_SQL is None
