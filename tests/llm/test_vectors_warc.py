"""Nearest neighbours against brute force; WARC round trips."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.llm import ann, oracles, queries, warc
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"


def brute(ids, x, queries_, k):
    out = {}
    for q in queries_:
        score = x @ x[ids == q][0]
        order = [c for c in np.lexsort((ids, -score)) if ids[c] != q][:k]
        out[q] = [(int(ids[c]), score[c]) for c in order]
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 130)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 10)
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want = brute(ids, x, ids[ids % 20 == 0], 20)
    got = {}
    for r in queries.op7_nearest_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({c for c, _ in got[q]} & {c for c, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    assert all(abs(s - x[ids == c][0] @ x[ids == q][0]) < 1e-12 for q, v in got.items() for c, s in v)


def test_estimates_hold_their_bound():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((3000, 48)), rng.standard_normal(48)
    turn = ann.rotation(48, ann.code_bits(48))
    codes, length, fit = ann.encode(x, turn)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int32)
    guess = ann.Query(q, turn).estimate(codes, ones, fit) * length * np.linalg.norm(q)
    slack = ann.BOUND * length * np.linalg.norm(q) * np.sqrt(1 - fit**2) / fit / np.sqrt(turn.shape[1] - 1)
    assert (np.abs(guess - x @ q) <= slack).mean() > 0.97


def test_vector_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.0], "a"), (3, [0.5, 0.5], "a"), (4, None, "a"),
            (5, [0.0, 0.0], "a"), (6, [inf, 0.0], "a"), (7, [nan, 1.0], "a"), (8, [None, 1.0], "a"), (9, [], "a"),
            (10, [1.0, 2.0, 3.0], "a"), (None, [1.0, 1.0], "a"), (3, [0.5, 0.5], "a"), (11, [-1.0, 0.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in ann.search(df, F.col("vec_id") == 0, 3).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.5)]
    assert len(ann.search(df, F.col("vec_id") == 0, 50).collect()) == 4
    assert ann.search(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_archives_round_trip(spark):
    body = "<p>" + "é" * 60 + "</p>\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://B.example.com/x#y", body), (2, "https://b.example.com:443/x", body), (5, None, body),
            (3, "http://a.example.com", "tiny"), (4, "http://a.example.com", "tiny"), (6, "http://u\r\nv/", None),
            (7, "x", ""), (7, "x", ""), (None, "http://n/", body), (8, "http://long/", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archive(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next((h or "") for i, _, h in rows if i == r["page_id"]).encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(text), hashlib.sha256(text).hexdigest())
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got}
    assert kinds[1] == ("response", None) and kinds[2] == kinds[5] == kinds[None] == ("revisit", 1)
    assert all(kinds[k] == ("response", None) for k in (3, 4, 6, 7, 8))
    in_order = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in in_order] == list(range(1, len(rows) + 1))
    keys = [(r["urlkey"], r["ts"], r["page_id"] or -1) for r in in_order]
    assert keys == sorted(keys) and warc.archive(pages.limit(0)).count() == 0


def test_all_pages_are_read_back(spark):
    pages = {r["page_id"]: r["html"].encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = queries.op8_warc_archive(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        data = pages[r["page_id"]]
        again = len(data) >= 100 and first[data] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (
            len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response",
            first[data] if again else None)


def test_loser_tree_merge():
    rnd = random.Random(4)
    for _ in range(200):
        runs = [sorted(rnd.randint(0, 20) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 9))]
        assert list(warc.merge(runs, lambda x: x)) == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("HTTPS://user@M.Example.com:443/A?b#c") == "com,example,m)/A?b"
    assert warc.url_key("http://x.org:8080") == "org,x:8080)/" and warc.url_key(None) == ")/"


def test_archive_matches_sql(spark):
    assert compare(queries.op8_warc_archive(spark, SF), duck(SF), oracles.ARCHIVE) is None


def test_capture_times_are_utc_in_any_session_time_zone(spark):
    pages = spark.createDataFrame([(1, "u", "h", 1704067200), (2, "v", "h", -1)], "page_id long, url string, html string, ts long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r["page_id"]: r["ts"] for r in warc.archive(pages).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {1: "2024-01-01T00:00:00Z", 2: "1969-12-31T23:59:59Z"}


def test_one_payload_everywhere_is_no_hot_key(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://h/").alias("url"),
                                    F.repeat(F.lit("x"), 200).alias("html"))
    got = warc.archive(pages).collect()
    assert sorted((r["page_id"], r["refers_to"]) for r in got) == [(0, None)] + [(k, 0) for k in range(1, 400)]


def test_conflicting_vectors_of_one_id_have_one_answer(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.25, 0.0]), (1, [0.75, 0.0]), (2, [0.5, 0.0])]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<float>").repartition(3)
        got = [(r["vec_id"], r["score"]) for r in ann.search(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
        assert got == [(2, 0.5), (1, 0.25)]
