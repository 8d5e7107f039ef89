"""MinHash near-dedup against brute force."""

import random
import re

import numpy as np

from panelkit.llm import minhash_dedup as M
from panelkit.llm import oracles, queries
from panelkit.llm.components import connected_components
from tests.oracle_compare import compare, duck

WORDS = [f"w{k}" for k in range(400)]


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: brute_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_components_equal_brute_force(docs_of):
    rnd = random.Random(3)
    rows, base = [], [rnd.choice(WORDS) for _ in range(120)]
    for i in range(90):  # one group of near copies with more and more edits
        words = list(base)
        for _ in range(rnd.randint(0, 12)):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        rows.append((1000 - i, " ".join(words)))
    for i in range(60):
        rows.append((2000 + i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 40)))))
    rows += [(3000, None), (3001, ""), (3002, " \n\t"), (3003, "One two"), (3004, "one\x0btwo "),
             (3005, "a b c d e"), (3006, "A B C D E"), (3007, "x " * 30_000), (3008, "X " * 20_000),
             (3009, "é É"), (3010, "É é")]
    got = {r["doc_id"]: r for r in M.near_duplicates(docs_of(rows)).collect()}
    want = brute(rows)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_block_size_does_not_change_the_result(docs_of, monkeypatch):
    rnd = random.Random(5)
    base = [rnd.choice(WORDS) for _ in range(60)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(60)] = rnd.choice(WORDS)
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(M, "BLOCK", 7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in M.near_duplicates(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_repeated_rows_and_null_ids(docs_of, empty_docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (None, None)]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in
                  M.near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == [(1, 1, True), (2, 1, False), (None, None, True), (None, None, True)]
    assert M.near_duplicates(empty_docs).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    floors = M.match_floor(0.75)
    assert floors == sorted(floors) and floors[-1] < 0.75 * M.HASHES
    hits = np.random.default_rng(1).random((20_000, M.HASHES)) < 0.75
    alive = np.ones(len(hits), bool)
    for k, floor in enumerate(floors):
        alive &= hits[:, :(k + 1) * M.BATCH].sum(axis=1) >= floor
    assert alive.mean() > 0.999


def test_components_of_paths_and_hubs(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r["doc_id"]: r["component_id"] for r in
           connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{100 + k: 100 for k in range(30)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_match_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(queries.op9_minhash_dedup(spark, sf), duck(sf), oracles.NEAR_DUPLICATES) is None
