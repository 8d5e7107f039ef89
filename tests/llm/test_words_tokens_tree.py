"""Spelling variants, token counts and Merkle proofs against brute force."""

import hashlib
import random
from collections import Counter
from zlib import crc32

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelkit.llm import merkle, oracles, queries, spelling, token_counts
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# -- spelling ---------------------------------------------------------------

LETTERS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(c) for c in range(0xC0, 0x100)}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_groups(rows):
    counts: Counter = Counter()
    for doc_id, text in rows:
        run = ""
        for char in (text or "") + " ":
            if char in LETTERS:
                run += char.lower() if char.isascii() else char
                continue
            if run:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
            run = ""
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w in vocab:
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= 5 * vocab[w] else None
    out = set()
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return out


def words_of(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_spelling_matches_sql(spark):
    assert compare(queries.op11_spelling_variants(spark, SF), duck(SF), oracles.SPELLING) is None


def test_spelling_planted_variants(spark, docs_of):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    text = []
    for word in base:
        text += [word.capitalize() if rng.random() < 0.3 else word] * rng.randint(5, 200)
        for _ in range(4):
            at = rng.randrange(len(word))
            text += [rng.choice([word[:at] + word[at + 1:], word[:at] + "ÿ" + word[at:],
                                 word[:at] + "z" + word[at + 1:]])] * rng.randint(3, 9)
    rng.shuffle(text)
    rows = [(k, ", ".join(text[k::40])) for k in range(40)]
    rows += [(None, " ".join(base) + " 東 " + base[0]), (7, None), (8, ""), (9, "a1b2 × ÷÷÷÷÷÷ " * 6)]
    rows += [rows[3], (50, ("x" * 3000 + " ") * 6), (51, ("x" * 2999 + "y ") * 7), (52, ("x" * 2999 + " ") * 40)]
    got = words_of(spelling.spelling_groups(docs_of(rows).repartition(5)))
    assert got == brute_groups(rows)
    assert any(len(w) == 3000 and f and len(f) == 2999 for w, f, *_ in got)


def test_spelling_empty(spark, empty_docs):
    assert spelling.spelling_groups(empty_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text("abcé", min_size=6, max_size=12), st.integers(0, 12), st.sampled_from("abczéÿ"), st.integers(0, 2),
       st.integers(2, 9))
def test_edits_lie_in_the_reduced_neighbourhood(word, at, char, kind, symbols):
    at %= len(word)
    other = [word[:at] + word[at + 1:], word[:at] + char + word[at:], word[:at] + char + word[at + 1:]][kind]
    table = spelling.letter_symbols(Counter(word + other), symbols)
    around = spelling.neighbourhood(spelling.reduce_word(word, table), symbols)
    assert spelling.reduced_key(spelling.reduce_word(other, table)) in around
    assert spelling.reduced_key(spelling.reduce_word(word, table)) in around
    assert len(around) <= 1 + len(word) * symbols + (len(word) + 1) * symbols


# -- tokens -----------------------------------------------------------------

TRICKY = ["", " ", "a", "I'll we've 'S 'sx  two\n\n three \t end  ", "<|endoftext|>", "x<|endoftext|><|endoftext|> y",
          "<|endof text|>", "naïve Ünïcode 東京タワー 한국어 १२३ ½ ²", "a b c\x85d\x1ce​f", "👍🏽👨‍👩‍👧 é",
          "﻿bom", "0123456789" * 40, "=" * 500, "ab" * 5000, "\U0001fae8 Ɤ \U0001e5d0 new letters", "\x00\x01\x7f",
          "don't 'tis  \r\n\r\n  x"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_of_odd_texts(spark, docs_of, library):
    rows = [(k, t) for k, t in enumerate(TRICKY)] + [(None, "no id"), (3, None), (1, " "), (99, "word " * 60_000)]
    got = token_counts.count_tokens(docs_of(rows), ["doc_id", "score"], TOKENIZER, 512).collect()
    want = Counter((i, 0.5, len((t or "").encode()), expected(library, t), expected(library, t) > 512) for i, t in rows)
    assert Counter((r.doc_id, r.score, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_token_counts_of_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = expected(library, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)


def test_small_caches_and_streamed_texts_count_the_same(monkeypatch, library):
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 3)
    monkeypatch.setattr(token_counts, "LONG_TEXT", 10)
    with open(TOKENIZER) as file:
        count = token_counts.TokenCounter(file.read(), {" the": 1, "a": 1})
    for text in [*TRICKY, "the cat and the dog " * 9]:
        assert count(text) == expected(library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_counts_as_the_library_does(text):
    with open(TOKENIZER) as file:
        tokenizer = file.read()
    if not hasattr(token_counts, "_test_counter"):
        token_counts._test_counter = token_counts.TokenCounter(tokenizer), Tokenizer.from_str(tokenizer)
    count, library = token_counts._test_counter
    text = text.encode("utf-8", "ignore").decode()
    assert count(text) == expected(library, text)


def test_packed_table_round_trip():
    table = {" the": 1, "東京": 3, "\x00a": 2, "": 0}
    assert token_counts.unpack(token_counts.pack(table)) == table
    assert token_counts.unpack(token_counts.pack({})) == {}


def test_token_counts_empty_and_refused(spark, empty_docs, tmp_path):
    assert token_counts.count_tokens(empty_docs, ["doc_id"], TOKENIZER, 512).count() == 0
    with pytest.raises(ValueError):
        token_counts.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


# -- tree -------------------------------------------------------------------

def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text) -> str:
    parts = []
    for value in (row[0], row[3], row[2], row[4], text):
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(parts))


def tree(leaves):
    """(root, siblings of every leaf left to right, level by level, with the node's place in its run)."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for k in range(len(paths)):
            run = leaves[at[k] // 16 * 16:at[k] // 16 * 16 + 16]
            paths[k].append((run[:at[k] % 16], run[at[k] % 16 + 1:]))
            at[k] //= 16
        leaves = [sha("".join(leaves[k:k + 16])) for k in range(0, len(leaves), 16)]
    return leaves[0], paths


def brute_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(row, row[1]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        built[name] = tree([x[2] for x in groups[name]])
    root, tops = tree([built[name][0] for name in names])
    out = Counter()
    for name, top in zip(names, tops):
        subroot, paths = built[name]
        for (_, _, leaf, row), path in zip(groups[name], paths):
            text, path = row[1], path + top
            if row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            cur = leaf_of(row, text)
            for left, right in path:
                cur = sha("".join(left) + cur + "".join(right))
            proof = sha("".join(x for left, right in path for x in left + right))
            out[row[0], leaf, subroot, root, proof, cur, cur == root] += 1
    return out


def manifest_of(df):
    return Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
                   for r in df.collect())


def test_merkle_matches_sql(spark):
    assert compare(queries.op13_merkle_manifest(spark, SF), duck(SF), oracles.MERKLE) is None


@pytest.mark.parametrize("size", [19, 1000])
def test_merkle_over_partitions(spark, monkeypatch, tmp_path, size):
    rng = random.Random(size)
    rows = [(rng.choice([k, None, 2**60 + k]) if rng.random() < 0.2 else k, rng.choice(["Ab É", "", None, "lower", f"T{k}"]),
             rng.choice(["en", None]), rng.choice(["hot"] * 5 + [None, "", "é", "z", f"s{k % 40}"]), rng.choice([None, 4]))
            for k in range(300)]
    rows += rows[:30] + [(1, "x" * 200_000, "en", "lone", 1)]
    monkeypatch.setattr(merkle, "ROWS_PER_PARTITION", size)
    folder = str(tmp_path / "in" / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .selectExpr("*", "'own' AS leaf", "0 AS pid", "1 AS root").write.parquet(folder)
    assert manifest_of(queries.op13_merkle_manifest(spark, str(tmp_path / "in"))) == brute_manifest(rows)


def test_merkle_small_tables(spark, docs_of, empty_docs):
    assert merkle.manifest(empty_docs, ["text"], "source", "doc_id").count() == 0
    row = merkle.manifest(docs_of([(1, "a")]), ["doc_id", "text"], "source", "doc_id", listed=True).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == sha("1:11:a")
    assert row.proof == [] and row.proof_sha256 == sha("") and row.verified


def test_missing_nodes_are_a_minimal_union():
    for size in (1, 2, 16, 17, 300, 5000):
        leaves = [sha(str(k)).encode() for k in range(size)]
        nodes, level = {(0, k): x for k, x in enumerate(leaves)}, 0
        row = leaves
        while len(row) > 1:
            row = [merkle._hash(b"".join(row[k:k + 16])) for k in range(0, len(row), 16)]
            level += 1
            nodes.update({(level, k): x for k, x in enumerate(row)})
        for first, end in ((0, size), (size // 3, size // 3 + 1), (size // 4, max(size // 4 + 1, size - 2))):
            asked = merkle.missing(first, end, size)
            assert len(asked) == len(set(asked)) and (first, end) != (0, size) or not asked
            root, proofs = merkle.expand(first, leaves[first:end], size, {k: nodes[k] for k in asked})
            assert root == row[0]
            assert all(merkle.fold(leaf, proof) == root for leaf, proof in zip(leaves[first:end], proofs))
            for gone in asked:   # nothing can be left out
                with pytest.raises(KeyError):
                    merkle.expand(first, leaves[first:end], size, {k: nodes[k] for k in asked if k != gone})


def test_tampered_rows_fail(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = merkle.manifest(docs, ["doc_id", "text"], "source", "doc_id", {"text": F.lit("changed")},
                          F.col("doc_id") % 3 == 0).select("doc_id", "verified").collect()
    assert {r.doc_id % 3 != 0 for r in got if r.verified} == {True}
    assert all(r.verified for r in got if r.doc_id % 3)
