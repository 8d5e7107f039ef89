"""Spelling variants: words one edit apart, grouped under their commonest form.

Letters are hashed to a few symbols. Every word's reduced form gets its full
one-edit neighbourhood (all deletions, replacements and insertions over the
few symbols, and the form itself), which is joined with the reduced
vocabulary; whatever meets there is verified on the original words. An edit of
a word is an edit or a repetition of its reduced form, so no pair is lost.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import slices, stored
from panelkit.llm.hashing import BASE, mix

MIN_CHARS = 6       # shortest word, in code points
MIN_COUNT = 5       # fewest occurrences of a word
FACTOR = 5          # a form occurs at least so many times as often as its variant
DROP_EVERY = 199    # an occurrence loses a letter where this divides its hash
FLUSH_WORDS = 200_000   # distinct words a task holds before it hands their counts on
TASK_WORDS = 50_000     # words whose neighbourhoods one task makes, about
KEY_ROWS = 4096     # neighbourhood keys in one row of a batch
LONG_TEXT = 1 << 22

# Maximal runs of A-Z, a-z and U+00C0-U+00FF; shorter runs than MIN_CHARS make no word. Texts are matched as
# Latin-1 bytes (other characters become a question mark, which ends a run as they do) with A-Z lower-cased.
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % MIN_CHARS)


def _utf8(run: bytes) -> bytes:
    return run if run.isascii() else run.decode("latin-1").encode("utf-8")


def text_words(doc_id, text: str | None) -> Counter:
    """Words (Latin-1 bytes) of one text and their counts; the id decides which occurrences lose a letter."""
    out: Counter = Counter()
    raw = (text or "").encode("latin-1", "replace").lower()
    runs = map(itemgetter(0), _RUN.finditer(raw)) if len(raw) > LONG_TEXT else _RUN.findall(raw)
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs).items():
        h = crc32(_utf8(run), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_CHARS:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts with at least MIN_COUNT occurrences.

    Tasks hand on counts, not occurrences, so a word that is everywhere costs
    a few rows per task.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in seen], pa.string()),
                                               pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return made

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update(text_words(doc_id, text))
                if len(seen) >= FLUSH_WORDS:
                    yield flush()
        yield flush()

    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet: about as many as give words of MIN_CHARS + 1 letters a reduced form each."""
    return max(4, math.ceil(words ** (1 / (MIN_CHARS + 1))))


def letter_symbols(letters: dict[str, int], symbols: int) -> np.ndarray:
    """The hash of letters to symbols 1 to ``symbols``, as a table by Latin-1 code.

    Letters go by falling count to the symbol that has the fewest so far, so
    that reduced words spread evenly; any table would give the same result.
    """
    table, load = np.zeros(256, np.uint64), [0] * symbols
    for letter, n in sorted(letters.items(), key=lambda item: (-item[1], item[0])):
        at = load.index(min(load))
        load[at] += n
        table[ord(letter)] = at + 1
    return table


def reduce_word(word: str, table: np.ndarray) -> np.ndarray:
    """The symbols that the word's letters are hashed to."""
    return table[np.frombuffer(word.encode("latin-1"), np.uint8)]


def reduced_key(reduced: np.ndarray) -> int:
    """A 64-bit key of a reduced word: the sum of its symbols times the powers of a base, scrambled."""
    return int(mix(_terms(reduced).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _terms(reduced: np.ndarray) -> np.ndarray:
    return reduced * _powers(len(reduced))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def neighbourhood(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Distinct keys of the reduced word and of everything one edit away over the reduced alphabet."""
    size = len(reduced)
    power = _powers(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_terms(reduced), out=sums[1:])
    total, letters = sums[-1], np.arange(1, symbols + 1, dtype=np.uint64)
    down = np.uint64(pow(int(BASE), -1, 2**64))
    deleted = sums[:-1] + (total - sums[1:]) * down
    replaced = total + (letters[None, :] - reduced[:, None]) * power[:-1, None]
    inserted = (sums + (total - sums) * BASE)[:, None] + letters[None, :] * power[:, None]
    return np.unique(mix(np.concatenate((deleted, replaced.ravel(), inserted.ravel(), sums[-1:])))).view(np.int64)


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words exactly one code point edit apart.

    Long words travel as 64-bit ids until they are verified, so that a
    neighbourhood costs its keys only; words that share an id meet all words
    they may belong to, and the verification decides.
    """
    size = vocab.count()
    symbols = symbols_for(size)
    letters = vocab.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()  # 90 at most
    table = letter_symbols(dict(map(tuple, letters.collect())), symbols)
    tasks = max(int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_WORDS))
    words = vocab.select(F.xxhash64("word").alias("id"), "word", "n")

    def keys(own: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, got = [], []
                for word_id, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    reduced = reduce_word(word, table)
                    made = np.array([reduced_key(reduced)]) if own else neighbourhood(reduced, symbols)
                    for start in range(0, len(made), KEY_ROWS):
                        ids.append(word_id)
                        got.append(made[start:start + KEY_ROWS])
                        if len(ids) >= KEY_ROWS:
                            yield flat(ids, got)
                            ids, got = [], []
                if ids:
                    yield flat(ids, got)

        def flat(ids: list, got: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), [len(g) for g in got])),
                                               pa.array(np.concatenate(got).astype(np.int64))], ["id", "key"])

        return words.select("id", "word").repartition(tasks).mapInArrow(run, "id long, key long")

    reduced = keys(True).select(F.col("id").alias("id2"), "key")
    met = keys(False).join(reduced, "key").where("id <= id2").select("id", "id2").distinct()
    a = words.select("id", F.col("word").alias("wa"), F.col("n").alias("na"))
    b = words.select(F.col("id").alias("id2"), F.col("word").alias("wb"), F.col("n").alias("nb"))
    pairs = (met.join(a, "id").join(b, "id2")
             .where(F.abs(F.length("wa") - F.length("wb")) <= 1)
             .where(F.levenshtein("wa", "wb", 1) == 1)
             .select(F.least("wa", "wb").alias("wa"), F.greatest("wa", "wb").alias("wb"),
                     F.when(F.col("wa") < F.col("wb"), F.struct("na", "nb"))
                     .otherwise(F.struct(F.col("nb").alias("na"), F.col("na").alias("nb"))).alias("c"))
             .distinct())
    sides = F.array(F.struct(F.col("wa").alias("word"), F.col("c.na").alias("n"), F.col("wb").alias("near"),
                             F.col("c.nb").alias("near_n")),
                    F.struct(F.col("wb").alias("word"), F.col("c.nb").alias("n"), F.col("wa").alias("near"),
                             F.col("c.na").alias("near_n")))
    return pairs.select(F.explode(sides).alias("s")).select("s.*")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary.

    ``form`` is the near word with the most occurrences (ties: the smallest in
    code-point order) if it occurs FACTOR times as often as the word, else
    null; ``root`` follows forms to the last.

    Defined cases: null and empty texts hold no words; a null id counts as the
    empty string in the hash that drops letters; repeated rows count again; an
    empty table gives an empty result; other columns are ignored.
    """
    vocab = stored(vocabulary(docs, id_col, text_col), "vocabulary")
    best = (near_words(vocab).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")))
    known = vocab.join(best, "word", "left")
    is_form = F.coalesce(-F.col("best.m") >= FACTOR * F.col("n"), F.lit(False))
    known = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(is_form, F.col("best.near")).alias("form"),
                                F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    point = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:   # counts grow FACTOR-fold along forms, so a few doublings reach every root
        further = point.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(point.join(further, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"),
                               F.col("next").isNotNull().alias("moved")), "roots")
        point = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return (known.join(point, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
