"""Benchmark decontamination by template canonicalisation.

Texts become sequences of canonical words in which numbers, units and names
are typed placeholders. Windows of such words are hashed together with the
pattern of equal slot values; windows of documents that occur in the benchmark
are found by a hash join, and the slot values of the windows a copy shares
with an item must map consistently, so that re-parameterised copies are caught
and chance matches of mere templates are not. Every copy is judged by itself.
Every item is matched by its actual words, too (case aside), so that a copy
which writes names in another case, or an item too short or too poor in
literal words for template windows, is found as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import slices, stored
from panelkit.llm.hashing import mix, rolling, span_hashes

WINDOW = 8            # canonical words in a window
LITERALS = 5          # words in a window that are no placeholder, at least
COVERAGE = 0.5        # share of an item's windows that makes a leak
RUN = 6               # or so many windows on one alignment (13 words)
CONSISTENCY = 0.8     # share of slot values that must map one to one
FILTER_BITS = 1 << 23  # bits of the benchmark filter sent to the tasks (1 MB)

# Unit words.
UNITS = """
mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hrs ms hz khz mhz ghz w kw v a j kj n pa
inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers gram grams
kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes
hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent
degree degrees usd eur gbp
""".split()
LITERAL, NUM, UNIT, NAME = range(4)
_CODES = mix(np.arange(1, 5, dtype=np.uint64))
_PLAIN = mix(np.arange(WINDOW + 1, dtype=np.uint64) + np.uint64(1 << 32))  # sets windows of actual words apart

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    gaps = np.flatnonzero(raw == 32)
    return np.sort(span_hashes(raw, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)]))))


_UNITS = _unit_hashes()


def _words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, hash, whether it continues a name) of every word of a text.

    Words are runs of letters (bytes from 128 up count as letters, an
    apostrophe between letters too) or numbers (digits with . , : / between
    digits). A number is <num>; a unit word after a number <unit>; a run of
    capitalised words that do not begin a sentence, one <name>; single letters
    and words that begin with two capitals are none, so that a text all in
    capitals keeps its words. Hashes are of the lower-cased word; punctuation
    only marks sentence starts.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    pad = np.zeros(len(raw) + 2, np.uint8)
    pad[1:-1] = raw
    digit = pad - np.uint8(48) < 10
    letter = _LETTER.take(pad)
    inner = (pad[1:-1] == 46) | (pad[1:-1] == 44) | (pad[1:-1] == 58) | (pad[1:-1] == 47)
    digit[1:-1] |= inner & digit[:-2] & digit[2:]
    letter[1:-1] |= (pad[1:-1] == 39) & letter[:-2] & letter[2:]
    kind_at = digit.astype(np.int8) + 2 * letter.astype(np.int8)
    change = np.flatnonzero(kind_at[1:] != kind_at[:-1])  # a span begins or ends at raw[change]
    if not len(change):
        return np.empty(0, np.int8), np.empty(0, np.uint64), np.empty(0, bool)
    begin, finish = change[:-1], change[1:]
    word = kind_at[begin + 1] > 0
    start, end = begin[word], finish[word]
    upper = raw - np.uint8(65) < 26
    accented = np.zeros(len(raw), bool)
    accented[1:] = (raw[:-1] == 0xC3) & (raw[1:] - np.uint8(0x80) < 0x1F) & (raw[1:] != 0x97)
    low = raw + np.where(upper | accented, np.uint8(32), np.uint8(0))
    hashes = span_hashes(low, start, end)
    kind = np.where(digit[start + 1], NUM, LITERAL).astype(np.int8)
    after_num = np.flatnonzero(kind[:-1] == NUM) + 1
    if len(after_num):
        after_num = after_num[kind[after_num] == LITERAL]
        kind[after_num[np.isin(hashes[after_num], _UNITS)]] = UNIT
    stops = np.zeros(len(raw) + 1, np.int32)
    np.cumsum((raw == 46) | (raw == 33) | (raw == 63) | (raw == 10), out=stops[1:])
    after = np.zeros(len(start), bool)
    after[1:] = stops[start[1:]] == stops[end[:-1]]
    wide = accented.take(start + 1, mode="clip")  # an accented capital takes two bytes
    second = start + 1 + wide
    shouted = upper.take(second, mode="clip") | accented.take(second + 1, mode="clip")
    name = (kind == LITERAL) & after & (upper[start] | wide) & (second < end) & ~shouted
    kind[name] = NAME
    again = np.zeros(len(start), bool)
    again[1:] = name[1:] & name[:-1]
    return kind, hashes, again


def canonical(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(kind, word hash) of the canonical words of a text: its words, a run of name words being one."""
    kind, hashes, again = _words(text)
    if again.any():
        heads = np.flatnonzero(~again)
        hashes = np.add.reduceat(hashes, heads)
        kind = kind[heads]
    return kind, hashes


def windows(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hashes, slot values of every word, 0 for literals) of the usable windows.

    The hash covers the canonical words and which slots of the window hold
    equal values. A text shorter than a window is one window. Windows with
    fewer than LITERALS literal words (or any placeholder, in a shorter text)
    are left out.
    """
    kind, hashes = canonical(text)
    size = min(WINDOW, len(kind))
    slot = kind != LITERAL
    value = np.where(slot, hashes, np.uint64(0))
    if not size:
        return np.empty(0, np.int64), np.empty(0, np.int64), value
    acc = rolling(np.where(slot, _CODES[kind], hashes), size)
    n = len(acc)
    if slot.any():
        for lag in range(1, size):
            equal = slot[:-lag] & (value[:-lag] == value[lag:])
            if equal.any():
                for at in range(size - lag):
                    weight = mix(np.array([lag * 64 + at + 1], np.uint64))[0]
                    acc += np.where(equal[at:at + n], weight, np.uint64(0))
    literals = np.concatenate(([0], np.cumsum(~slot)))
    usable = literals[size:] - literals[:-size] >= (LITERALS if size == WINDOW else size)
    at = np.flatnonzero(usable)
    return at, mix(acc + np.uint64(size))[at].view(np.int64), value


def plain_windows(text: str | None, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hashes, no slot values of every word) of the windows of actual words, without placeholders."""
    hashes = _words(text)[1]
    ats, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size in sizes:
        if size <= len(hashes):
            keys.append(mix(mix(rolling(hashes, size)) + _PLAIN[size]).view(np.int64))
            ats.append(np.arange(len(keys[-1])))
    return np.concatenate(ats), np.concatenate(keys), np.zeros(len(hashes), np.uint64)


def item_windows(text: str | None) -> list[tuple[tuple[np.ndarray, np.ndarray, np.ndarray], int]]:
    """The windows of a benchmark item: those of canonical words (size 0), then those of actual words with their size.

    Windows of actual words have WINDOW words, or all of a shorter item. An
    item of fewer than WINDOW canonical words has no others.
    """
    made, size = windows(text), min(WINDOW, len(_words(text)[0]))
    own = [(plain_windows(text, [size] if size else []), size)]
    return [(made, 0), *own] if len(made[0]) and len(made[2]) >= WINDOW else own


def _window_rows(df: DataFrame, bits: bytes | None, sizes: list[int] | None = None) -> DataFrame:
    """(id, part, words, plain, at, key, slots) of the windows of (id, text); without ``bits``, of items.

    ``part`` tells the texts of one id apart, ``words`` is the text's length,
    ``plain`` the size of windows of actual words (0: of canonical words). Of
    documents, only keys in the filter ``bits`` are given; windows of actual
    words are made in ``sizes``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else np.frombuffer(bits, np.uint8)
        for batch in slices(batches, "text"):
            ids, parts, lengths, plain, ats, keys, slots = [], [], [], [], [], [], []
            for i, text, part in zip(*(c.to_pylist() for c in batch.columns)):
                if known is None:
                    found = [(*made, size) for made, size in item_windows(text)]
                else:
                    found = [(*windows(text), 0)] + ([(*plain_windows(text, sizes), WINDOW)] if sizes else [])
                for at, key, value, size in found:
                    if known is not None:
                        place = key & (FILTER_BITS - 1)
                        hit = known.take(place >> 3) >> (place & 7).astype(np.uint8) & 1 > 0
                        at, key = at[hit], key[hit]
                    ids += [i] * len(at)
                    parts += [part] * len(at)
                    lengths += [len(value)] * len(at)
                    plain += [size] * len(at)
                    ats += at.tolist()
                    keys += key.tolist()
                    slots += [[v for v in value[k:k + WINDOW].view(np.int64).tolist() if v] for k in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(parts, pa.int64()), pa.array(lengths, pa.int32()),
                 pa.array(plain, pa.int32()), pa.array(ats, pa.int32()), pa.array(keys, pa.int64()), pa.array(slots, pa.list_(pa.int64()))],
                names=["id", "part", "words", "plain", "at", "key", "slots"])

    return df.withColumn("part", F.xxhash64("text")).mapInArrow(
        run, "id long, part long, words int, plain int, at int, key long, slots array<long>")


def _filter(keys: DataFrame) -> bytes:
    """One bit per benchmark key modulo FILTER_BITS: a fixed number of bytes at any size."""
    place = F.pmod("key", F.lit(FILTER_BITS)) + 1  # Spark numbers bitmap positions from 1
    parts = (keys.groupBy(F.bitmap_bucket_number(place).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    out = bytearray(FILTER_BITS // 8)
    for r in parts:
        out[(r["part"] - 1) * 4096:r["part"] * 4096] = r["bits"]
    return bytes(out)


PAIR, ALIGNMENT, NEAR, NEAR_SHIFTED = range(4)


def _places(hits: DataFrame) -> DataFrame:
    """Every hit once for each group of hits it is judged with.

    Hits of canonical and of actual words are judged apart. A group is the
    whole pair of document and item, one alignment of one text of either, or alignments that differ by less than the item's length (two
    copies of an item lie at least its length apart). The latter are cut into
    steps of that length, and again half a step further on, so that a copy
    with insertions is whole in one of the two.
    """
    part, item, offset, words = F.col("doc_part"), F.col("item_part"), F.col("at") - F.col("item_at"), F.col("words")
    none = F.lit(None).cast("long")

    def group(level: int, doc_part, item_part, place):
        return F.struct(F.lit(level).alias("level"), (F.col("plain") > 0).alias("actual"), doc_part.alias("doc_part"),
                        item_part.alias("item_part"), place.cast("long").alias("place"))

    groups = F.array(group(PAIR, none, none, F.lit(0)), group(ALIGNMENT, part, item, offset),
                     group(NEAR, part, item, F.floor(offset / words)),
                     group(NEAR_SHIFTED, part, item, F.floor((offset + F.floor(words / 2)) / words)))
    # Alignments are told apart by the texts, too: rows of one id may hold different ones.
    return hits.select("doc_id", "item_id", F.xxhash64(part, item, offset).alias("offset"), "item_at", "item_slots",
                       "slots", F.explode(groups).alias("g")).select("*", "g.*").drop("g")


def _same(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join on equal keys, where null equals null."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in key})
    on = [left[k].eqNullSafe(other[f"_{k}"]) for k in key]
    return left.join(other, on, how).drop(*[f"_{k}" for k in key])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, windows, coverage, consistency) of contaminated documents.

    ``matched`` of the item's ``windows`` distinct windows occur in the
    document. A pair is a leak when in one group of its hits (:func:`_places`)
    the coverage reaches COVERAGE or RUN windows lie on one alignment, and the
    slot values map consistently; the group with most windows is reported.

    Defined cases: null or empty texts have no windows; rows with a null id
    take no part; repeated rows of one id count as one document with all
    their windows, and each also by itself; empty tables give an empty result;
    other columns of either table are ignored.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").where("id IS NOT NULL")
    item_rows = stored(_window_rows(items, None).select(
        F.col("id").alias("item_id"), F.col("part").alias("item_part"), "words", "plain", F.col("at").alias("item_at"),
        "key", F.col("slots").alias("item_slots")), "items")
    bits = _filter(item_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id IS NOT NULL")
    sizes = [r["plain"] for r in item_rows.where("plain > 0").select("plain").distinct().collect()]  # 1 to WINDOW
    doc_rows = (_window_rows(texts, bits, sizes).withColumnsRenamed({"id": "doc_id", "part": "doc_part"})
                .drop("words", "plain"))
    hits = stored(doc_rows.join(item_rows, "key"), "hits")
    sized = item_rows.withColumn("actual", F.col("plain") > 0)
    totals = (sized.groupBy("item_id", "actual", "item_part").agg(F.count_distinct("item_at").alias("windows"))
              .unionByName(sized.groupBy("item_id", "actual").agg(F.count_distinct("item_at").alias("windows"))
                           .withColumn("item_part", F.lit(None).cast("long"))))
    places = _places(hits)
    key = ["doc_id", "item_id", "level", "actual", "doc_part", "item_part", "place"]
    runs = (places.groupBy(*key, "offset").agg(F.count_distinct("item_at").alias("run"))
            .groupBy(*key).agg(F.max("run").alias("run")))
    matched = places.groupBy(*key).agg(F.count_distinct("item_at").alias("matched"))
    values = (places.select(*key, F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
              .select(*key, F.col("z.item_slots").alias("theirs"), F.col("z.slots").alias("ours"))
              .distinct().groupBy(*key)
              .agg(F.least(F.count_distinct("theirs"), F.count_distinct("ours")).alias("one"),
                   F.count("*").alias("pairs")))
    evidence = _same(_same(matched, runs, key, "inner"), values, key, "left")
    passed = (_same(evidence, totals, ["item_id", "actual", "item_part"], "inner")
              .withColumn("coverage", F.col("matched") / F.col("windows"))
              .withColumn("consistency", F.coalesce(F.col("one") / F.col("pairs"), F.lit(1.0)))
              .where((F.col("coverage") >= COVERAGE) | (F.col("run") >= RUN))
              .where(F.col("consistency") >= CONSISTENCY))
    best = F.max(F.struct("matched", "coverage", "consistency", "windows"))
    return (passed.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.matched", "b.windows", "b.coverage", "b.consistency"))
