"""MinHash near-duplicates with sequential Bayesian verification.

Banded MinHash proposes pairs; signatures are compared batch by batch and a
pair is dropped as soon as the posterior probability of reaching the
similarity threshold falls below the chosen miss probability (uniform prior,
so the posterior after m matches in n hashes is Beta(1+m, 1+n-m)); survivors
are verified exactly on their full shingle sets.

Pairs inside one bucket are never all emitted. Every bucket first links its
members to two pivots; members that are then in one component need no further
comparison, and the rest of a bucket is compared inside bounded blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import map_text, stored
from panelkit.llm.components import connected_components
from panelkit.llm.hashing import BASE, mix, rolling, span_hashes

SHINGLE = 5           # words in a shingle
ROWS, BANDS = 4, 32   # a pair at similarity 0.75 shares no band with p = 5e-6
HASHES = ROWS * BANDS
BATCH = 32            # signature entries compared per step
MISS = 1e-6           # miss probability of the pruning
BLOCK = 512           # rows of a bucket compared in one block

_rng = np.random.default_rng(20240501)
_MUL = (_rng.integers(0, 2**31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the word shingles of a text.

    Words are the runs of characters other than space and U+0009-U+000D of
    the text with A-Z lower-cased. Fewer words than a shingle make one
    shingle; no words make the empty set.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not((raw == 32) | (raw - np.uint8(9) < 5), out=inside[1:-1])
    bounds = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(bounds):
        return np.empty(0, np.uint64)
    start, end = bounds[::2], bounds[1::2]
    words = span_hashes(raw, start, end)
    width = min(SHINGLE, len(words))
    acc = mix(rolling(words, width) + np.uint64(width))
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def signature(fingerprints: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of a non-empty set, one per hash function."""
    x = fingerprints.astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(x), 2048):  # bounded memory for very long texts
        part = x[start:start + 2048, None] * _MUL[None, :] + _ADD[None, :]
        best = np.minimum(best, part.min(axis=0))
    return best


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """One 64-bit key per row of signatures and band, over the band's number and values."""
    parts = sigs.astype(np.uint64).reshape(len(sigs), BANDS, ROWS)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        acc = mix(acc * BASE + parts[:, :, k])
    return acc.view(np.int64)


def match_floor(threshold: float, miss: float = MISS) -> list[int]:
    """Fewest matches after each batch that keep a pair alive.

    P(Beta(1+m, 1+n-m) >= t) = P(Binomial(n+1, t) <= m).
    """
    floors = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        floors.append(m)
    return floors


def _sign(texts: list) -> dict[str, list]:
    sets = [shingle_set(text) for text in texts]
    full = [k for k, fp in enumerate(sets) if len(fp)]
    sigs = np.stack([signature(sets[k]) for k in full]) if full else np.empty((0, HASHES), np.uint32)
    sigs = sigs.astype(np.uint16)  # bands and comparisons see the same values
    out: dict[str, list] = {c: [None] * len(texts) for c in ("set_hash", "sig", "bands")}
    for k, sig, keys in zip(full, sigs, band_keys(sigs)):
        out["set_hash"][k] = xxhash.xxh3_128_digest(sets[k].tobytes())
        out["sig"][k], out["bands"][k] = sig.tobytes(), keys
    return {"n_shingles": [len(fp) for fp in sets], **out}


def _sets(texts: list) -> dict[str, list]:
    return {"shingles": [shingle_set(t).tobytes() for t in texts]}


def near_duplicates(docs: DataFrame, threshold: float = 0.75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    Two documents link when the Jaccard similarity of their shingle sets is
    at least ``threshold`` (in hundredths); ``component_id`` is the smallest
    id reachable over links and ``kept`` marks that document.

    Defined cases: null or empty text has the empty set and links with
    nothing; equal sets always link; rows with a null id return one row with
    null id and component and ``kept`` true; several rows of one id return
    one row, with the largest set size and the smallest component of its
    texts; an empty table gives an empty result; other columns are ignored.
    """
    percent = round(threshold * 100)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = texts.where("doc_id IS NOT NULL")
    signed = stored(map_text(known, ["doc_id"], "text",
                             "n_shingles long, set_hash binary, sig binary, bands array<long>",
                             _sign), "signatures")
    copies = stored(signed.where("n_shingles > 0").groupBy("set_hash")
                    .agg(F.min("doc_id").alias("rep")), "copies")
    reps = stored(signed.drop("set_hash").join(
        copies.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .where("n_shingles > 0"), "representatives")
    sigs = reps.select("doc_id", "n_shingles", "sig")

    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    buckets = (banded.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_id").alias("lo"),
                                         F.max("doc_id").alias("hi")).where("lo < hi"))
    members = stored(banded.join(buckets, "key"), "buckets")

    # Sets of the documents that share a bucket. Their number grows with the
    # corpus, so the ids are shuffled, not broadcast.
    sets = stored(map_text(
        known.join(members.select("doc_id").distinct().hint("shuffle_merge"), "doc_id", "left_semi"),
        ["doc_id"], "text", "shingles binary", _sets), "sets")

    # Round 1: every member against the two pivots of its bucket.
    pivots = (members.select("doc_id", F.explode(F.array("lo", "hi")).alias("pivot"))
              .where("pivot <> doc_id")
              .select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b"))
              .distinct())
    first = connected_components(verify(_prune(pivots, sigs, threshold, percent), sets, percent))

    # Round 2: what is left of the buckets that still hold several components.
    merged = connected_components(
        _blocks(members.where("size > 3"), first, sigs, sets, threshold, percent))

    found = (copies.join(first.select(F.col("doc_id").alias("rep"), F.col("component_id").alias("c1")),
                         "rep", "left")
             .select("set_hash", F.coalesce("c1", "rep").alias("c1"))
             .join(merged.select(F.col("doc_id").alias("c1"), F.col("component_id").alias("c2")),
                   "c1", "left")
             .select("set_hash", F.coalesce("c2", "c1").alias("c")))
    full = signed.where("set_hash IS NOT NULL").select("doc_id", "n_shingles", "set_hash").join(found, "set_hash")
    bare = signed.where("set_hash IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("c"))
    whole = (full.select("doc_id", "n_shingles", "c").unionByName(bare)  # empty sets meet nothing, so they join nothing
             .groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("c").alias("component_id"))
             .withColumn("kept", F.col("doc_id") == F.col("component_id")))
    nameless = map_text(texts.where("doc_id IS NULL"), ["doc_id"], "text", "n_shingles long",
                        lambda ts: {"n_shingles": [len(shingle_set(t)) for t in ts]})
    return whole.unionByName(nameless.select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept")))


def _prune(pairs: DataFrame, sigs: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Pairs (a, b) that the sequential comparison of signatures leaves."""
    floors = match_floor(threshold)
    a = sigs.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    b = sigs.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    sized = pairs.join(a, "a").join(b, "b").where(
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16)
                      .reshape(-1, HASHES) for k in (2, 3))
            alive = _sequential(sa, sb, np.arange(len(sa)), np.arange(len(sb)), floors)
            yield batch.select([0, 1]).take(pa.array(alive))

    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _sequential(sa: np.ndarray, sb: np.ndarray, i: np.ndarray, j: np.ndarray,
                floors: list[int]) -> np.ndarray:
    """Positions in (i, j) whose pairs survive every batch."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    for step, floor in enumerate(floors):
        span = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (sa[i[alive], span] == sb[j[alive], span]).sum(axis=1)
        keep = matches >= floor
        alive, matches = alive[keep], matches[keep]
    return alive


def _blocks(members: DataFrame, comps: DataFrame, sigs: DataFrame, sets: DataFrame,
            threshold: float, percent: int) -> DataFrame:
    """Links (a, b) between components, found bucket by bucket in bounded blocks.

    The members outside a bucket's largest component are compared with all
    members of other components. Blocks hold at most about BLOCK rows on each
    side; a pair that shares an earlier band is left to that band's bucket.
    Survivors of the sequential comparison are verified on their full sets,
    likeliest first; once two components are linked their other pairs are
    redundant.
    """
    rows = (members.where("doc_id <> lo AND doc_id <> hi").select("key", "band", "doc_id")
            .join(comps, "doc_id", "left")
            .select("key", "band", "doc_id", F.coalesce("component_id", "doc_id").alias("comp")))
    rows = stored(rows, "members")
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = (sizes.groupBy("key").agg(F.sum("n").alias("total"), F.max("n").alias("most"),
                                     F.max_by("comp", F.struct("n", "comp")).alias("main"))
            .where("most < total")
            .select("key", "main", F.ceil(F.col("total") / BLOCK).alias("nb"),
                    F.ceil((F.col("total") - F.col("most")) / BLOCK).alias("ns")))
    dealt = (rows.join(main, "key").join(sigs, "doc_id").join(sets, "doc_id")
             .withColumn("h", F.xxhash64("doc_id")).withColumn("odd", F.col("comp") != F.col("main")))
    cols = ["key", "band", "doc_id", "comp", "n_shingles", "sig", "shingles", "odd"]
    left = dealt.where("odd").select(
        *cols, F.lit(True).alias("side"), F.expr("pmod(h, ns)").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("j"))
    right = dealt.select(
        *cols, F.lit(False).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("ns") - 1)).alias("i"),
        F.expr("pmod(h, nb)").alias("j"))
    floors = match_floor(threshold)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        band = int(pdf["band"].iloc[0])
        s, t = pdf[pdf["side"]], pdf[~pdf["side"]]
        links: list[tuple[int, int]] = []
        if not s.empty and not t.empty:
            ids, idt = s["doc_id"].to_numpy(), t["doc_id"].to_numpy()
            ns, nt = s["n_shingles"].to_numpy(), t["n_shingles"].to_numpy()
            cs, ct = s["comp"].to_numpy(), t["comp"].to_numpy()
            ok = cs[:, None] != ct[None, :]
            ok &= ~t["odd"].to_numpy()[None, :] | (ids[:, None] < idt[None, :])
            ok &= np.minimum(ns[:, None], nt) * 100 >= np.maximum(ns[:, None], nt) * percent
            i, j = np.nonzero(ok)
            sa = np.frombuffer(b"".join(s["sig"]), np.uint16).reshape(-1, HASHES)
            sb = np.frombuffer(b"".join(t["sig"]), np.uint16).reshape(-1, HASHES)
            left_sets, right_sets = s["shingles"].to_numpy(), t["shingles"].to_numpy()
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while (p := root.get(c, c)) != c:
                    c = p
                return c

            for start in range(0, len(i), 1 << 16):
                pi, pj = i[start:start + (1 << 16)], j[start:start + (1 << 16)]
                alive = _sequential(sa, sb, pi, pj, floors)
                pi, pj = pi[alive], pj[alive]
                equal = sa[pi] == sb[pj]
                same = equal.reshape(-1, BANDS, ROWS).all(axis=2)
                order = np.argsort(-equal.sum(axis=1), kind="stable")
                for k in order[~same[order, :band].any(axis=1)]:
                    p, q = pi[k], pj[k]
                    cp, cq = find(cs[p]), find(ct[q])
                    if cp != cq and _reaches(left_sets[p], right_sets[q], percent):
                        root[max(cp, cq)] = min(cp, cq)
                        links.append((min(ids[p], idt[q]), max(ids[p], idt[q])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    found = left.unionByName(right).groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")
    firsts = comps.select(F.col("doc_id").alias("a"), F.col("component_id").alias("ca"))
    return (stored(found, "links").join(firsts, "a", "left")
            .join(firsts.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))


def _reaches(x: bytes, y: bytes, percent: int) -> bool:
    """100 |A∩B| >= percent |A∪B| for two stored sets."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    merged = np.concatenate((p, q))
    merged.sort(kind="stable")
    both = int((merged[1:] == merged[:-1]).sum())
    return both > 0 and 100 * both >= percent * (len(merged) - both)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    joined = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
              .select("a", "b", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_reaches(x.as_buffer(), y.as_buffer(), percent)
                  for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")
