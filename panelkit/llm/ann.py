"""Approximate nearest neighbours with randomly rotated one-bit codes.

Every vector is normalised, rotated into CODE_BITS dimensions and kept as one
bit per dimension with two correction scalars (its length, and the inner
product of the code with the rotated vector). Inner products with a query are
estimated from the packed bits; candidates whose estimate plus error bound
reaches the best known k-th score are ranked by the exact inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import stored

CODE_BITS = 256        # at least; more where the vectors have more dimensions
BOUND = 2.5            # standard deviations of the estimate in the error bound
QUERY_BITS = 4         # bits per query dimension
CANDIDATE_BLOCK = 16384
QUERY_BLOCK = 1024


def rotation(dim: int, bits: int) -> np.ndarray:
    """A random orthonormal map of ``dim`` dimensions into ``bits`` (dim x bits)."""
    draw = np.random.default_rng(7).standard_normal((bits, dim))
    return np.linalg.qr(draw)[0].T


def code_bits(dim: int) -> int:
    return max(CODE_BITS, -(-dim // 64) * 64)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed codes, lengths, <code, rotated unit vector>) of the rows of x."""
    length = np.linalg.norm(x, axis=1)
    rotated = (x / length[:, None]) @ turn
    bits = rotated > 0
    fit = np.abs(rotated).sum(axis=1) / math.sqrt(turn.shape[1])
    return np.packbits(bits, axis=1).view(np.uint64), length, fit


class Query:
    """A query's rotated unit vector, quantised to bit planes."""

    def __init__(self, q: np.ndarray, turn: np.ndarray) -> None:
        self.length = float(np.linalg.norm(q))
        rotated = q / self.length @ turn
        self.low = rotated.min()
        self.step = max((rotated.max() - self.low) / (2**QUERY_BITS - 1), 1e-12)
        level = np.rint((rotated - self.low) / self.step).astype(np.uint8)
        self.planes = [np.packbits(level >> j & 1).view(np.uint64) for j in range(QUERY_BITS)]
        self.total = float(self.low * len(rotated) + self.step * level.sum(dtype=np.int64))
        self.bits = len(rotated)

    def estimate(self, codes: np.ndarray, ones: np.ndarray, fit: np.ndarray) -> np.ndarray:
        """Estimated inner products of the unit vectors."""
        weighted = np.zeros(len(codes), np.int32)
        for j, plane in enumerate(self.planes):
            count = np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int32)
            weighted += count << j
        inside = self.step * weighted + self.low * ones
        return (2 * inside - self.total) / math.sqrt(self.bits) / fit


def top(query: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, codes: np.ndarray, ones: np.ndarray,
        length: np.ndarray, fit: np.ndarray, spread: np.ndarray, turn: np.ndarray,
        k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, exact scores) of the k best candidates of a block, ties to the smaller id."""
    q = Query(query, turn)
    guess = q.estimate(codes, ones, fit) * length * q.length
    guess[ids == own] = -np.inf
    slack = spread * q.length
    n = min(k, len(ids))
    first = np.argpartition(-guess, n - 1)[:n]
    first = first[ids[first] != own]
    floor = (x[first] @ query).min() if len(first) == n else -np.inf
    chosen = np.flatnonzero((guess + slack >= floor) & (ids != own))
    chosen = np.union1d(chosen, first)
    score = (x[chosen] * query).sum(axis=1)
    best = np.lexsort((ids[chosen], -score))[:k]
    return ids[chosen][best], score[best]


def _finite(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) \
        & F.exists(v, lambda e: e != 0)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by inner product of every query row.

    All rows are candidates for all queries but themselves; every row is
    coded. Queries and candidates meet in blocks of at most about
    QUERY_BLOCK x CANDIDATE_BLOCK rows. Left out: rows with a null id, null,
    zero or empty vectors, vectors with null or non-finite components, and
    vectors whose dimension is not the table's most frequent one. Of several
    vectors of one id the least (compared component by component) counts. Equal scores go to the smaller id. Fewer than k
    candidates give fewer rows; an empty table gives an empty result.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
            .where(F.col("vec_id").isNotNull() & _finite(F.col("v")))
            .groupBy("vec_id").agg(F.min("v").alias("v"), F.max("is_query").alias("is_query")))
    rows = stored(rows, "vectors")
    sizes = (rows.groupBy(F.size("v").alias("dim"))
             .agg(F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("q"))
             .orderBy(F.desc("n"), "dim").first())
    dim, n, n_query = (sizes["dim"], sizes["n"], sizes["q"] or 0) if sizes else (1, 0, 0)
    turn = rotation(dim, code_bits(dim))
    nc, nq = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-n_query // QUERY_BLOCK))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                packed, length, fit = encode(x, turn)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(length), pa.array(fit)],
                    names=["vec_id", "is_query", "x", "code", "length", "fit"])

    index = stored(rows.where(F.size("v") == dim).mapInArrow(
        code, "vec_id long, is_query boolean, x binary, code binary, length double, fit double"), "codes")
    spot = F.xxhash64("vec_id")
    every_q = F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))
    every_c = F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))
    candidates = index.withColumn("c", F.pmod(spot, F.lit(nc)).cast("int")).withColumn("g", every_q) \
        .withColumn("asks", F.lit(False))
    asked = index.where("is_query").withColumn("c", every_c) \
        .withColumn("g", F.pmod(spot, F.lit(nq)).cast("int")).withColumn("asks", F.lit(True))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        asks, rest = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        parts = [pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64),
                               "score": np.empty(0)})]
        if len(asks) and len(rest):
            x = np.frombuffer(b"".join(rest["x"])).reshape(len(rest), dim)
            codes = np.frombuffer(b"".join(rest["code"]), np.uint64).reshape(len(rest), -1)
            ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int32)
            ids, length, fit = (rest[c].to_numpy() for c in ("vec_id", "length", "fit"))
            spread = BOUND * length * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / math.sqrt(turn.shape[1] - 1)
            for own, raw in zip(asks["vec_id"], asks["x"]):
                found, score = top(np.frombuffer(raw), own, x, ids, codes, ones, length, fit, spread, turn, k)
                parts.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": score}))
        return pd.concat(parts, ignore_index=True)

    met = candidates.unionByName(asked).groupBy("c", "g").applyInPandas(
        meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
