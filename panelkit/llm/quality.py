"""Quality classifier by compression with class dictionaries.

Two zstandard dictionaries are built from good and from bad labelled text. A
text is compressed block by block with either dictionary (and with none, as
the norm); the normalised size difference, calibrated on other labelled rows,
is the probability that the text is good.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import bounded_sample, map_text, sampled_texts

BLOCK = 2048                # bytes compressed at a time, so that dictionaries matter throughout
LEVEL = 3
DICTIONARY_BYTES = 65536
DICTIONARY_BLOCKS = 4000    # blocks a class gives to its dictionary, at most
LABELLED_ROWS = 20000       # labelled documents a model is fitted on, at most
CALIBRATION_ROWS = 20000    # labelled rows the calibration is fitted on, at most
RIDGE = 0.1


def _blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "replace")
    return [raw[k:k + BLOCK] for k in range(0, len(raw), BLOCK)]


@dataclass
class QualityModel:
    """Dictionaries and calibration weights; picklable, about 130 KB."""

    good: bytes = b""
    bad: bytes = b""
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = 0.5          # the score of every text where a class has no labelled text
    _engines: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_engines": []}

    def features(self, text: str | None) -> list[float]:
        """Normalised size differences, plain ratio and length of a text."""
        if not self._engines:
            for raw in (self.good, self.bad):
                kind = zstandard.ZstdCompressionDict(raw)
                kind.precompute_compress(level=LEVEL)
                self._engines.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=kind, write_content_size=False, write_dict_id=False))
            self._engines.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
        size, sums = 0, [0, 0, 0]
        for block in _blocks(text):
            size += len(block)
            for k, engine in enumerate(self._engines):
                sums[k] += len(engine.compress(block))
        good, bad, plain = sums
        return [(bad - good) / max(bad + good, 1), (plain - good) / max(plain, 1),
                (plain - bad) / max(plain, 1), np.log((plain + 1) / (size + 1)), np.log(size + 1)]

    def scores(self, texts: list) -> list[float]:
        if self.weights is None:
            return [self.prior] * len(texts)
        if not texts:
            return []
        x = _expand(np.array([self.features(t) for t in texts]), self.mean, self.scale)
        return (1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))).tolist()


def _expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, their squares and products, and a constant."""
    z = np.clip((x - mean) / scale, -4, 4)
    cols = [np.ones(len(z)), *z.T]
    cols += [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i, z.shape[1])]
    return np.stack(cols, axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)),
                               x.T @ (p - y) + RIDGE * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or raw content where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [b for b in blocks if len(b) >= 8]).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(blocks)[-DICTIONARY_BYTES:]


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> QualityModel:
    """Fit on rows with a text and a label (1 good, 0 bad).

    One half of the rows (by the text's hash) gives blocks for the
    dictionaries, the other half calibrates, so that no text is judged by a
    dictionary that holds it. Both are bounded samples (DICTIONARY_BLOCKS,
    CALIBRATION_ROWS). Null texts and labels are left out. Where either class
    has no row in either half, every score is the share of good rows (0.5
    without rows).
    """
    rows = (labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
            .where("text <> '' AND label IN (0, 1)")
            .withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2))))
    sizes = {(r["half"], r["label"]): r["n"] for r in
             rows.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    good = sum(n for (_, label), n in sizes.items() if label)
    model = QualityModel(prior=good / sum(sizes.values()) if sizes else 0.5)
    if len(sizes) < 4:
        return model
    dictionaries = {}
    for label in (0, 1):
        blocks = (rows.where((F.col("half") == 0) & (F.col("label") == label))
                  .select(F.explode(F.expr(
                      f"transform(sequence(0, (length(text) - 1) div {BLOCK}),"
                      f" k -> substring(text, k * {BLOCK} + 1, {BLOCK}))")).alias("block")))
        got = bounded_sample(blocks, F.col("block"), DICTIONARY_BLOCKS).collect()
        dictionaries[label] = _dictionary(sorted(r["block"].encode("utf-8", "replace") for r in got))
    model.good, model.bad = dictionaries[1], dictionaries[0]
    other = bounded_sample(rows.where("half = 1"), F.col("text"), CALIBRATION_ROWS)
    got = map_text(other, ["label"], "text", "x array<double>",
                   lambda ts: {"x": [model.features(t) for t in ts]}).select("label", "x").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["label"] for r in got], float)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = _logistic(_expand(x, model.mean, model.scale), y)
    return model


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``keep`` columns and the score (0 to 1, higher: likelier good) of every row's whole text.

    Null text counts as empty; the empty text gets the calibrated score of
    zero bytes. Rows are scored one by one: repeated rows get equal scores, an
    empty table gives an empty result.
    """
    return map_text(docs, keep, text_col, f"{score_col} double",
                    lambda texts: {score_col: model.scores(texts)})


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int,
                   rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold."""
    marks = (labels.where(remainder("doc_id", modulus) != held)
             .select("doc_id", F.col(label).cast("int").alias("label")).where("label IS NOT NULL"))
    return sampled_texts(docs, marks, rows)
