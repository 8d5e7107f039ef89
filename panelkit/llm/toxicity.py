"""Toxicity classifier with counterfactual regularisation.

A logistic model over the distinct words of a text and their beginnings, of
which those that stand out in either class are chosen. While it is fitted,
identity terms in the labelled texts are swapped for others (a text without
one gets one), word and beginning, and changes of the score under a swap are penalised, so that a
neutral mention of a group does not move the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import bounded_sample, map_text, stored

TRAIN_ROWS = 12000       # labelled rows the model is fitted on, at most
STEPS = 400
RIDGE = 1e-4             # L2 penalty on standardised weights
COUNTERFACTUAL = 1.0     # weight of the squared score change under a swap
STANDOUT = 3.0           # standard deviations by which a feature's toxic texts differ from chance
PREFIX = 5               # characters of a word's beginning
VOCABULARY = 50000       # features of the model, at most: those that stand out most

# Words that name groups of people, with their inflected forms.
IDENTITY_TERMS = """
women woman men man girl boy gay lesbian bisexual transgender straight queer black white asian latino
african american european arab indian mexican chinese muslim jewish christian hindu buddhist catholic
atheist immigrant refugee foreigner disabled deaf blind elderly
frauen frau männer mann schwule lesbische schwarze weisse muslime juden christen ausländer flüchtlinge
femmes femme hommes homme musulmans juifs chrétiens immigrés réfugiés noirs blancs
mujeres mujer hombres hombre musulmanes judíos cristianos inmigrantes refugiados negros blancos
girls boys gays lesbians bisexuals blacks whites asians latina latinos latinas africans americans europeans arabs
indians mexicans muslims jew jews christians hindus buddhists catholics atheists immigrants migrant migrants refugees
foreigners
schwuler schwulen lesben lesbisch schwarzen weiße weißen weissen muslim muslimen muslimin muslimisch muslimische jude
jüdin jüdisch jüdische jüdischen christ christin ausländerin ausländern ausländerinnen flüchtling flüchtlingen
musulman musulmane musulmanes juif juive juives chrétien chrétienne chrétiennes immigré immigrée immigrées réfugié
réfugiée réfugiées noir noire noires blanc blanche blanches
musulmán musulmana musulmanas judío judía judías cristiano cristiana cristianas inmigrante refugiado refugiada refugiadas
negro negra negras blanco blanca blancas
""".split()

_WORD = re.compile(r"\w+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


def features(word: str) -> tuple[int, int]:
    """The hashes of a word and of its beginning."""
    return _hash(word), _hash(f"^{word[:PREFIX]}")


def _hashes(texts: list) -> dict[str, list]:
    return {"w": [sorted(h for w in words(t) for h in features(w)) for t in texts]}


# The features of each term: a swap changes both.
TERMS = np.array([features(w) for w in sorted(set(IDENTITY_TERMS))], np.int64)


@dataclass
class ToxicityModel:
    """Weights by feature hash; features outside the model weigh nothing."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0
    _known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": {}}

    def scores(self, texts: list) -> list[float]:
        known, weights = self._known, self.weights
        out = []
        for text in texts:
            total = self.bias
            for w in words(text):
                got = known.get(w)
                if got is None:
                    got = sum(weights.get(h, 0.0) for h in features(w))
                    if len(known) < 1 << 20:
                        known[w] = got
                total += got
            out.append(float(1 / (1 + np.exp(-np.clip(total, -30, 30)))))
        return out


def _solve(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, swap_in: np.ndarray,
           swap_out: np.ndarray) -> tuple[np.ndarray, float]:
    """Accelerated gradient for the logistic loss with the swap penalty.

    ``rows`` lists the features of each text. Swap k replaces the features
    swap_out[k] (-1: nothing) by swap_in[k]; its score change is the
    difference of their summed weights. Weights are ``scale`` times the parameters.
    """
    n, d = len(rows), len(scale)
    at = np.concatenate(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    out = swap_out >= 0

    def apply(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, (scale * w)[at], n)

    def swapped(w: np.ndarray) -> np.ndarray:
        w = scale * w
        return (w[swap_in] - np.where(out, w[swap_out], 0.0)).sum(axis=1)

    def back(r: np.ndarray, push: np.ndarray) -> np.ndarray:
        push = np.repeat(push[:, None], swap_in.shape[1], axis=1)
        g = np.bincount(at, r[row], d) + np.bincount(swap_in.ravel(), push.ravel(), d)
        return scale * (g - np.bincount(swap_out[out], push[out], d))

    # Largest curvature, by power iteration.
    v, size = np.ones(d), 1.0
    for _ in range(20):
        v = back(0.25 / n * apply(v), 2 * COUNTERFACTUAL / n * swapped(v))
        size = max(float(np.linalg.norm(v)), 1e-12)
        v /= size
    step = 1 / (1.2 * size + 0.25 + RIDGE)
    w, b, look, look_b, t = np.zeros(d), 0.0, np.zeros(d), 0.0, 1.0
    for _ in range(STEPS):
        r = (1 / (1 + np.exp(-np.clip(apply(look) + look_b, -30, 30))) - y) / n
        new = look - step * (back(r, 2 * COUNTERFACTUAL / n * swapped(look)) + RIDGE * look)
        new_b = look_b - step * r.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return scale * w, b


def train(labels: list[int], rows: list[np.ndarray], sizes: list[int], stand: dict[int, float]) -> ToxicityModel:
    """Fit on texts given by their label, their features in the vocabulary and their feature count.

    The vocabulary is ``stand`` (standard deviations from chance by feature
    hash) and the identity terms, in the order of :func:`vocabulary_of`.
    """
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
        return ToxicityModel(bias=float(np.log(p / (1 - p))))
    vocabulary = vocabulary_of(stand)
    scale = np.array([max(abs(stand[h]), 1.0) / STANDOUT if h in stand else 1.0 for h in vocabulary.tolist()])
    term_at = np.searchsorted(vocabulary, TERMS)
    swap_in, swap_out = np.empty((len(rows), 2), np.int64), np.full((len(rows), 2), -1)
    for k, r in enumerate(rows):
        mine = np.flatnonzero(np.isin(term_at[:, 0], r))
        swap_in[k] = term_at[(k * 7919 + sizes[k]) % len(term_at)]
        if len(mine):
            swap_out[k] = term_at[mine[k % len(mine)]]
    w, b = _solve(rows, y, scale, swap_in, swap_out)
    return ToxicityModel(dict(zip(vocabulary.tolist(), w.tolist())), float(b))


def vocabulary_of(stand: dict[int, float]) -> np.ndarray:
    """The sorted feature hashes of the model: features that stand out and those of identity terms."""
    return np.union1d(np.fromiter(stand, np.int64, len(stand)), TERMS)


def standing_out(hashed: DataFrame, texts: int, toxic: int) -> DataFrame:
    """(h, stand) of the features whose toxic texts differ from chance by STANDOUT, and of identity terms.

    ``hashed`` has the label and the features ``w`` of each text; counts are
    combined before the shuffle, and the VOCABULARY features that stand out
    most are chosen.
    """
    counts = (hashed.select("label", F.explode(F.array_distinct("w")).alias("h")).groupBy("h")
              .agg(F.count("*").alias("times"), F.sum("label").alias("toxic")))
    chance = F.col("times") * F.lit(toxic / texts)
    return (counts.select("h", ((F.col("toxic") - chance) / F.sqrt(chance + 1)).alias("stand"))
            .where((F.abs("stand") >= STANDOUT) | F.col("h").isin(np.unique(TERMS).tolist()))
            .orderBy(F.abs("stand").desc(), "h").limit(VOCABULARY))


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> ToxicityModel:
    """Fit on at most TRAIN_ROWS rows with a text and a label (1 toxic), chosen by the text's hash.

    Features are counted by Spark; only the vocabulary (at most VOCABULARY
    hashes) and each text's places in it reach the driver, packed. Null texts
    and labels are left out. With one class only, every score is the share of
    toxic rows; without rows 0.5.
    """
    rows = (labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
            .where("text IS NOT NULL AND label IN (0, 1)"))
    rows = bounded_sample(rows, F.col("text"), TRAIN_ROWS)
    hashed = stored(map_text(rows, ["label"], "text", "w array<long>", _hashes).select("label", "w"), "features")
    total = hashed.agg(F.count("*").alias("texts"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    if total["toxic"] in (0, total["texts"]):
        return train([total["toxic"] > 0] * total["texts"], [], [], {})
    stand = {r["h"]: r["stand"] for r in standing_out(hashed, total["texts"], total["toxic"]).collect()}
    vocabulary = vocabulary_of(stand)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, sizes = [], []
            for w in batch.column(1):
                h = w.values.to_numpy()
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                packed.append(np.sort(at[vocabulary[at] == h]).astype(np.int32).tobytes())
                sizes.append(len(h))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), pa.array(sizes, pa.int32())],
                names=["label", "at", "size"])

    got = hashed.mapInArrow(places, "label int, at binary, size int").collect()
    got.sort(key=lambda r: (r["at"], r["size"], r["label"]))
    return train([r["label"] for r in got], [np.frombuffer(r["at"], np.int32) for r in got],
                 [r["size"] for r in got], stand)


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``keep`` columns and the score (0 to 1, higher: likelier toxic) of every row's whole text.

    Null text counts as empty and, like the empty text, scores by the bias
    alone. Rows are scored one by one; an empty table gives an empty result.
    """
    return map_text(docs, keep, text_col, f"{score_col} double",
                    lambda texts: {score_col: model.scores(texts)})
