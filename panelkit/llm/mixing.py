"""Soft-membership mixing of documents to target domain weights.

A classifier fitted on a labelled table predicts every document's domain
posteriors; a projected-gradient least squares then finds non-negative rates,
one per document, whose expected token totals by domain meet the targets.
Everything is DataFrame functions; the driver sees sums by domain only.
"""

from __future__ import annotations

import json
import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import bounded_sample, stored

BUCKETS = 1024          # hashed word features
LABELLED_ROWS = 20000   # labelled rows the classifier is fitted on, at most
EVIDENCE = 40.0         # words whose evidence a text counts for, at most (words are not independent)
SMOOTHING = 0.5
STEPS = 200             # gradient steps, at most
TOLERANCE = 1e-6        # largest residual, as a share of all tokens, that ends the fit
DOMAINS = 64            # domains, at most; more are an error


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit_domains(labelled: DataFrame, text_col: str = "text", domain_col: str = "domain") -> dict:
    """Naive Bayes over hashed words: {"domains": [...], "prior": [...], "weights": per domain}.

    Rows with a null text or domain are left out; without rows the model has
    no domain. At most LABELLED_ROWS rows are used, chosen by hash.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(domain_col).cast("string").alias("domain"))
    rows = bounded_sample(rows.dropna(), F.col("text"), LABELLED_ROWS)
    domains = rows.groupBy("domain").agg(F.count("*").alias("n"))
    sizes = {r["domain"]: r["n"] for r in domains.orderBy("domain").limit(DOMAINS + 1).collect()}
    if len(sizes) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} domains")
    counts = (rows.select("domain", F.explode(_words(F.col("text"))).alias("w"))
              .groupBy("domain", _bucket(F.col("w")).alias("bucket")).agg(F.count("*").alias("n")).collect())
    names = sorted(sizes)
    table = {d: [SMOOTHING] * BUCKETS for d in names}
    for r in counts:
        table[r["domain"]][r["bucket"]] += r["n"]
    total = max(sum(sizes.values()), 1)
    return {"domains": names, "prior": [math.log(sizes[d] / total) for d in names],
            "weights": [[round(math.log(c / sum(table[d])), 6) for c in table[d]] for d in names]}


def posteriors(docs: DataFrame, model: dict, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, mix_tokens (words) and mix_posterior (a probability per domain).

    A null or empty text has no words and gets the prior.
    """
    names = [f"s{k}" for k in range(len(model["domains"]))]
    weights = [F.from_json(F.lit(json.dumps(w)), "array<double>") for w in model["weights"]]
    places = F.transform(_words(F.col(text_col)), _bucket)
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(s) for s in names])
    sums = F.aggregate(places, zero, lambda acc, b: F.struct(
        (acc["n"] + 1).alias("n"), *[(acc[s] + F.get(w, b)).alias(s) for s, w in zip(names, weights)]))
    summed = docs.select(*keep, sums.alias("mix_sums"))
    n = F.col("mix_sums.n")
    evidence = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(n, F.lit(1)))
    logs = F.array(*[F.lit(p) + evidence * F.col(f"mix_sums.{s}") for s, p in zip(names, model["prior"])])
    return (summed.select(*keep, n.alias("mix_tokens"), logs.alias("mix_logs"))
            .select(*keep, "mix_tokens", F.transform("mix_logs", lambda x: F.exp(
                x - F.array_max("mix_logs"))).alias("mix_odds"))
            .select(*keep, "mix_tokens", F.expr(
                "transform(mix_odds, x -> x / aggregate(mix_odds, 0D, (a, y) -> a + y))")
                .alias("mix_posterior")))


def _rate(posterior: str, steps: list[list[float]]) -> Column:
    """The rate after the given steps: from 1, each step subtracts its gradient and stops at zero."""
    if not steps:
        return F.lit(1.0)
    track = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")
    return F.aggregate(track, F.lit(1.0), lambda rate, step: F.greatest(F.lit(0.0), rate - F.aggregate(
        F.zip_with(F.col(posterior), step, lambda p, g: p * g), F.lit(0.0), lambda a, x: a + x)))


def fit_rates(members: DataFrame, targets: list[float]) -> list[list[float]]:
    """Gradient steps that bring the expected domain totals of (mix_tokens, mix_posterior) to targets.

    Minimises the sum over domains of (expected tokens - target)^2 / (tokens
    of the domain at rate 1) over rates >= 0, the gradient taken per token.
    Documents of equal posteriors have equal rates throughout, so the steps
    run over a table of posteriors with their tokens: documents whose
    posteriors agree to three decimals share a row, which has their mean
    posterior by tokens, so that no domain's mass is lost. With this scaling the
    largest curvature is 1 and a full step cannot overshoot. A domain without
    tokens has no part in the fit. A fit that has not converged after STEPS
    steps warns with its residual.
    """
    k = len(targets)
    cell = F.transform("mix_posterior", lambda x: F.round(x, 3)).alias("cell")
    sums = members.where("mix_tokens > 0").groupBy(cell).agg(
        F.sum("mix_tokens").alias("tokens"),
        *[F.sum(F.col("mix_tokens") * F.col("mix_posterior")[i]).alias(f"w{i}") for i in range(k)])
    cells = stored(sums.select("tokens", F.array(*[F.col(f"w{i}") / F.col("tokens") for i in range(k)])
                               .alias("mix_posterior")), "cells")
    part = [F.col("mix_posterior")[i] for i in range(k)]
    mass = cells.agg(*[F.sum(F.col("tokens") * part[i]).alias(f"m{i}") for i in range(k)],
                     F.sum("tokens").alias("all")).first()
    if not mass["all"]:
        return []
    weight = sum(w for i, w in enumerate(targets) if mass[f"m{i}"] > 0)
    goal = [w / weight * mass["all"] if weight and mass[f"m{i}"] > 0 else 0.0
            for i, w in enumerate(targets)]
    steps: list[list[float]] = []
    for _ in range(STEPS):
        rate = cells.select("tokens", "mix_posterior", _rate("mix_posterior", steps).alias("rate"))
        got = rate.agg(*[F.sum(F.col("tokens") * F.col("rate") * part[i]).alias(f"s{i}")
                         for i in range(k)]).first()
        miss = [got[f"s{i}"] - goal[i] for i in range(k)]
        if max(abs(x) for x in miss) <= TOLERANCE * mass["all"]:
            break
        steps.append([miss[i] / mass[f"m{i}"] if mass[f"m{i}"] else 0.0 for i in range(k)])
    else:
        warnings.warn(f"rates not converged after {STEPS} steps: the worst domain is off by "
                      f"{max(abs(x) for x in miss) / mass['all']:.2g} of all tokens", stacklevel=2)
    return steps


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], keep: list[str],
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` columns and mix_tokens, mix_posterior, mix_domain, mix_rate, mix_copies of every row.

    ``labelled`` has (text, domain); ``targets`` the wanted share of tokens by
    domain. mix_rate is the expected number of copies; mix_copies rounds it by
    a hash of the id, so that its mean is the rate. A domain without a target
    has target 0, one without labelled rows cannot be met and the others keep
    their proportions. Null or empty texts have no tokens. Without any
    labelled row every rate is 1 and the domain is null. An empty table gives
    an empty result. Columns of ``docs`` called like a result are replaced.
    """
    made = ("mix_tokens", "mix_posterior", "mix_domain", "mix_rate", "mix_copies")
    keep = [c for c in keep if c not in made]
    model = fit_domains(labelled)
    names = model["domains"]
    if not names:
        return docs.select(*keep, F.size(_words(F.col(text_col))).cast("long").alias("mix_tokens"),
                           F.array().cast("array<double>").alias("mix_posterior"),
                           F.lit(None).cast("string").alias("mix_domain"), F.lit(1.0).alias("mix_rate"),
                           F.lit(1).cast("long").alias("mix_copies"))
    members = stored(posteriors(docs, model, keep, text_col), "members")
    steps = fit_rates(members, [float(targets.get(d, 0.0)) for d in names])
    best = F.get(F.array(*[F.lit(d) for d in names]),
                 F.array_position("mix_posterior", F.array_max("mix_posterior")).cast("int") - 1)
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (members.withColumn("mix_domain", best)
            .withColumn("mix_rate", _rate("mix_posterior", steps))
            .withColumn("mix_copies", F.floor(F.col("mix_rate") + draw).cast("long")))
