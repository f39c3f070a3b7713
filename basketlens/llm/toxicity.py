"""Toxicity: a factorization machine over hashed terms.

A linear model adds up terms; the pairwise part learns that two terms together (an insult and a group it is aimed at) say
more than either alone.  The linear weights are sparse.  All terms that a few labelled documents hold take part in pairs, whatever
they say alone; the pairwise part is scaled by the length, so that a long text's many ordinary words add little noise.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.llm.learning import feature_rows, labelled_sample, score_documents, train_rounds
from basketlens.session import Scratch

by_value(__name__)

BITS = 17  # of a term's number
FACTORS = 4
SAMPLE = 16_000  # labelled documents to learn from, at most
SHARDS, ROUNDS = 8, 6
THRESHOLD = 0.3
ALPHA, L1, L2 = 0.5, 3.0, 0.1  # of the linear weights
START, RATE, DECAY = 0.1, 0.2, 1e-2  # of the factors
PAIRED = 8  # terms of a text from which its pairs count less
MIN_DOCS = 3  # labelled documents that hold a term with factors, at least
HEADS = (4, 5, 6)  # bytes of a word's beginning that are terms too
PUNCTUATION = b".,;:!?\"'()[]{}<>|*#&%$-_"


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the distinct terms of the whole text: words without punctuation, A-Z lower-cased, and their beginnings."""
    terms = set()
    for w in {w.strip(PUNCTUATION) for w in set(text.lower().split())}:
        terms.add(w)
        for k in HEADS:
            if len(w) > k:
                terms.add(w[:k] + b"*")
    terms.discard(b"")
    idx = np.unique(np.array([xxhash.xxh3_64_intdigest(t) >> (64 - BITS) for t in terms], dtype=np.int32))
    return idx, np.ones(len(idx), dtype=np.float32)


def linear(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Linear weights that the sums ``z`` and squared gradients ``n`` stand for; most are exactly zero."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((1.0 + np.sqrt(n)) / ALPHA + L2))


def pairs(v: np.ndarray) -> float:
    """Sum over all pairs of rows of their products: half of the squared sum less the summed squares, linear in the rows."""
    sums = v.sum(axis=0)
    return 0.5 * float((sums * sums).sum() - (v * v).sum())


def scale(terms: int) -> float:
    """Weight of the pairwise part of a text with so many terms with factors."""
    return PAIRED / max(PAIRED, terms)


def margin(model: dict, idx: np.ndarray, val: np.ndarray) -> float:
    """Constant, linear part, and pairwise part of the terms with factors; those of the others are zero."""
    on = idx[model["v"][idx].any(axis=1)]
    return float(model["b"][0]) + float(model["w"][idx].sum()) + scale(len(on)) * pairs(model["v"][on].astype(np.float64))


def learn(model: dict, examples: list, at: int) -> dict:
    """One pass: follow-the-regularised-leader for the linear weights, gradient steps for the factors."""
    b, nb, z, n, v, nv = (model[k] for k in ("b", "nb", "z", "n", "v", "nv"))
    for idx, _, label in examples:
        w = linear(z[idx], n[idx])
        on = idx[v[idx].any(axis=1)]
        vx = v[on]
        c = scale(len(on))
        p = 1.0 / (1.0 + np.exp(-np.clip(b[0] + w.sum() + c * pairs(vx), -35, 35)))
        g = p - label
        nb += g * g
        b -= 0.3 * g / np.sqrt(1.0 + nb)
        z[idx] += g - (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA * w
        n[idx] += g * g
        if len(on):
            dv = c * g * (vx.sum(axis=0) - vx) + DECAY * vx
            nv[on] += (dv * dv).mean(axis=1, keepdims=True)
            v[on] -= RATE * dv / np.sqrt(nv[on])
    return model


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, label: str = "toxic") -> dict[str, np.ndarray]:
    """Model learned from at most ``sample`` labelled documents outside the held-out quarter."""
    rows = feature_rows(docs, labelled_sample(labels, label, sample), features, scratch, SHARDS)
    size = 1 << BITS
    start = {
        "b": np.zeros(1), "nb": np.zeros(1), "z": np.zeros(size), "n": np.zeros(size),
        "v": np.random.default_rng(7).normal(0, START, (size, FACTORS)), "nv": np.ones((size, 1)),
    }
    # At most one row for each of the ``size`` numbers.
    counts = rows.select(F.explode("idx").alias("term")).groupBy("term").count().where(F.col("count") >= MIN_DOCS)
    seen = np.zeros(size, dtype=bool)
    seen[[r.term for r in counts.select("term").collect()]] = True
    start["v"][~seen] = 0.0
    model = train_rounds(rows, start, learn, ROUNDS, scratch)
    return {"b": model["b"], "w": linear(model["z"], model["n"]), "v": model["v"].astype(np.float32)}


def score_toxicity(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted`` (1: toxic).

    Null, empty and blank texts get the constant's score.  Without labels to learn from every score is 0.5.  Rows without ``doc_id`` are scored and not held out; repeated rows get equal scores.  Only
    ``doc_id`` and ``text`` are read.
    """
    return score_documents(docs, fit(docs, labels, scratch, sample), features, margin, threshold)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_toxicity(docs, labels, Scratch(spark, "toxicity"))
