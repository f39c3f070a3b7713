"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from basketlens.functions.shipping import by_value
from basketlens.llm.learning import feature_rows, labelled_sample, mixed, score_documents, train_rounds
from basketlens.session import Scratch

by_value(__name__)

BITS = 17  # of a feature's number
SAMPLE = 16_000  # labelled documents to learn from, at most
SHARDS, ROUNDS = 8, 4
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 0.1

# A word's shape: runs of capitals, of other letters, of digits become one sign; other signs stay, a run of one sign is one.
_SHAPE = bytearray(range(256))
for _code in range(256):
    if 65 <= _code <= 90:
        _SHAPE[_code] = 65
    elif 97 <= _code <= 122 or _code >= 128:
        _SHAPE[_code] = 97
    elif 48 <= _code <= 57:
        _SHAPE[_code] = 48
    elif _code in (9, 10, 11, 12, 13):
        _SHAPE[_code] = 32
SHAPE = bytes(_SHAPE)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the text's features, over the whole text.

    Words, and shapes of words, in runs of one, two and three; a word that repeats the one before it has the shape "repeated".  A value is the root of the feature's share among those of its kind, so length
    cancels out.
    """
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    ids = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    signs = np.frombuffer(text.translate(SHAPE), dtype=np.uint8)
    signs = signs[np.flatnonzero(np.diff(signs, prepend=np.uint8(0) if signs[0] else np.uint8(1)))]
    seen: dict[bytes, int] = {}
    shapes = np.array([seen[s] if s in seen else seen.setdefault(s, xxhash.xxh3_64_intdigest(s, 1)) for s in signs.tobytes().split(b" ") if s], dtype=np.uint64)
    shapes[1:][ids[1:] == ids[:-1]] = 7
    kinds = [mixed(ids, np.uint64(11)), mixed(shapes, np.uint64(12))]
    for at, signs_of in enumerate((ids, shapes)):
        run = kinds[at]
        for n in (1, 2):
            if len(signs_of) > n:
                run = mixed(run[:-1], signs_of[n:] + np.uint64(20 + n))
                kinds.append(run)
    idx, val = [], []
    for kind in kinds:
        which, times = np.unique(kind >> np.uint64(64 - BITS), return_counts=True)
        idx.append(which.astype(np.int32))
        val.append(np.sqrt(times / len(kind)).astype(np.float32))
    return np.concatenate(idx), np.concatenate(val)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that the sums ``z`` and squared gradients ``n`` stand for."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(model: dict, examples: list, at: int) -> dict:
    """One pass of per-coordinate FTRL-proximal; the last coordinate is the constant."""
    z, n = model["z"], model["n"]
    for idx, val, label in examples:
        idx, val = np.append(idx, len(z) - 1), np.append(val, 1.0)
        w = weights(z[idx], n[idx])
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ val, -35, 35)))
        g = (p - label) * val
        # Two features of one text may share a number: sums, not assignments.
        np.add.at(z, idx, g - (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA * w)
        np.add.at(n, idx, g * g)
    return {"z": z, "n": n}


def margin(model: dict, idx: np.ndarray, val: np.ndarray) -> float:
    return float(model["w"][idx] @ val + model["w"][-1])


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, label: str = "quality") -> dict[str, np.ndarray]:
    """Weights learned from at most ``sample`` labelled documents outside the held-out quarter."""
    rows = feature_rows(docs, labelled_sample(labels, label, sample), features, scratch, SHARDS)
    empty = np.zeros((1 << BITS) + 1)
    model = train_rounds(rows, {"z": empty, "n": empty}, learn, ROUNDS, scratch)
    return {"w": weights(model["z"], model["n"])}


def score_quality(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted`` (1: good).

    Null, empty and blank texts get the constant's score.  Without labels to learn from every score is 0.5.  Rows without
    ``doc_id`` are scored and not held out; repeated rows get equal scores.  Only ``doc_id`` and ``text`` are read.
    """
    return score_documents(docs, fit(docs, labels, scratch, sample), features, margin, threshold)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_quality(docs, labels, Scratch(spark, "quality"))
