"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. For a pair of a good and a poor
document the odds that the good one wins are the exponential of the difference of strengths, so
the weights are fitted by logistic loss on feature differences. The decision is a quantile of
the strengths of labelled documents (the share of poor ones), which is mapped to ``CUT``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, learnable, ship
from .line_rules import repeated_words
from .wordhash import word_hashes

#: Labelled documents that the weights are fitted on at most (the first by a hash of the id).
SAMPLE = 20_000
#: Preference pairs, Newton steps and weight decay of the fit.
PAIRS, STEPS, DECAY = 100_000, 12, 1.0
#: Score of the threshold: documents from it on are predicted good.
CUT = 0.3
SEED = 11

_GROUPS = [b"#*$%&|<>", b"!?", b"|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"\n",
           b" \t", b"\"'()[]{}/\\=_@~^`+-"]
NAMES = ["log_words", "mean_word", "symbols", "marks", "bars", "capitals", "digits", "stops", "lines", "blanks",
         "other", "non_ascii", "distinct_words", "top_word", "repeated", "dup_lines", "line_words", "bad_words"]
_MASKS = np.array([[b in g for b in range(256)] for g in _GROUPS], np.float64)
_BAD = b"#*$%&|<>!"


def features(text: str | None) -> list[float]:
    """Features of a text by the order of ``NAMES``; those of a text without words are 0."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = word_hashes(data)
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = np.sqrt(_MASKS @ hist / len(data))
    _, counts = np.unique(words, return_counts=True)
    lines = [x for x in data.split(b"\n") if x.split()]
    letters = hist[65:91].sum() + hist[97:123].sum() + hist[128:].sum()
    bad = sum(1 for w in data.split() if w[-1] in _BAD or w[0] in _BAD)
    return [np.log1p(n), len(data) / n / 10, share[0], share[1], share[2],
            hist[65:91].sum() / max(1, letters), share[4], share[5], share[6], share[7], share[8],
            hist[128:].sum() / len(data), len(counts) / n, counts.max() / n, repeated_words(words) / n,
            1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), bad / n]


class Ranking:
    """Weights over standardised features, and the strength that stands for ``CUT``."""

    def __init__(self, x: np.ndarray, label: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(len(NAMES))
        self.scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(len(NAMES))
        self.weights, self.at = np.zeros(len(NAMES)), 0.0
        good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        if not len(good) or not len(poor):
            return
        z = self._z(x)
        diff = z[rng.choice(good, PAIRS)] - z[rng.choice(poor, PAIRS)]
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(np.clip(diff @ self.weights, -30, 30)))  # odds of the wrong order
            gradient = diff.T @ p - DECAY * self.weights
            curve = (diff * (p * (1 - p))[:, None]).T @ diff + DECAY * np.eye(len(NAMES))
            step = np.linalg.solve(curve, gradient)
            self.weights = self.weights + step / max(1.0, np.abs(step).max() / 2)
        strength = np.sort(z @ self.weights)
        k = min(max(len(poor), 1), len(strength) - 1)
        self.at = (strength[k - 1] + strength[k]) / 2  # the quantile of the share of poor documents

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1: the odds against a document that stands just at the threshold, shifted so
        that this one scores ``CUT``."""
        gap = np.clip(self._z(x) @ self.weights - self.at, -30, 30)
        return 1 / (1 + np.exp(-gap - np.log(CUT / (1 - CUT))))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """(features, label) of at most ``SAMPLE`` labelled documents that may be learned from.
    Null labels are left out; a document labelled twice counts as poor if one label says so. Of the rows that share an id
    only the smallest text is read, so the bound holds."""
    ids = (labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("label"))
           .where(F.col("label").isin(0, 1) & learnable("k")).groupBy("k").agg(F.min("label").alias("label"))
           .orderBy(F.xxhash64("k"), "k").limit(SAMPLE))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = (rows.join(F.broadcast(ids), F.col("id") == F.col("k"))
             .groupBy("k", "label").agg(F.min("text").alias("text")).select("text", "label"))

    def run(batches):
        for b in batches:
            rows_ = [features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows_, pa.list_(pa.float64())), b.column(1)],
                                             names=["features", "label"])

    return texts.mapInArrow(run, "features array<double>, label int")


def train(docs: DataFrame, labels: DataFrame, **columns: str) -> Ranking:
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, **columns).toPandas()
    order = sorted(range(len(rows)), key=lambda i: (rows["label"][i], list(rows["features"][i])))
    x = np.array([rows["features"][i] for i in order], np.float64).reshape(-1, len(NAMES))
    return Ranking(x, rows["label"].to_numpy()[order])


def rate(docs: DataFrame, model: Ranking, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``CUT`` on) appended; columns
    of these names are replaced. Null and empty texts have all features 0 and get a score too;
    so do all documents of a corpus without labels of both kinds (the threshold's)."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    at = rest.index(text_col)
    kept = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)]
                       + ["score double", "predicted int"])

    def run(batches):
        for b in batches:
            x = np.array([features(t) for t in b.column(at).to_pylist()], np.float64).reshape(-1, len(NAMES))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                                             names=[*b.schema.names, "score", "predicted"])

    out = kept.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "score", "predicted")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    out = rate(docs.select("doc_id", "text"), train(docs, labels))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
