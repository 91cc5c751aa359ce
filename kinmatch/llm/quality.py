"""Quality classifier: naive Bayes support vectors over character n-grams.

Each n-gram's indicator is scaled by its class log-count ratio; a linear hinge-loss model over the
scaled, unit-length vectors is fitted by dual coordinate descent, and its margins are turned into
probabilities by a logistic fit on labelled rows that the descent did not see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import per_batch, stage, text_or_empty

SENTENCE = re.compile(r"[.\n]\s*")


@dataclass(frozen=True)
class Params:
    """``train_rows`` bounds the labelled rows that a fit reads (those with the smallest hash of the id)."""

    train_rows: int = 8000
    buckets: int = 1 << 16
    sizes: tuple[int, ...] = (1, 2, 3)
    cost: float = 1.0
    epochs: int = 12
    smoothing: float = 1.0
    calibration_share: float = 0.2
    seed: int = 11


def indicators(text: str, params: Params) -> np.ndarray:
    """The distinct buckets of the text's n-grams, as sorted int32.

    These are its character n-grams and, over its words and its sentences, the n-grams of "same as
    the one before" (two and three equal in a row).
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    seen = np.zeros(params.buckets, bool)  # the first four are kept for repeats
    for size in params.sizes:
        if len(points) >= size:
            value = np.full(len(points) - size + 1, size, np.uint64)
            for i in range(size):
                value = (value + points[i : len(points) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
            seen[4 + value % np.uint64(params.buckets - 4)] = True
    for unit, parts in enumerate((text.split(), SENTENCE.split(text))):
        same = [a == b for a, b in pairwise(parts)]
        seen[2 * unit] |= any(same)
        seen[2 * unit + 1] |= any(a and b for a, b in pairwise(same))
    return np.flatnonzero(seen).astype(np.int32)


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, params: Params) -> np.ndarray:
    """Per bucket the log of its smoothed share in class 1 over that in class 0."""
    counts = [np.full(params.buckets, params.smoothing) for _ in range(2)]
    for row, label in zip(rows, labels.tolist(), strict=True):
        counts[label][row] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, params: Params) -> np.ndarray:
    """Weights (the last one is the bias) of the hinge-loss model, classes weighted to equal cost."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([max(1, (labels == c).sum()) for c in (0, 1)]) / len(labels)
    caps = params.cost * 0.5 / share[labels]
    scale = [1 / max(np.linalg.norm(ratio[r]), 1e-9) for r in rows]
    weights, alpha, rng = np.zeros(params.buckets + 1), np.zeros(len(rows)), np.random.default_rng(params.seed)
    for _ in range(params.epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            row, s = rows[i], scale[i]
            x = ratio[row] * s
            gradient = signs[i] * (weights[row] @ x + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / (x @ x + 1), 0.0), caps[i])
            if step := (new - alpha[i]) * signs[i]:
                weights[row] += step * x
                weights[-1] += step
                moved = max(moved, abs(step))
            alpha[i] = new
        if moved < 1e-3:
            break
    return weights


def margin(row: np.ndarray, weights: np.ndarray, ratio: np.ndarray) -> float:
    """Signed distance; a text without n-grams has the bias alone."""
    x = ratio[row]
    return float(weights[row] @ x / max(np.linalg.norm(x), 1e-9) + weights[-1])


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with a slight pull to slope 1."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - labels) * margins).sum() + 0.1 * (a - 1), (p - labels).sum()])
        h = np.array([[(w * margins * margins).sum() + 0.1, (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, params: Params) -> dict:
    """The model; with no or one class a constant score, (ones + 1) / (rows + 2)."""
    if len(set(labels.tolist())) < 2:
        prior = (labels.sum() + 1) / (len(labels) + 2)
        return {"weights": np.zeros(params.buckets + 1), "ratio": np.zeros(params.buckets), "a": 0.0, "b": float(np.log(prior / (1 - prior)))}
    aside = np.random.default_rng(params.seed).random(len(rows)) < params.calibration_share
    if len(set(labels[~aside].tolist())) < 2 or len(set(labels[aside].tolist())) < 2:
        aside[:] = False
    own = [r for r, s in zip(rows, aside, strict=True) if not s]
    ratio = log_count_ratio(own, labels[~aside], params)
    weights = descend(own, labels[~aside], ratio, params)
    held = aside if aside.any() else ~aside
    margins = np.array([margin(r, weights, ratio) for r, s in zip(rows, held, strict=True) if s])
    a, b = calibrate(margins, labels[held].astype(float))
    return {"weights": weights, "ratio": ratio, "a": a, "b": b}


def train(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> dict:
    """Fit on ``labels`` (doc_id, quality 0 or 1), joined to ``docs``; other label values and null ids are left out.

    Rows are drawn by the smallest hash of the id, at most ``params.train_rows``, so a fit is the same
    at every partitioning. One task holds their n-gram buckets (at most 4 bytes x buckets a row).
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.train_rows)
    sample = docs.select("doc_id", text_or_empty("text").alias("text")).join(F.broadcast(drawn), "doc_id")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [indicators(x, params).tobytes() for x in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "label", "row"])

    ready = stage(
        per_batch(sample.select("doc_id", F.col("label").cast("int"), "text"), features, "doc_id long, label int, row binary"),
        "labelled",
    )

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        got.sort()
        model = fit([np.frombuffer(r[2], np.int32) for r in got], np.array([r[1] for r in got], np.int64), params)
        flat = np.concatenate([model["weights"], model["ratio"], [model["a"], model["b"]]]).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()])], ["model"])

    flat = np.frombuffer(ready.repartition(1).mapInArrow(one_task, "model binary").first().model, np.float64)
    n = params.buckets
    return {"weights": flat[: n + 1], "ratio": flat[n + 1 : 2 * n + 1], "a": float(flat[-2]), "b": float(flat[-1])}


def score(docs: DataFrame, model: dict, params: Params = Params()) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the probability of label 1.

    Null and empty texts get the score of a text without n-grams; repeated rows come back repeated;
    extra columns are ignored. The model is two vectors of ``params.buckets`` numbers.
    """
    weights, ratio = model["weights"].astype(np.float32), model["ratio"].astype(np.float32)
    a, b = model["a"], model["b"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        margins = np.array([margin(indicators(x, params), weights, ratio) for x in batch.column(1).to_pylist()])
        scores = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", text_or_empty("text").alias("text")), run, f"doc_id {kind}, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no fit learns from: CRC-32 of the id as text leaves 2 on division by 4. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
