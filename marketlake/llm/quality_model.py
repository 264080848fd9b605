"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss model.

The n-grams are runs of 3 bytes of the text as it stands, its lower-cased words, and how many pairs of words repeat, hashed
to buckets. Ratios and
weights are fitted on at most SAMPLE_ROWS labelled documents of each class; the weights by dual coordinate descent,
blended with their mean size, and a sigmoid fitted on rows kept out turns margins into scores.

Cases: a null or empty text has no n-gram and gets the score of the intercept. Labels that are null, or that contradict each
other for a doc_id, are left out. With labels of one class only, or none, every score is 0.5. Texts are read whole;
repeated rows are scored each, and learned once; extra columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.samples import fitted, sampled

BUCKETS = 1 << 17
SAMPLE_ROWS = 2500
SMOOTHING = 1.0
COST = 1.0
PASSES = 12
BLEND = 0.9
THRESHOLD = 0.7


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float


def _repetition(word: np.ndarray, found: W.Words, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Indicators that a text has 1, 2, 4 ... 2-word n-grams that repeat one of its own, or of a word and itself."""
    row = found.row
    pair = W.grams(word, 2)[:-1] if len(word) > 1 else np.zeros(0, np.uint64)
    inside = row[:-1] == row[1:] if len(word) > 1 else np.zeros(0, bool)
    of, pair, same = row[:-1][inside], pair[inside], (word[:-1] == word[1:])[inside]
    first = np.unique(pair ^ W.mix(of.astype(np.uint64)), return_index=True)[1]
    later = np.bincount(of, minlength=rows) - np.bincount(of[first], minlength=rows)
    codes, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for kind, count in enumerate((later, np.bincount(of[same], minlength=rows))):
        share = 100 * count // np.maximum(np.diff(found.first), 1)
        for bound in (1, 2, 4, 8, 16, 32, 64):
            for what, size in enumerate((count, share)):
                on = np.flatnonzero(size >= bound)
                codes.append(np.full(len(on), W.mix(np.array([bound * 8 + kind * 2 + what], np.uint64))[0]))
                at.append(on)
    return np.concatenate(codes), np.concatenate(at)


def indicators(texts: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text end to end, and where each text's begin."""
    row = np.repeat(np.arange(texts.rows), np.diff(texts.begin))
    byte = texts.data.astype(np.uint64)
    n = max(0, len(byte) - 2)
    code = (byte[:n] << W.U64(16)) | (byte[1 : n + 1] << W.U64(8)) | byte[2 : n + 2]
    inside = row[:n] == row[2:]
    found = W.words(texts)
    word = W.hashes(texts, found)
    again, rows = _repetition(word, found, texts.rows)
    code = np.concatenate([W.mix(code[inside] + W.U64(1)), word, again]) >> W.U64(64 - BUCKETS.bit_length() + 1)
    both = np.unique((np.concatenate([row[:n][inside], found.row, rows]).astype(np.uint64) << W.U64(32)) | code)
    return (both & W.U64(0xFFFFFFFF)).astype(np.int64), np.searchsorted(both >> W.U64(32), np.arange(texts.rows + 1))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.chunks(batch.column(2)):
            bucket, first = indicators(texts)
            rows = slice(texts.first_row, texts.first_row + texts.rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(rows.start, texts.rows), batch.column(1).slice(rows.start, texts.rows), W.lists(bucket.astype(np.int32), first, pa.int32())],
                ["key", "quality", "bucket"],
            )


def _descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Weights (the last is the intercept) of the hinge loss with COST, by dual coordinate descent."""
    w, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    size = np.array([v @ v + 1 for v in values])
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)):
            slope = y[i] * (values[i] @ w[rows[i]] + w[-1]) - 1
            new = min(max(alpha[i] - slope / size[i], 0.0), COST)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                w[-1] += (new - alpha[i]) * y[i]
                alpha[i] = new
    return w


def _sigmoid(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make margins probabilities, by Newton steps on a slightly smoothed target."""
    a, b = 1.0, 0.0
    target = np.where(label > 0, (label > 0).sum() + 1.0, 1.0) / np.where(label > 0, (label > 0).sum() + 2.0, (label <= 0).sum() + 2.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * margin).sum(), g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> Model:
    """Learns from (doc_id, text) and (doc_id, quality) of a sample."""
    clear = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
    chosen = sampled(clear.where("quality = _most").select("doc_id", "quality"), "quality", sample_rows, seed, ["doc_id"])
    chosen = F.broadcast(chosen.select("doc_id", F.col("quality").cast("int")))  # sample_rows of each class at most
    labelled = documents.select("doc_id", "text").join(chosen, "doc_id")
    rows = sampled(labelled, "quality", sample_rows, seed, ["doc_id", "text"]).select("key", "quality", "text")
    got = rows.mapInArrow(_features, "key long, quality int, bucket array<int>")
    return fitted(got, lambda sample: fit(sample, seed)) or Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 0.0)


def fit(got: pa.Table, seed: int) -> Model:
    """Learns from a sample's indicators; rows in any order give the same model."""
    got = got.sort_by("key").combine_chunks()
    y = np.where(got.column("quality").to_numpy() > 0, 1.0, -1.0)
    flat = Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 0.0)
    if len(np.unique(y)) < 2:
        return flat
    rows = [x.values.to_numpy() if len(x) else np.zeros(0, np.int32) for x in got.column("bucket")]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, kept = order[: len(y) // 5], order[len(y) // 5 :]
    if len(np.unique(y[held])) < 2 or len(np.unique(y[kept])) < 2:
        held = kept = order
    counts = np.full((2, BUCKETS), SMOOTHING)
    for i in kept:
        counts[int(y[i] > 0)][rows[i]] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    values = [ratio[r] / max(np.sqrt(len(r)), 1) for r in rows]
    w = _descend([rows[i] for i in kept], [values[i] for i in kept], y[kept], rng)
    blended = (1 - BLEND) * np.abs(w[:-1]).mean() + BLEND * w[:-1]
    margin = np.array([values[i] @ blended[rows[i]] for i in held]) + w[-1]
    spread = margin.std() or 1.0
    slope, shift = _sigmoid(margin / spread, y[held])
    return Model((blended * ratio).astype(np.float32), float(w[-1]), slope / spread, shift)


def score(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns `keep` of `documents` with score and predicted."""
    names = [*keep, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(0)]
            for texts in W.chunks(batch.column(0)):
                bucket, first = indicators(texts)
                total = np.concatenate([[0], np.cumsum(model.weights[bucket], dtype=np.float64)])
                n = np.maximum(np.diff(first), 1)
                margin = (total[first[1:]] - total[first[:-1]]) / np.sqrt(n) + model.intercept
                out.append(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30))))
            value = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))], names)

    kinds = ", ".join(f"`{c}` {t}" for c, t in documents.select(*keep).dtypes)
    return documents.select(F.col("text").alias("_text"), *keep).mapInArrow(run, f"{kinds}, score double, predicted int")
