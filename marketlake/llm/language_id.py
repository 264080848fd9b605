"""Language identification by averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

Subwords are the runs of 3 and 4 bytes of the lower-cased text, in which every ASCII byte but a letter is a space. A text
is the mean of its subwords' embeddings. As softmax input is linear in that mean, scoring adds each subword's class
scores directly. The softmax has a temperature fitted on texts kept out of training.

A prediction is rejected on either of two grounds. Its score is below MIN_SCORE, so another language may well be meant.
Or the text is unlike its language: the mean log-likelihood of its subwords under those learned of the language is below
that which all but a thousandth of the learned texts reach, each with its own subwords taken out of the counts (of fewer
than a thousand texts, the least). The second tells languages that were not learned, code, ids and gibberish apart, and
needs no second language. A text too short for a subword is rejected.

The model is fitted on at most ROWS_PER_LANG documents of each language. Cases: a text that is null or has no letter is
`und` with score 0, and rejected. Documents without a language are not learned from; without any labelled document all are
`und` with score 0, and none is rejected, as nothing is known to judge by. Texts of any length are read whole. Repeated rows
are scored each, and learned once. An empty table gives an empty result; columns that are not asked for are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.samples import fitted, sampled

BUCKETS = 1 << 17
DIMENSIONS = 16
SIZES = (3, 4)
ROWS_PER_LANG = 1000
EPOCHS = 4
BATCH = 8
RATE = 0.5
MIN_SCORE = 0.5
MAX_REJECTED = 0.001
SMOOTH = 0.1
UNKNOWN = "und"
_b = np.arange(256)
_FOLD = np.where((_b >= 0x41) & (_b <= 0x5A), _b + 32, np.where(((_b >= 0x61) & (_b <= 0x7A)) | (_b >= 0x80), _b, 0x20)).astype(np.uint32)
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # class scores of each subword bucket
    bias: np.ndarray
    temperature: float
    reject_below: float
    likely: np.ndarray  # log-likelihood of each subword bucket in each language
    unlike_below: float


def subwords(texts: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords, and the row of each."""
    byte = _FOLD[texts.data]
    row = np.repeat(np.arange(texts.rows, dtype=np.int32), np.diff(texts.begin))
    codes, rows = [], []
    for size in SIZES:
        n = len(byte) - size + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint32)
        for k in range(size):
            code = (code << np.uint32(8)) | byte[k : k + n]
        inside = (row[:n] == row[size - 1 :]) & ((byte[:n] != 0x20) | (byte[size - 1 :] != 0x20))
        code = (code[inside] + np.uint32(size)) * np.uint32(2654435761)
        codes.append(code >> np.uint32(32 - BUCKETS.bit_length() + 1))
        rows.append(row[:n][inside])
    if not codes:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(codes), np.concatenate(rows)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.chunks(batch.column(2)):
            code, row = subwords(texts)
            for r in range(texts.rows):
                bucket, count = np.unique(code[row == r], return_counts=True)
                at = texts.first_row + r
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1), batch.column(1).slice(at, 1), pa.array([bucket.astype(np.int32)], pa.list_(pa.int32())), pa.array([count.astype(np.int32)], pa.list_(pa.int32()))],
                    ["key", "lang", "bucket", "count"],
                )


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(documents: DataFrame, rows_per_lang: int = ROWS_PER_LANG, seed: int = 7) -> Model:
    """Learns from (doc_id, text, lang) of a sample."""
    rows = documents.where("lang is not null").select("doc_id", "lang", "text")
    rows = sampled(rows, "lang", rows_per_lang, seed, ["doc_id", "text"]).select("key", "lang", "text")
    got = rows.mapInArrow(_features, "key long, lang string, bucket array<int>, count array<int>")
    blank = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0, np.zeros((BUCKETS, 1), np.float32), 0.0)
    return fitted(got, lambda sample: fit(sample, seed)) or blank


def fit(got: pa.Table, seed: int) -> Model:
    """Learns from a sample's subword counts; rows in any order give the same model."""
    got = got.sort_by([("key", "ascending"), ("lang", "ascending")]).combine_chunks()
    langs = sorted(set(got.column("lang").to_pylist()))
    y = np.array([langs.index(x) for x in got.column("lang").to_pylist()])
    texts, sizes = [], []
    for bucket, count in zip(got.column("bucket"), got.column("count"), strict=True):
        n = count.values.to_numpy().astype(np.float32)
        texts.append((bucket.values.to_numpy(), n / max(n.sum(), 1)))
        sizes.append(float(n.sum()))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    held, kept = order[: len(order) // 5], order[len(order) // 5 :]
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    head, bias = rng.normal(0, 0.1, (DIMENSIONS, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(kept)
        for part in np.array_split(order, max(1, len(order) // BATCH)):
            mean = np.stack([share @ embed[bucket] for bucket, share in (texts[i] for i in part)])
            slope = _softmax(mean @ head + bias)
            slope[np.arange(len(part)), y[part]] -= 1
            back = slope @ head.T
            head -= rate * (mean.T @ slope) / len(part)
            bias -= rate * slope.mean(axis=0)
            for i, g in zip(part, back, strict=True):
                bucket, share = texts[i]
                # sums of a text's gradient are spread over thousands of buckets; the length makes up for it
                embed[bucket] -= rate * np.sqrt(len(bucket)) * share[:, None] * g
    scores = embed @ head
    check = held if len(held) else kept
    raw = np.stack([texts[i][1] @ scores[texts[i][0]] for i in check]) + bias
    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(raw / h)[np.arange(len(check)), y[check]] + 1e-12).mean() for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    best = np.array([int((share @ scores[bucket] + bias).argmax()) for bucket, share in texts])
    likely, like = _likelihood(texts, sizes, y, best, len(langs))
    return Model(langs, scores, bias, heat, MIN_SCORE, likely, float(np.quantile(like, MAX_REJECTED, method="lower")) if len(like) else 0.0)


def _likelihood(texts: list[tuple[np.ndarray, np.ndarray]], sizes: list[float], y: np.ndarray, best: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of the subwords in each language, and its mean over each text that has any, in the language predicted for
    it. A text's own subwords do not count in its mean."""
    counts = np.zeros((BUCKETS, langs))
    for (bucket, share), size, k in zip(texts, sizes, y, strict=True):
        counts[bucket, k] += share * size
    total, like = counts.sum(axis=0), []
    for (bucket, share), size, k, guess in zip(texts, sizes, y, best, strict=True):
        if size:
            own = size if k == guess else 0.0
            seen = np.maximum(counts[bucket, guess] - share * own, 0)
            like.append(share @ np.log(seen + SMOOTH) - np.log(max(total[guess] - own, 0) + SMOOTH * BUCKETS))
    return (np.log(counts + SMOOTH) - np.log(total + SMOOTH * BUCKETS)).astype(np.float32), np.array(like)


def identify(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns `keep` of `documents` with lang_pred, score and rejected."""
    names = [*keep, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.scores
        for batch in batches:
            column, langs, scores, unlike = batch.column(0), [], [], []
            for texts in W.chunks(column):
                raw = np.zeros((texts.rows, max(1, len(model.langs))))
                code, row = subwords(texts)
                found = np.bincount(row, minlength=texts.rows)
                count = np.maximum(found, 1)
                for k in range(len(model.langs)):
                    raw[:, k] = np.bincount(row, weights=table[:, k][code], minlength=texts.rows) / count + model.bias[k]
                share = _softmax(raw / model.temperature)
                best = share.argmax(axis=1)
                like = np.bincount(row, weights=model.likely[code, best[row]], minlength=texts.rows) / count
                unlike.extend((found == 0) | (like < model.unlike_below))
                for r in range(texts.rows):
                    known = model.langs and _LETTER.search(column[texts.first_row + r].as_py() or "")
                    langs.append(model.langs[best[r]] if known else UNKNOWN)
                    scores.append(float(share[r, best[r]]) if known else 0.0)
            rejected = [bool(model.langs) and (lang == UNKNOWN or s < model.reject_below or bool(u)) for lang, s, u in zip(langs, scores, unlike, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names)

    kinds = ", ".join(f"`{c}` {t}" for c, t in documents.select(*keep).dtypes)
    rows = documents.select(F.col("text").alias("_text"), *keep)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")
