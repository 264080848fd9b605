"""Secret scans: a linear-chain conditional random field that tags words as begin, inside or outside of a secret.

Words are runs of anything but white space. A word's features are its shape (classes of characters, length, share of
digits, a telling beginning), the same of its neighbours, and what its file holds. The base patterns' findings on a bounded
sample are the training tags; the model adds the spans it finds beyond them, and base spans stay. Decoding is Viterbi over
whole texts; words that every best path leaves outside cut a text into short stretches, so the result is exact.

Each training window around a finding is also learned with its telling words hidden, and windows around numbers, addresses
and the like that are no findings stand against them; so the model goes by the value's shape and place, and finds values
whose names the base patterns do not list.

The sample is SAMPLE_ROWS documents, and at most WINDOWS_A_TEXT windows of each. Cases: a null or empty text has no spans. If
no sampled document has a base finding, nothing is added. Repeated rows are scanned each, and learned once; long texts are
read whole. Base spans of equal place are ordered by kind; a span that the model finds and a base span touches is not added.
An empty table gives an empty result; columns that are not asked for are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.samples import fitted, sampled

#: Fixed patterns of the base findings, in the order in which kinds are listed.
ASSIGN = re.compile(rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "crf")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

SAMPLE_ROWS = 20_000
WINDOWS_A_TEXT = 4
WINDOW = 24
STEPS = 150
PENALTY = 1e-3
MASK = b"[secret]"
O, B, I = 0, 1, 2  # noqa: E741

_b = np.arange(256)
_HEX = ((_b >= 0x30) & (_b <= 0x39)) | ((_b >= 0x61) & (_b <= 0x66))
_DIGIT = (_b >= 0x30) & (_b <= 0x39)
_CLASS = np.zeros(256, np.uint8)
_CLASS[(_b >= 0x61) & (_b <= 0x7A)] = 1
_CLASS[(_b >= 0x41) & (_b <= 0x5A)] = 2
_CLASS[_DIGIT] = 4
_CLASS[list(b":=")] = 8
_CLASS[list(b"\"'`")] = 16
_CLASS[list(b"+/_.-")] = 32
_CLASS[(_CLASS == 0) & (_b > 0x20) & (_b < 0x7F)] = 64
_CLASS[_b >= 0x80] = 128
_LOWER = np.where((_b >= 0x41) & (_b <= 0x5A), _b + 32, _b).astype(np.uint32)
_TELLING = np.array([int.from_bytes(x, "little") for x in (b"pass", b"secr", b"toke", b"apik", b"api_")], np.uint32)
_LENGTHS = np.array([3, 6, 10, 15, 19, 24, 40])
#: Sizes of the features: classes, length, digits, beginning, the neighbours' (two before, one after), and the file's.
SIZES = (256, 8, 4, 2, 32, 16)
#: Bits of each feature in a training window as it is, and without those that tell of telling words.
SHOWN, HIDDEN = (255, 255, 255, 255, 255, 255), (255, 255, 255, 0, 2 + 8, 255 - 1)


@dataclass
class Model:
    weights: list[np.ndarray]
    moves: np.ndarray

    def __post_init__(self):
        self.moves = self.moves.copy()
        self.moves[O, I] = -1e9


def base_spans(texts: W.Texts) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of each text's base findings, in bytes, sorted."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(texts.rows)]
    runs = W.words(texts, _HEX)
    long = np.flatnonzero(runs.end - runs.start >= MIN_HEX)
    for k, r in zip(long, np.searchsorted(runs.first, long, side="right") - 1, strict=True):
        out[r].append((int(runs.start[k] - texts.begin[r]), 2, int(runs.end[k] - texts.begin[r])))
    signs = np.flatnonzero((texts.data == 0x3D) | (texts.data == 0x3A))
    for r in np.unique(np.searchsorted(texts.begin, signs, side="right") - 1):
        out[r] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(texts.text(r)) if m.end(2) - m.start(2) >= MIN_VALUE]
    if b"AKIA" in texts.data.tobytes():
        for r in range(texts.rows):
            out[r] += [(m.start(), 1, m.end()) for m in ACCESS.finditer(texts.text(r)) if m.end() - m.start() >= MIN_ACCESS]
    for own in out:
        own.sort()
    return out


def features(texts: W.Texts, found: W.Words) -> list[np.ndarray]:
    """A value below SIZES for every word, by feature."""
    if not len(found.start):
        return [np.zeros(0, np.int64) for _ in SIZES]
    classes = np.bitwise_or.reduceat(_CLASS[texts.data], found.start).astype(np.int64)
    size = found.end - found.start
    digits = np.add.reduceat(_DIGIT[texts.data], found.start, dtype=np.int64)
    padded = np.concatenate([_LOWER[texts.data], np.zeros(4, np.uint32)])
    head = sum(padded[found.start + k] << np.uint32(8 * k) for k in range(4))
    telling = np.isin(head, _TELLING)
    assigns = (classes & 8) > 0
    row, n = found.row, len(size)

    def shifted(x: np.ndarray, by: int) -> np.ndarray:
        """x of the word `by` places on in the same text, else false."""
        out = np.zeros(n, bool)
        to, of = (slice(0, n - by), slice(by, n)) if by > 0 else (slice(-by, n), slice(0, n + by))
        out[to] = x[of] & (row[of] == row[to])
        return out

    near = shifted(telling, -1) + 2 * shifted(assigns, -1) + 4 * shifted(telling, -2) + 8 * shifted(assigns, 1) + 16 * shifted(telling, 1)
    count = np.maximum(np.diff(found.first), 1)
    rows = len(count)
    share = 100 * np.bincount(row, weights=digits > 0, minlength=rows) / count
    file = 1 * (np.bincount(row, weights=telling, minlength=rows) > 0) + 2 * (np.bincount(row, weights=assigns, minlength=rows) > 0)
    file = file + 4 * np.searchsorted([1, 5, 20], share)
    return [classes, np.searchsorted(_LENGTHS, size), np.searchsorted([0.01, 0.25, 0.6], digits / size), telling.astype(np.int64), near.astype(np.int64), file[row]]


def tags(texts: W.Texts, found: W.Words, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Begin and inside for the words that base findings touch."""
    out = np.zeros(len(found.start), np.int8)
    for r, own in enumerate(spans):
        for start, _, end in own:
            a = found.first[r] + np.searchsorted(found.end[found.first[r] : found.first[r + 1]], texts.begin[r] + start, side="right")
            z = found.first[r] + np.searchsorted(found.start[found.first[r] : found.first[r + 1]], texts.begin[r] + end)
            if out[a] == O:
                out[a] = B
            out[a + 1 : z] = I
    return out


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows: around base findings, as they are and with telling words hidden; else around a word with a digit,
    and somewhere in one text of eight."""
    for batch in batches:
        for texts in W.chunks(batch.column(1)):
            found = W.words(texts)
            spans = base_spans(texts)
            tag, values = tags(texts, found, spans), features(texts, found)
            digit = np.add.reduceat(_DIGIT[texts.data], found.start, dtype=np.int64) > 0 if len(found.start) else np.zeros(0, bool)
            out = []
            for r in range(texts.rows):
                a, z = int(found.first[r]), int(found.first[r + 1])
                doc = batch.column(0)[texts.first_row + r].as_py() or 0
                if spans[r]:
                    middles, forms = (a + np.flatnonzero(tag[a:z] == B))[: WINDOWS_A_TEXT // 2], (SHOWN, HIDDEN)
                else:
                    middles, forms = (a + np.flatnonzero(digit[a:z]))[:1].tolist(), (SHOWN,)
                    middles += [a + (doc * 2654435761) % (z - a)] if z > a and doc % 8 == 0 else []
                for m in middles:
                    start = max(a, min(int(m) - WINDOW // 2, z - WINDOW))
                    part = slice(start, min(z, start + WINDOW))
                    for form in forms:
                        out.append([*((v[part] & bits).tolist() for v, bits in zip(values, form, strict=True)), tag[part].tolist()])
            for flat in out:
                yield pa.RecordBatch.from_arrays([pa.array([sum(flat, [])], pa.list_(pa.int32()))], ["flat"])


def _all_pairs(weights: list[np.ndarray], values: list[np.ndarray]) -> np.ndarray:
    return sum(w[v] for w, v in zip(weights, values, strict=True))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(values: list[np.ndarray], tag: np.ndarray, real: np.ndarray, steps: int = STEPS) -> Model:
    """Weights by gradient ascent of the windows' conditional log-likelihood; arrays are windows x WINDOW, `real` masks padding."""
    n, length = tag.shape
    weights = [np.zeros((s, 3)) for s in SIZES]
    moves = np.zeros((3, 3))
    first = [np.zeros_like(w) for w in (*weights, moves)]
    second = [np.zeros_like(w) for w in (*weights, moves)]
    gold = np.eye(3)[tag] * real[:, :, None]
    both = real[:, 1:] & real[:, :-1]
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (tag[:, :-1][both], tag[:, 1:][both]), 1)
    for step in range(1, steps + 1):
        allowed = moves.copy()
        allowed[O, I] = -1e9
        score = np.where(real[:, :, None], _all_pairs(weights, values), np.array([0.0, -1e9, -1e9]))
        ahead, back = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        ahead[:, 0] = score[:, 0] + np.array([0, 0, -1e9])
        for t in range(1, length):
            between = np.where(real[:, t, None, None], allowed, 0.0)
            ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + between, 1) + score[:, t]
        for t in range(length - 2, -1, -1):
            between = np.where(real[:, t + 1, None, None], allowed, 0.0)
            back[:, t] = _logsum(between + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        total = _logsum(ahead[:, -1], 1)
        share = np.exp(ahead + back - total[:, None, None]) * real[:, :, None]
        pair = np.exp(ahead[:, :-1, :, None] + allowed + (score[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None])
        slopes = []
        for w, v in zip(weights, values, strict=True):
            g = np.zeros_like(w)
            np.add.at(g, v.ravel(), (gold - share).reshape(-1, 3))
            slopes.append(g / n - PENALTY * w)
        slopes.append((gold_moves - (pair * both[:, :, None, None]).sum(axis=(0, 1))) / n - PENALTY * moves)
        for k, (w, g) in enumerate(zip((*weights, moves), slopes, strict=True)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w += 0.2 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model(weights, moves)


def train(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 3) -> Model | None:
    one = F.pmod(F.xxhash64("doc_id"), F.lit(1)).alias("_all")  # a single group; a literal would make its joins cross joins
    rows = sampled(documents.select("doc_id", one, "text"), "_all", sample_rows, seed, ["doc_id", "text"]).select("doc_id", "text")
    return fitted(rows.mapInArrow(_windows, "flat array<int>"), fit_windows)


def fit_windows(got: pa.Table) -> Model | None:
    windows = sorted(x.values.to_numpy().tolist() for x in got.column("flat"))
    if not windows or not any(B in w[-(len(w) // 7) :] for w in windows):
        return None
    cube = np.zeros((len(windows), 7, WINDOW), np.int64)
    real = np.zeros((len(windows), WINDOW), bool)
    for k, w in enumerate(windows):
        own = np.array(w).reshape(7, -1)
        cube[k, :, : own.shape[1]] = own
        real[k, : own.shape[1]] = True
    tag = cube[:, 6]
    tag[:, 0] = np.where(tag[:, 0] == I, B, tag[:, 0])
    return fit([cube[:, f] for f in range(6)], tag, real)


def _dearest_swap(moves: np.ndarray) -> float:
    """The most that moves can lose when one word goes outside and an inside word after it begins a secret instead."""
    most = -np.inf
    for p in (O, B, I):
        for s in (B, I):
            for n in (O, B, I):
                for m in (O, B, I):
                    old = moves[p, s] + moves[s, n] + moves[n, m]
                    other = B if n == I else n
                    new = moves[p, O] + moves[O, other] + moves[other, m]
                    if old > -1e8 and new > -1e8:
                        most = max(most, old - new)
    return most


def viterbi(score: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags of the words, texts beginning at `first`.

    A word whose score outside beats the others by more than any moves could make up for is outside on every best path.
    The stretches between such words are decoded together, step by step, longest first.
    """
    n = len(score)
    out = np.zeros(n, np.int8)
    if not n:
        return out
    after = np.zeros(n)
    after[:-1] = np.minimum(0, score[1:, B] - score[1:, I])
    after[first[1:-1][(first[1:-1] > 0) & (first[1:-1] <= n)] - 1] = 0
    open_ = score[:, O] - np.maximum(score[:, B], score[:, I]) + after <= max(0.0, _dearest_swap(moves))
    if not open_.any():
        return out
    at = np.flatnonzero(open_)
    row = np.searchsorted(first, at, side="right")
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (np.diff(row) > 0)
    begin = at[new]
    size = np.diff(np.append(np.flatnonzero(new), len(at)))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    # what lies before a stretch is outside, or the text's start, which allows the same moves
    best = score[begin] + moves[O]
    back = []
    for t in range(1, int(size[0])):
        live = int(np.searchsorted(-size, -t))
        step = best[:live, :, None] + moves
        back.append(step.argmax(axis=1).astype(np.int8))
        best[:live] = step.max(axis=1) + score[begin[:live] + t]
    last = (best + moves[:, O]).argmax(axis=1).astype(np.int8)
    for t in range(int(size[0]) - 1, -1, -1):
        live = int(np.searchsorted(-size, -t))
        out[begin[:live] + t] = last[:live]
        if t:
            last[:live] = back[t - 1][np.arange(live), last[:live]]
    return out


def _added(texts: W.Texts, model: Model, known: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the model finds and no base finding touches."""
    found = W.words(texts)
    tag = viterbi(_all_pairs(model.weights, features(texts, found)), model.moves, found.first)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(texts.rows)]
    begins = np.flatnonzero(tag == B)
    for a, r in zip(begins, np.searchsorted(found.first, begins, side="right") - 1, strict=True):
        z = a + 1
        while z < found.first[r + 1] and tag[z] == I:
            z += 1
        start, end = int(found.start[a] - texts.begin[r]), int(found.end[z - 1] - texts.begin[r])
        if all(end <= s or e <= start for s, _, e in known[r]):
            out[r].append((start, 3, end))
    return out


def _digest(spans: list[tuple[int, int, int]], points: np.ndarray | None) -> str:
    return ",".join(f"{KINDS[k]}:{points[a]}:{points[z]}" for a, k, z in sorted(spans))


def _masked(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    out, at = [], 0
    for a, _, z in sorted(spans):
        if z > at:
            out += [text[at : max(a, at)]] + [MASK] * (a >= at)
            at = z
    return b"".join([*out, text[at:]])


def scan(documents: DataFrame, model: Model | None, keep: list[str], mask: bool = False) -> DataFrame:
    """Columns `keep` of `documents` with counts by kind, the base spans' SHA-256, all spans, and the masked text if asked."""
    names = [*keep, "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"] + ["masked"] * mask

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, joined, masked = [], [], [], []
            for texts in W.chunks(batch.column(0)):
                base = base_spans(texts)
                added = _added(texts, model, base) if model else [[] for _ in base]
                for r in range(texts.rows):
                    own = base[r] + added[r]
                    counts.append([sum(k == kind for _, k, _ in own) for kind in range(4)])
                    points = None
                    if own:
                        data = texts.data[texts.begin[r] : texts.begin[r + 1]]
                        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    digests.append(hashlib.sha256(_digest(base[r], points).encode()).hexdigest())
                    joined.append(_digest(own, points))
                    if mask:
                        masked.append(_masked(texts.text(r), own).decode() if own else None)
            n = np.array(counts, np.int64).reshape(-1, 4)
            columns = [*batch.columns[1:], *(pa.array(n[:, k]) for k in range(4)), pa.array(digests, pa.string()), pa.array(joined, pa.string())]
            if mask:
                columns.append(pa.array(masked, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"`{c}` {t}" for c, t in documents.select(*keep).dtypes)
    kinds += ", n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string" + ", masked string" * mask
    return documents.select(F.col("text").alias("_text"), *keep).mapInArrow(run, kinds)
