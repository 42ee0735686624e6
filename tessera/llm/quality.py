"""Quality by Naive Bayes support vectors over n-gram indicators.

The n-grams are runs of 1 to 3 token shapes (case, digits and punctuation of a token, or "the same
token again") and single words. Each indicator is scaled by the log ratio of its counts in the two
classes, a linear hinge-loss model is fitted by dual coordinate descent, and a sigmoid over
rows that the fit did not see turns its margin into a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of
from .features import associated, fetch, hashes, labelled_sample, once, places, slices, tokens

#: Labelled rows that the model is fitted on, and n-grams that it keeps.
TRAIN_ROWS, NGRAMS = 12_000, 20_000
_SHAPE = re.compile(r"[^\W\d_]+|\d+")


def _run(m: re.Match) -> str:
    s = m.group()
    if s[0].isdigit():
        return "9"
    return "X" if s.isupper() and len(s) > 1 else "Xx" if s[0].isupper() else "x"


def shape(word: str) -> str:
    """Letters as x, Xx or X, digits as 9; runs of other characters as they are, 6 at most."""
    s = _SHAPE.sub(_run, word)
    return s if len(s) <= 8 else s[:4] + "~" + s[-4:]


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and of its shape 1- to 3-grams, each once."""
    doc, word, vocabulary = tokens(texts, r"[\x20\x09-\x0D]+")
    own = hashes(vocabulary, "tessera-ngramwrd")
    shapes = hashes(pa.array([shape(w) for w in vocabulary.to_pylist()], pa.string()), "tessera-ngramshp")[word]
    again = np.zeros(len(doc), bool)
    again[1:] = (doc[1:] == doc[:-1]) & (word[1:] == word[:-1])
    shapes[again] = np.uint64(0x3D)
    docs, found = [doc, doc], [own[word], shapes]
    mixed = shapes
    for n in (2, 3):
        mixed = mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + shapes[n - 1 :] if len(mixed) else mixed
        inside = doc[: len(mixed)] == doc[n - 1 :][: len(mixed)]
        docs.append(doc[: len(mixed)][inside])
        found.append(mixed[inside] ^ np.uint64(n))
    return once(np.concatenate(docs), np.concatenate(found))


def log_count_ratios(y: np.ndarray, at: np.ndarray, place: np.ndarray, features: int, alpha: float = 1.0) -> np.ndarray:
    """log of (smoothed share among class 1) / (share among class 0) of each indicator."""
    label = np.repeat(y, np.diff(at))
    p = alpha + np.bincount(place[label == 1], minlength=features)
    q = alpha + np.bincount(place[label == 0], minlength=features)
    return np.log((p / (y.sum() + 2 * alpha)) / (q / (len(y) - y.sum() + 2 * alpha)))


def dual_coordinate_descent(y: np.ndarray, at: np.ndarray, place: np.ndarray, value: np.ndarray, features: int, cost: float = 0.5, epochs: int = 15, seed: int = 5) -> np.ndarray:
    """Weights (the bias last) of the L2-regularised hinge-loss model; both classes weigh the same."""
    sign = np.where(y == 1, 1.0, -1.0)
    top = cost * np.where(y == 1, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max(len(y) - y.sum(), 1)))
    w, dual = np.zeros(features + 1), np.zeros(len(y))
    rows = [(place[s:e], value[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]
    norm = np.array([x @ x + 1.0 for _, x in rows])
    r = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in r.permutation(len(y)):
            idx, x = rows[i]
            g = sign[i] * (w[idx] @ x + w[-1]) - 1
            new = min(max(dual[i] - g / norm[i], 0.0), top[i])
            if step := (new - dual[i]) * sign[i]:
                w[idx] += step * x
                w[-1] += step
                moved = max(moved, abs(step))
            dual[i] = new
        if moved < 1e-4:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a * margin + b), by Newton's method on smoothed targets; a is above 0."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, s = p - t, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margin**2).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, np.array([(d * margin).sum() + 1e-3 * (a - 1), d.sum() + 1e-3 * b]))
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
    return max(a, 1e-3), b


def quality(df: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = TRAIN_ROWS, ngrams_kept: int = NGRAMS) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) for each row of ``df``.

    Labels are learnt only from rows of ``labels`` (doc_id, label) for which ``train``, a
    condition over doc_id, holds: all, or a sample by hash of about ``train_rows``.
    Only the text is an input of a score, and all of it is. Null and empty texts get the
    score of a text without known n-grams. With labels of one kind only, scores are that
    label; with none, 0.5. Repeated rows are scored each; null ids stay null. Equal texts have equal scores; the
    registered query counts a score of just 0.7 as label 1. Other columns are ignored; an empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias(label_col))
    sample = labelled_sample(docs, marks, label_col, train, train_rows)
    known, rows, positive = associated(sample, ngrams, ngrams_kept)
    w, a, b = np.zeros(len(known) + 1), 1.0, 0.0
    if 0 < positive < rows:
        y, at, place = fetch(sample, ngrams, known)
        fit = np.random.default_rng(3).random(len(y)) < 0.8
        fit[np.unique(y, return_index=True)[1]] = True  # a row of each class at least
        parts = {k: np.flatnonzero(fit == k) for k in (True, False)}
        own = np.concatenate([place[at[i] : at[i + 1]] for i in parts[True]]) if len(place) else place
        own_at = np.concatenate([[0], np.cumsum(np.diff(at)[parts[True]])])
        ratio = log_count_ratios(y[parts[True]], own_at, own, len(known))
        w = dual_coordinate_descent(y[parts[True]], own_at, own, ratio[own], len(known))
        w[:-1] *= ratio
        doc = np.repeat(np.arange(len(y)), np.diff(at))
        margin = np.bincount(doc, w[place], len(y)) + w[-1]
        held = parts[False] if 0 < y[parts[False]].sum() < len(parts[False]) else np.arange(len(y))
        a, b = platt(margin[held], y[held])
    elif rows:
        b = 30.0 if positive else -30.0
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, 1):
                doc, place = places(*ngrams(part.column(1)), known)
                margin = np.bincount(doc, w[place], part.num_rows) + w[-1]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500))))], schema=schema)

    return docs.mapInArrow(lean(run), "doc_id long, score double")
