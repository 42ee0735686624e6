"""Toxicity by a factorisation machine over hashed terms.

score = sigmoid(b + sum w_i + sum over pairs <v_i, v_j>): the vectors learn that two terms
together mean more than each alone. Terms are the lower-cased words of a text and their
first 3 to 7 letters, so that inflected forms share what they begin with. Those with the
largest chi-square against the label are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of
from .features import associated, fetch, hashes, labelled_sample, once, places, slices, tokens

#: Labelled rows that the model is fitted on, and terms that it keeps.
TRAIN_ROWS, TERMS = 12_000, 1_500
PREFIXES = (3, 4, 5, 6, 7)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and of their beginnings, each once."""
    doc, word, vocabulary = tokens(pc.utf8_lower(texts), r"[^\pL\pM\pN]+")
    key = np.unique(doc * len(vocabulary) + word) if len(doc) else doc
    doc, word = np.divmod(key, max(len(vocabulary), 1))
    docs, found = [doc], [hashes(vocabulary, "tessera-termword")[word]]
    length = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False)
    for k in PREFIXES:
        starts = pc.utf8_slice_codeunits(vocabulary, 0, k).dictionary_encode()
        own = hashes(starts.dictionary, "tessera-term-pre")[starts.indices.to_numpy()] + np.uint64(k)
        long = length[word] > k
        docs.append(doc[long])
        found.append(own[word[long]])
    return once(np.concatenate(docs), np.concatenate(found))


class FactorisationMachine:
    """A binary factorisation machine over indicator features, fitted by AdaGrad on the logistic loss."""

    def __init__(self, features: int, factors: int = 8, seed: int = 7):
        self.bias = 0.0
        self.w = np.zeros(features + 1, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (features + 1, factors)).astype(np.float32)

    def margins(self, at: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A document's linear part and pair part from the sums of its vectors."""
        pad = np.append(places, len(self.w) - 1)  # reduceat needs a last element; the last weight stays 0
        empty = at[1:] == at[:-1]
        v = self.v[pad]
        total = np.add.reduceat(v, at[:-1], axis=0)
        square = np.add.reduceat((v * v).sum(axis=1), at[:-1])
        out = np.add.reduceat(self.w[pad], at[:-1]) + 0.5 * ((total * total).sum(axis=1) - square)
        out[empty] = 0
        return self.bias + out

    def fit(self, y: np.ndarray, at: np.ndarray, places: np.ndarray, epochs: int = 20, batch: int = 128, rate: float = 0.08, l2: float = 1e-4, seed: int = 7) -> None:
        self.v[-1] = 0
        self.bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        r = np.random.default_rng(seed)
        seen_w, seen_v, seen_b = np.full(len(self.w), 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32), 1e-6
        sizes = np.diff(at)
        # The rarer class weighs more, by the square root of the ratio.
        weight = np.where(y == 1, np.sqrt((len(y) - y.sum()) / max(y.sum(), 1)), 1.0)
        for _ in range(epochs):
            order = r.permutation(len(y))
            for part in np.array_split(order, max(1, len(y) // batch)):
                n = sizes[part]
                own = np.concatenate([[0], np.cumsum(n)])
                idx = places[np.repeat(at[part] - own[:-1], n) + np.arange(own[-1])]
                g = (1 / (1 + np.exp(-np.clip(self.margins(own, idx), -30, 30))) - y[part]) * weight[part] / len(part)
                doc = np.repeat(np.arange(len(part)), n)
                v = self.v[idx]
                total = np.zeros((len(part), v.shape[1]), np.float32)
                np.add.at(total, doc, v)
                used, back = np.unique(idx, return_inverse=True)
                gw = np.bincount(back, g[doc], len(used)) + l2 * self.w[used]
                pull = g[doc, None] * (total[doc] - v)
                gv = np.stack([np.bincount(back, pull[:, k], len(used)) for k in range(v.shape[1])], axis=1) + l2 * self.v[used]
                seen_w[used] += gw**2
                seen_v[used] += gv**2
                self.w[used] -= rate * gw / np.sqrt(seen_w[used])
                self.v[used] -= 0.25 * rate * gv / np.sqrt(seen_v[used])
                seen_b += g.sum() ** 2
                self.bias -= rate * float(g.sum()) / np.sqrt(seen_b)


def toxicity(df: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS, terms_kept: int = TERMS, key_col: str | None = None) -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic likelier) for each row of ``df``.

    Labels are learnt only from rows of ``labels`` (doc_id, label) for which ``train``, a
    condition over doc_id, holds: all, or a sample by hash of about ``train_rows``.
    Only the text is an input of a score, and all of it is. Null and empty texts
    get the score of a text without known terms. Without labelled rows every score is 0.5.
    Repeated rows are scored each; null ids stay null. Equal texts have equal scores; the registered
    query counts a score of just 0.5 as toxic. ``key_col``, a column of whole numbers, is passed on. Other columns are ignored; an
    empty table gives an empty result.
    """
    keys = [key_col] if key_col else []
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), *(F.col(k).cast("long").alias(k) for k in keys))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias(label_col))
    sample = labelled_sample(docs, marks, label_col, train, train_rows)
    known, rows, positive = associated(sample, terms, terms_kept)
    model = FactorisationMachine(len(known))
    if 0 < positive < rows:
        model.fit(*fetch(sample, terms, known))
    elif rows:
        model.bias = 30.0 if positive else -30.0
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), *((k, pa.int64()) for k in keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                doc, place = places(*terms(b.column(1)), known)
                at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b.num_rows))]).astype(np.int64)
                margin = np.clip(model.margins(at, place).astype(np.float64), -500, 500)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-margin))), *b.columns[2:]], schema=schema)

    return docs.mapInArrow(lean(run), "doc_id long, score double" + "".join(f", `{k}` long" for k in keys))
