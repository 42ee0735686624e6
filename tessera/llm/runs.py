"""Periodic runs of words: the divide and conquer of Main and Lorentz over interned word ids.

A run is a stretch of words with smallest period q, at least max(LEAST_LENGTH, 2 q) words long, that no neighbouring word
extends. Each segment is cut at its middle. Z-functions over the right half, forwards, and over the left half, backwards,
tell for each distance p from the middle how far the words on both sides repeat: together p words or more make a
repetition that crosses the middle. It is extended past the segment's ends; equal intervals keep the smallest period. Then
both halves follow. Segments in which no GRAM words in a row occur twice can't hold a run and are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, lean, text_of

#: A run has at least so many words.
LEAST_LENGTH = 12
#: Words in a row that every run repeats one period later: LEAST_LENGTH - q of them, or q where the period is longer.
GRAM = LEAST_LENGTH // 2
#: Shorter matches than this are read off whole-array comparisons; a repetition has GRAM words on one or both sides of the middle.
SHORT = GRAM // 2
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Odd multipliers of the words of a gram.
_MIX = np.random.default_rng(12).integers(0, 2**63, GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def common_ahead(w: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on."""
    n, step, most = 0, 16, len(w) - max(a, b)
    while n < most:
        size = min(step, most - n)
        differ = w[a + n : a + n + size] != w[b + n : b + n + size]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + size, step * 4
    return n


def common_behind(w: np.ndarray, a: int, b: int) -> int:
    """How many words before ``a`` equal those before ``b``."""
    return common_ahead(w[::-1], len(w) - a, len(w) - b)


def z_values(seg: np.ndarray, mid: int) -> np.ndarray:
    """For each place j how many words from j on equal those from ``mid`` on: the Z-function of the right part, and of the left against it.

    Words that match in fewer than SHORT places need no loop; the loop over the others copies what the box, the match that
    reaches furthest right, already tells.
    """
    n = len(seg)
    z = np.zeros(n, np.int64)
    same = np.ones(n, bool)
    for k in range(min(SHORT, n - mid)):
        same[n - k :] = False
        same[: n - k] &= seg[k:] == seg[mid + k]
        z += same
    if n - mid < SHORT:
        z[mid] = n - mid
        return z
    long = np.flatnonzero(same)
    z[mid] = n - mid
    values = z.tolist()
    for part in (long[long > mid], long[long < mid]):
        left = right = -1
        for j in part.tolist():
            known = SHORT
            if j < right:
                known = values[mid + j - left]
                if known < right - j:
                    values[j] = known
                    continue
                known = right - j
            if max(j, mid) + known < n and seg[j + known] == seg[mid + known]:
                known += common_ahead(seg, j + known, mid + known)
            values[j] = known
            if j + known > right:
                left, right = j, j + known
    return np.array(values, np.int64)


def crossing(w: np.ndarray, l: int, r: int, m: int) -> np.ndarray:
    """(start, end, period) of the repetitions in w[l:r] over the middle ``m``, at least LEAST_LENGTH and two periods long.

    Of the same interval only the smallest period: the others are its multiples, and extend as far.
    """
    seg, mid = w[l:r], m - l
    n = r - l
    ahead = z_values(seg, mid)
    behind = np.zeros(n, np.int64)
    behind[1:] = z_values(seg[::-1], n - mid)[n - 1 : 0 : -1]
    at = np.arange(n)
    period = np.abs(at - mid)
    both = ahead + behind
    found = np.flatnonzero((period > 0) & (both >= period) & (both + period >= LEAST_LENGTH))
    start, end, p = l + np.minimum(at, mid)[found] - behind[found], l + np.maximum(at, mid)[found] + ahead[found], period[found]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    first = np.ones(len(p), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return np.stack([start[first], end[first], p[first]], axis=1)


def repeats_at(w: np.ndarray) -> np.ndarray:
    """For each place where GRAM words begin, the next place with the same ones (by hash, so perhaps too soon), or len(w)."""
    n = len(w) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for k in range(GRAM):
        grams += (w[k : k + n].astype(np.uint64) + np.uint64(1)) * _MIX[k]
    grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    following = np.full(n, len(w), np.int64)
    equal = grams[order[1:]] == grams[order[:-1]]
    following[order[:-1][equal]] = order[1:][equal]
    return following


def runs_of(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the word ids ``w``, by start, then period."""
    if len(w) < LEAST_LENGTH:
        return []
    following = repeats_at(w)
    best: dict[tuple[int, int], int] = {}
    todo = [(0, len(w))]
    while todo:
        l, r = todo.pop()
        if r - l < LEAST_LENGTH or not (following[l : r - GRAM + 1] <= r - GRAM).any():
            continue
        m = (l + r) // 2
        for start, end, p in crossing(w, l, r, m).tolist():
            if start == l:
                start -= common_behind(w, start, start + p)
            if end == r:
                end += common_ahead(w, end, end - p)
            if p < best.get((start, end), p + 1):
                best[start, end] = p
        todo += [(l, m), (m, r)]
    return sorted((s, e - s, p) for (s, e), p in best.items())


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run contains after its first period, joined by one space."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, p in runs:
            change[start + p] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return " ".join(words)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
#: Texts of an Arrow batch that are worked on at once, in characters: longer batches are cut.
BATCH_CHARS = 4_000_000


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: the last column is the text; in its place come n_words, runs and collapsed."""
    for whole in batches:
        chars = np.cumsum(pc.binary_length(whole.column(whole.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(chars // BATCH_CHARS, prepend=0)) if len(chars) else np.zeros(0, np.int64)
        bounds = np.unique([0, *cuts, whole.num_rows])
        for begin, end in zip(bounds[:-1], bounds[1:]):
            b = whole.slice(begin, end - begin)
            n_words, runs, texts = [], [], []
            for text in b.column(b.num_columns - 1).to_pylist():
                words = WORD.findall(text or "")
                ids = pa.array(words, pa.large_string()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(words) >= LEAST_LENGTH else np.zeros(0, np.int64)
                own = runs_of(ids)
                n_words.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                texts.append(collapsed(words, own))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n_words, pa.int64()), pa.array(runs, _RUNS), pa.array(texts, pa.string())], names=[*b.schema.names[:-1], "n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: the id, n_words long, runs (array of start, length, period), collapsed string.

    ``runs`` are all runs by start, then period, in words numbered from 0; ``collapsed`` joins the words that stay when each
    run keeps its first period only. Null and empty texts have no words, no runs and an empty ``collapsed``. Ids are passed
    on as they are, null or repeated; rows that repeat get a row each. Texts are worked on whole, however long; other
    columns are ignored. Every row is worked on where it is read: nothing is shuffled. An empty table gives an empty result.
    """
    key = free_name(df.select(text_col), "id") if id_col in ("n_words", "runs", "collapsed") else id_col
    given = df.select(F.col(id_col).alias(key), text_of(text_col).alias("text__"))
    schema = f"`{key}` {given.schema[0].dataType.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return given.mapInArrow(lean(_found), schema)
