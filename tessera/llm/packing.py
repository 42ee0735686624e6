"""Packing token ids into windows by best-fit decreasing.

A document longer than a window is first cut into full windows; what remains of each
document is placed, longest first, into the open window with the least room that still
fits. A segment tree whose leaves are the possible amounts of room finds that window in
O(log window). Windows that stay partly empty are then filled by cutting pieces of the
emptiest windows, so a group ends with one padded window at most.

Every partition packs its own documents in groups of bounded size: nothing is shuffled,
and no task holds more than a group's ids.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import lean, text_of

#: Ids that a task holds before it packs them (4 bytes each).
GROUP_IDS = 6_000_000
#: Bytes of text that are encoded at a time.
ENCODE_BYTES = 4_000_000
# Fixed value: the pre-tokeniser's pattern of byte-level BPE.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_unicode() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character: itself, or the next free one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in plain}
    return table | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def tokeniser(path: str) -> Callable[[pa.Array], list[bytes]]:
    """texts -> the ids of each as little-endian uint32, as the tokenizers file at ``path`` has them, no special tokens added.

    A byte-level BPE never merges across pre-tokens, and a space followed by no other white
    space always begins one. So a batch is split at spaces, and each distinct word is
    encoded once, all of them in one call. Texts with a space before other white space or at
    their end are encoded whole, and those with a special token's string by the file's own
    tokeniser, as are all texts where the file isn't a plain byte-level BPE whose ids follow its merges.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec.get("added_tokens", [])]
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    vocab = {k: v for k, v in model.get("vocab", {}).items() if k not in special} if model.get("type") == "BPE" else {}
    merges = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model.get("merges", [])]
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and len(merges) + 256 == len(vocab) and merges == sorted(merges) and not model.get("dropout") and not model.get("ignore_merges")

    whole: list[Tokenizer] = []  # the file's own tokeniser, built for the first text that needs it

    def by_file(text: str) -> np.ndarray:
        if not whole:
            whole.append(Tokenizer.from_file(path))
        return np.asarray(whole[0].encode(text, add_special_tokens=False).ids, np.uint32)

    if not plain:
        return lambda texts: [by_file(t).tobytes() for t in texts.to_pylist()]
    to_byte = _bytes_of_unicode()
    ranks = {bytes(to_byte[c] for c in k): v for k, v in vocab.items()}
    bpe = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
    leads = np.zeros(max(ranks.values()) + 1, bool)
    leads[[v for k, v in ranks.items() if k[:1] == b" "]] = True
    odd = re.compile("|".join([r" \s", r" \Z", *map(re.escape, special)]))
    del spec, model, vocab, merges, ranks

    def encode(texts: pa.Array) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        own = texts.to_pylist()
        usual = []
        for i, t in enumerate(own):
            if not odd.search(t):
                usual.append(i)
            elif any(s in t for s in special):
                out[i] = by_file(t).tobytes()
            else:
                out[i] = np.asarray(bpe.encode_ordinary(t), np.uint32).tobytes()
        if not usual:
            return out
        parts = pc.split_pattern(texts if len(usual) == len(own) else texts.take(pa.array(usual)), " ")
        at = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        words, place = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        at = at - at[0]
        ids = np.asarray(bpe.encode_ordinary(" " + " ".join(words)), np.uint32)
        starts = np.flatnonzero(leads[ids])
        if len(starts) != len(words):  # a word is empty: only texts that are empty or begin with a space have one
            ids = [np.asarray(bpe.encode_ordinary(" " + w), np.uint32) for w in words]
            starts = np.cumsum([0, *map(len, ids)])[:-1]
            ids = np.concatenate(ids)
        # A text's first word has no space before it.
        firsts = [np.asarray(bpe.encode_ordinary(own[i].split(" ", 1)[0]), np.uint32) for i in usual]
        sizes = np.concatenate([np.diff(starts, append=len(ids)), list(map(len, firsts))]).astype(np.int64)
        ids = np.concatenate([ids, *firsts])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place[at[:-1]] = len(words) + np.arange(len(usual))
        n = sizes[place]
        ends = np.cumsum(n)
        ids = ids[np.repeat(begins[place] - ends + n, n) + np.arange(ends[-1])]
        cut = np.concatenate([[0], ends])[at]
        for k, i in enumerate(usual):
            out[i] = ids[cut[k] : cut[k + 1]].tobytes()
        return out

    return encode


class RoomTree:
    """Open windows by room left, 1 to ``window``; finds the tightest that fits in O(log window)."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, item: int) -> None:
        self.open[room].append(item)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, item) of the least room >= need, removed; None if there is none."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and not (not i & 1 and self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        item = self.open[room].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, item


def best_fit(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (index, start, length) pieces over documents of ``lengths`` ids; zero lengths get none."""
    full: list[list[tuple[int, int, int]]] = []
    rest = []
    for i, n in enumerate(lengths):
        cut = n - n % window
        full += [[(i, at, window)] for at in range(0, cut, window)]
        if n > cut:
            rest.append((n - cut, i, cut))
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree, windows, room = RoomTree(window), [], []
    for n, i, start in rest:
        if found := tree.take(n):
            left, w = found
        else:
            left, w = window, len(windows)
            windows.append([])
            room.append(window)
        windows[w].append((i, start, n))
        room[w] = left - n
        if room[w]:
            tree.add(room[w], w)
    # Empty the emptiest windows into the room of the others, cutting pieces as needed.
    order = sorted((w for w in range(len(windows)) if room[w]), key=lambda w: (room[w], w))
    a, b = 0, len(order) - 1
    while a < b:
        giver, taker = windows[order[b]], order[a]
        if not giver:
            b -= 1
            continue
        i, start, n = giver.pop()
        part = min(n, room[taker])
        if part < n:
            giver.append((i, start, n - part))
        windows[taker].append((i, start + n - part, part))
        room[taker] -= part
        room[order[b]] += part
        if not room[taker]:
            a += 1
    return full + [w for w in windows if w]


def _slices(b: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Runs of rows with at most ENCODE_BYTES of text, one row at least."""
    size = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + ENCODE_BYTES, "right")))
        yield b.column(0).slice(at, end - at), b.column(1).slice(at, end - at)
        at = end


def pack(df: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is the ids of its whole text, then ``end_id`` unless that is None; null text is
    empty. Each id lies in exactly one piece. Pieces of a sequence follow each other from
    offset 0 without gaps. A sequence has at most ``window`` ids. Repeated rows are packed as often
    as they occur; null ids stay null. Other columns are ignored. An empty table gives no pieces.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokeniser(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 36
        docs: list[tuple[int | None, bytes]] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows: list[tuple] = []
            for pieces in best_fit([len(ids) // 4 for _, ids in docs], window):
                at = 0
                for i, start, n in pieces:
                    ids = docs[i][1][4 * start : 4 * (start + n)]
                    rows.append((docs[i][0], start, n, zlib.crc32(ids), len(docs[i][1]) // 4, sequence, at, ids))
                    at += n
                sequence += 1
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            docs.clear()

        for b in batches:
            for doc_ids, texts in _slices(b):
                for doc_id, ids in zip(doc_ids.to_pylist(), encode(texts), strict=True):
                    docs.append((doc_id, ids + tail))
                    held += len(ids) // 4 + 1
                    if held >= GROUP_IDS:
                        yield from packed()
                        held = 0
        if docs:
            yield from packed()

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(lean(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
