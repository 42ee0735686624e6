import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm.packing import RoomTree, best_fit, pack, tokeniser
from tessera.llm.queries import op6_packing, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_room_tree_finds_the_tightest():
    r, tree, rooms = random.Random(0), RoomTree(64), []
    for i in range(3000):
        if r.random() < 0.55:
            n = r.randint(1, 64)
            tree.add(n, i)
            rooms.append(n)
        else:
            need = r.randint(1, 64)
            want = min((x for x in rooms if x >= need), default=None)
            got = tree.take(need)
            assert (got and got[0]) == want
            if want:
                rooms.remove(want)


def test_each_id_once_and_little_padding():
    r = random.Random(1)
    for _ in range(100):
        lengths = [r.choice([0, 1, 5, 100, 1024, 3000, r.randrange(0, 2500)]) for _ in range(r.randrange(0, 60))]
        seen = [set() for _ in lengths]
        windows = best_fit(lengths, 1024)
        for w in windows:
            assert w and sum(n for _, _, n in w) <= 1024
            for i, s, n in w:
                assert not seen[i] & set(range(s, s + n))
                seen[i] |= set(range(s, s + n))
        assert [len(x) for x in seen] == lengths
        assert sum(1024 - sum(n for _, _, n in w) for w in windows) < 1024


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_files(name):
    path = public_tokenizers.path(name)
    encode, tok, r = tokeniser(path), Tokenizer.from_file(path), random.Random(2)
    texts = ["", " ", "  ", " a", "a ", "\n a", "a\n \nb", "don't I'LL 12x", "a <|endoftext|> b", "x² ª", "日本 a", "a\x1c b \x1cd", "é" * 5000]
    texts += ["".join(r.choice([" ", " ", "\n", "a", "B", "é", "'s", "1", "½", ".", "\t", "日", "　", "_"]) for _ in range(r.randrange(1, 25))) for _ in range(300)]
    got = encode(pa.array(texts))
    assert [np.frombuffer(x, np.uint32).tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def check(rows, docs):
    tok, by = Tokenizer.from_file(PATH), {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)
        at = 0
        for p in sorted(by.pop(doc_id), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert zlib.crc32(ids[p.start : at].tobytes()) == p.ids_crc32
        assert at == len(ids)
    assert not by
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
    for w in windows.values():
        at = 0
        for p in sorted(w, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 1024


def test_query_round_trip(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    check(op6_packing(spark, "/root/testdata/sf0.001").collect(), docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "word " * 30_000), (4, "a"), (None, "b c")]
    df = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, start int")
    check(pack(df, PATH).collect(), docs)
    assert pack(df.filter("start = 0"), PATH).count() == 0
    twice = pack(df.union(df).filter("doc_id = 4").coalesce(1), PATH).collect()
    assert len(twice) == 2 and len({(r.sequence_id, r.offset) for r in twice}) == 2
