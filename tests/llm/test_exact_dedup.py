import hashlib
import re

import numpy as np
import pytest
from oracle import assert_same

from tessera.llm.exact_dedup import exact_duplicates, golomb_decode, golomb_encode
from tessera.llm.queries import OP1_SQL, op1_exact_dedup


@pytest.mark.parametrize("n", [0, 1, 2, 700, 20_000])
def test_golomb_round_trip(n):
    v = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    assert (golomb_decode(golomb_encode(v)) == v).all()
    dense = np.arange(n, dtype=np.uint64)
    assert (golomb_decode(golomb_encode(dense)) == dense).all()
    assert n < 700 or len(golomb_encode(v)) < 8 * n


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(i), str(keep[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm))


def test_against_brute_force(spark):
    rows = [(1, "a  b"), (2, "a\tb"), (3, "a b "), (4, None), (5, ""), (6, "x" * 200_000), (7, "x" * 200_000), (8, "é"), (None, "a b"), (9, "solo"), (9, "solo"), (None, None), (10, "\x0b"), (11, " ")]
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, h int, sha string").repartition(3)
    got = exact_duplicates(df).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute(rows)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_hot_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 2}") for i in range(3000)]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute(rows)


def test_empty(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    assert_same(spark, op1_exact_dedup, OP1_SQL, "/root/testdata/sf0.001")


def test_repeated_rows_under_other_file_layouts(spark):
    """Rows that repeat id and text: one of each group is kept, whichever way the written tables are divided when read."""
    rows = [(i // 4, f"text {i // 4}") for i in range(8_000)]
    found = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(9))
    own = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    try:
        for cost, most in ((own["spark.sql.files.openCostInBytes"], own["spark.sql.files.maxPartitionBytes"]), ("64m", "128m"), ("1", "4k"), ("1", "1g")):
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            kept = found.filter("kept").select("doc_id").collect()
            assert sorted(r.doc_id for r in kept) == list(range(2_000))
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)
