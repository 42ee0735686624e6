import os

import pytest

from tessera.operators.tables import ColumnSpec
from tessera.streaming import clean as stream


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, name string")


def files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def held(store):
    return {r.id: r.name for r in store.current().collect()}


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    store = stream.Store(spark, str(tmp_path / "s"), ["id"], ["name"], buckets=40)
    store.merge(spark.range(2_000).selectExpr("cast(id AS string) id", "CASE WHEN id % 2 = 0 THEN concat('n', id) ELSE '' END name"), 0)
    first = store.pointer()["folders"]
    assert len(first) == 40
    before = files(tmp_path / "s")
    store.merge(spark.range(10).selectExpr("cast(id AS string) id", "'late' AS name"), 1)
    second = store.pointer()["folders"]
    changed = {b for b in second if second[b] != first[b]}
    assert 1 <= len(changed) <= 10
    written = set(files(tmp_path / "s")) - set(before)
    assert len({os.path.dirname(f) for f in written}) == len(changed)
    got = held(store)
    assert len(got) == 2_000 and got["4"] == "n4" and got["5"] == "late" and not got["11"]
    assert store.clean() == len(changed)
    assert held(store) == got


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    store = stream.Store(spark, str(tmp_path / "s"), ["id"], ["name"], buckets=4)
    store.merge(rows(spark, ("1", "a"), ("1", "b"), ("2", None)), 0)
    state, disk = store.pointer(), files(tmp_path / "s")
    store.merge(rows(spark, ("1", "a"), ("9", "x")), 0)
    assert store.pointer() == state and files(tmp_path / "s") == disk and set(held(store)) == {"1", "2"}
    store.merge(spark.createDataFrame([], "id string, name string"), 1)
    assert store.pointer()["batch"] == 1 and set(held(store)) == {"1", "2"}
    assert stream.Store(spark, str(tmp_path / "s"), ["id"], ["name"], buckets=99).buckets == 4


def test_a_batch_that_ends_before_the_pointer_moves_isnt_seen(spark, tmp_path, monkeypatch):
    store = stream.Store(spark, str(tmp_path / "s"), ["id"], ["name"], buckets=4)
    store.merge(rows(spark, ("1", "a")), 0)

    def lost(self, state):
        raise OSError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(stream.Store, "_point", lost)
        with pytest.raises(OSError):
            store.merge(rows(spark, ("1", "b"), ("2", "c")), 1)
    assert held(store) == {"1": "a"}
    store.merge(rows(spark, ("1", "b"), ("2", "c")), 1)
    assert held(store) == {"1": "a", "2": "c"}
    assert store.clean() >= 1 and held(store) == {"1": "a", "2": "c"}


def test_pages_repeated_within_the_delay(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name, text, day in (("1.tsv", "1\ta\n2\tb\n", 1), ("2.tsv", "1\ta\n3\tc\n", 1)):
        (src / name).write_text(text)
        os.utime(src / name, (day * 86_400, day * 86_400))
    raw = stream.raw_stream(spark, str(src), ["id", "name"], per_trigger=1, arrival="seen")
    once = stream.once_within(raw, ["id", "name"], "seen", "1 hour")
    query = once.writeStream.format("memory").queryName("once_rows").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.id, r.name) for r in spark.table("once_rows").collect()) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_cleaned_pages_reach_the_store(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.tsv").write_text('"1"\t"a"\n""\t"x"\n')
    cleaned = stream.clean_stream(stream.raw_stream(spark, str(src), ["id", "name"]), [ColumnSpec("id", "id", required=True), ColumnSpec("name", "name")])
    store = stream.Store(spark, str(tmp_path / "s"), ["id"], ["name"])
    stream.start(cleaned, store, str(tmp_path / "ck")).awaitTermination()
    assert held(store) == {"1": "a"}
