"""Keyed tables over compaction: replays, concurrent batches, vacuum; columns by name."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.session import unique_name, workdir
from tideline.sinks.keyed import KeyedTable

S3 = "k INT, ts INT, v STRING"


def table(spark, newest=()):
    return KeyedTable(spark, workdir(spark, "ledger"), ["k"], newest, name=unique_name("ledger"))


def put(spark, t, data, writer, batch, schema=S3):
    t.upsert(spark.createDataFrame(data, schema), writer=writer, batch=batch)


def test_a_folded_batch_sent_again_changes_nothing(spark):
    t = table(spark)
    put(spark, t, [(1, 0, "a")], "a", 0)
    put(spark, t, [(1, 1, "later")], "b", 0)
    t.compact()
    put(spark, t, [(1, 0, "a")], "a", 0)  # the replay
    assert rows(t.read()) == [(1, 1, "later")]
    put(spark, t, [(1, 2, "new")], "a", 1)
    put(spark, t, [(1, 0, "a")], "a", 0)
    assert rows(t.read()) == [(1, 2, "new")]
    t.compact()
    assert t.vacuum() == 3
    for w, b in (("a", 0), ("b", 0), ("a", 1)):
        put(spark, t, [(1, 0, "a")], w, b)
    assert rows(t.read()) == [(1, 2, "new")] and t.vacuum() == 0


def test_a_batch_that_arrives_during_compaction_is_neither_lost_nor_folded(spark, monkeypatch):
    t = table(spark)
    put(spark, t, [(1, 0, "a"), (2, 0, "a")], "a", 0)
    switch = KeyedTable._switch

    def late(self, folder):  # the base and its ledger are written, not yet in use
        put(spark, t, [(2, 1, "b"), (3, 1, "b")], "b", 0)
        assert rows(t.read()) == [(1, 0, "a"), (2, 1, "b"), (3, 1, "b")]
        switch(self, folder)

    monkeypatch.setattr(KeyedTable, "_switch", late)
    t.compact()
    monkeypatch.undo()
    assert rows(t.read()) == [(1, 0, "a"), (2, 1, "b"), (3, 1, "b")]
    assert spark.table(t.name).count() == 2
    t.compact()
    assert rows(t.read()) == [(1, 0, "a"), (2, 1, "b"), (3, 1, "b")]


def test_a_compaction_that_dies_changes_nothing(spark, monkeypatch):
    t = table(spark)
    put(spark, t, [(1, 0, "a")], "a", 0)
    t.compact()
    put(spark, t, [(1, 1, "b")], "a", 1)

    def dies(self, folder):
        raise OSError("gone")

    monkeypatch.setattr(KeyedTable, "_switch", dies)
    with pytest.raises(OSError):
        t.compact()
    monkeypatch.undo()
    assert rows(t.read()) == [(1, 1, "b")]
    t.compact()
    assert rows(t.read()) == [(1, 1, "b")]


@pytest.mark.parametrize("newest", [(), ("ts", "v")])
def test_any_order_of_batches_replays_and_compactions_is_the_fold(spark, newest):
    rnd = random.Random(len(newest))
    t, sent, want = table(spark, newest), [], {}
    for n in range(9):
        what = rnd.choice(["batch", "batch", "replay", "compact"]) if sent else "batch"
        if what == "compact":
            t.compact()
        elif what == "replay":
            put(spark, t, *rnd.choice(sent))
        else:
            data = [(k, rnd.randrange(9), f"{n}") for k in rnd.sample(range(6), 3)]
            sent.append((data, rnd.choice("ab"), n))
            put(spark, t, *sent[-1])
            for k, ts, v in data:
                if not newest or k not in want or (ts, v) > want[k][1:]:
                    want[k] = (k, ts, v)
    assert rows(t.read()) == sorted(want.values())


def test_columns_are_matched_by_name(spark):
    t = table(spark)
    put(spark, t, [(1, 0, "a"), (2, 0, "a")], "a", 0)
    put(spark, t, [("x", 2, "b", 1)], "a", 1, "Extra STRING, K INT, v STRING, ts INT")  # a new column, another order and case
    put(spark, t, [(3, "y")], "a", 2, "k INT, extra STRING")  # some columns only
    want = [(1, 0, "a", None), (2, 1, "b", "x"), (3, None, None, "y")]
    assert t.read().columns == ["k", "ts", "v", "Extra"] and rows(t.read()) == want
    t.compact()
    assert rows(t.read()) == want
    put(spark, t, [(1, 5.5)], "a", 3, "k INT, price DOUBLE")
    t.compact()
    assert rows(t.read().select("k", "price")) == [(1, 5.5), (2, None), (3, None)]
    assert "price" in spark.table(t.name).columns


def test_a_changed_type_and_reserved_names_are_refused(spark):
    t = table(spark)
    put(spark, t, [(1, 0, "a")], "a", 0)
    with pytest.raises(ValueError, match="ts is string"):
        put(spark, t, [(1, "0", "a")], "a", 1, "k INT, ts STRING, v STRING")
    with pytest.raises(ValueError, match="batch"):
        put(spark, t, [(1, 7)], "a", 1, "k INT, batch INT")
    assert rows(t.read()) == [(1, 0, "a")]


def test_an_empty_table_and_an_empty_batch(spark):
    t = table(spark)
    t.compact()
    assert not t.exists() and t.vacuum() == 0
    with pytest.raises(FileNotFoundError):
        t.read()
    put(spark, t, [], "a", 0)
    put(spark, t, [(1, 1, "x")], "a", 1)
    t.compact()
    assert rows(t.read()) == [(1, 1, "x")]
    t.upsert(spark.createDataFrame([(2, 2, "y")], S3).where(F.lit(False)), writer="a", batch=2)
    assert rows(t.read()) == [(1, 1, "x")]
