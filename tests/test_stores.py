"""Versioned tables, drifting types and resumed runs: writers that die or meet, files that can't be one, kills after each step."""

import pytest
from pyspark.sql import functions as F

from rillflow.operators.integrity import GateError
from rillflow.plans.journal import HALTED, Journal
from rillflow.sources import drift
from rillflow.sources.versions import ConflictError, VersionedTables


def ids(frame):
    return sorted(r[0] for r in frame.select("id").collect())


def test_replaced_as_one_step(spark, tmp_path):
    store = VersionedTables(spark, f"file://{tmp_path}/store")
    assert store.version() == 0 and store.folders() == {}
    assert store.publish(spark.range(10), {"base": None, "subset": "id < 3", "pilot": "id = 1"}) == 1
    reader = store.read("base")
    with pytest.raises(Exception, match="dies"):  # a writer that is killed half-way
        store.replace({"subset": spark.range(5), "base": spark.range(4).select(F.raise_error(F.lit("dies")).cast("long").alias("id"))})
    assert store.version() == 1 and ids(store.read("subset")) == [0, 1, 2] and ids(store.read("base")) == list(range(10))
    assert store.replace({"base": spark.range(2)}) == 2
    assert ids(store.read("base")) == [0, 1] and ids(store.read("pilot")) == [1] and ids(store.read("base", 1)) == list(range(10))
    assert ids(reader) == list(range(10))  # who read before goes on reading the same version
    assert store.remove_old(keep=1) >= 1 and ids(store.read("subset")) == [0, 1, 2]


def test_of_two_writers_one_wins(spark, tmp_path):
    store, other = (VersionedTables(spark, f"file://{tmp_path}/store") for _ in range(2))
    store.replace({"t": spark.range(3)})
    base = other.version()
    store.replace({"t": spark.range(5)}, base)
    with pytest.raises(ConflictError):
        other.replace({"t": spark.range(1)}, base)
    assert ids(store.read("t")) == [0, 1, 2, 3, 4]
    calls = []

    def meanwhile(old):
        if not calls:  # another writer is first: this one starts again from its version
            store.upsert("t", spark.createDataFrame([(9,)], "id long"), ["id"])
        calls.append(1)
        return old.where("id > 1")

    assert other.change("t", meanwhile) == 4 and len(calls) == 2 and ids(store.read("t")) == [2, 3, 4, 9]


def test_drifting_types_in_one_scan(spark, tmp_path):
    parts = {"a": "id int, v int", "b": "v long, id int", "c": "id long, v double, extra date", "d": "id int, v string", "e": "id int, w decimal(6,2)", "f": "id int, w int"}
    values = {"a": [(1, 5)], "b": [(1 << 40, 2)], "c": [(3, 0.5, None)], "d": [(4, "five")], "e": [(5, None)], "f": [(6, 7)]}
    for name, schema in parts.items():
        spark.createDataFrame(values[name], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    got = drift.scan(spark, f"{tmp_path}/in/*")
    assert {(f.name, f.dataType.simpleString()) for f in got.schema} == {("id", "bigint"), ("v", "string"), ("extra", "date"), ("w", "decimal(12,2)")}
    assert sorted((r["id"], r["v"]) for r in got.collect() if r["v"]) == [(1, "5"), (2, str(1 << 40)), (3, "0.5"), (4, "five")]
    assert got.count() == 6 and drift.scan(spark, f"{tmp_path}/in/[abc]").schema["v"].dataType.simpleString() == "double"
    spark.createDataFrame([(7, [1])], "id int, v array<int>").coalesce(1).write.parquet(f"{tmp_path}/in/g")
    with pytest.raises(ValueError, match="column v.*array<int>.*in/g/part"):
        drift.scan(spark, f"{tmp_path}/in/*")
    with pytest.raises(FileNotFoundError):
        drift.scan(spark, f"{tmp_path}/none")


class Killed(Exception):
    """Stands for a process that dies."""


def run(spark, path, kill_after=None, bad=False, log=None):
    """Three steps over a store of tables: load, derive, publish; dies after the numbered step's work, before its entry."""
    journal, store = Journal(spark, f"{path}/journal"), VersionedTables(spark, f"{path}/store")

    def step(number, name, key, work):
        def whole():
            (log if log is not None else []).append(name)
            result = work()
            if kill_after == number:
                raise Killed
            return result

        return journal.step(name, key, whole)

    def gate():
        if bad:
            raise GateError("a gate trips", 2)
        return store.read("facts").count()

    step(0, "load", {"days": 3}, lambda: store.version() or store.replace({"facts": spark.range(3)}))
    n = step(1, "gate", {"version": 1}, gate)
    step(2, "publish", {"n": n}, lambda: spark.range(n).write.mode("overwrite").parquet(f"{path}/out"))
    return ids(spark.read.parquet(f"{path}/out")), store.version()


def test_killed_after_each_step_the_end_is_the_same(spark, tmp_path):
    want = run(spark, f"file://{tmp_path}/undisturbed")
    for k in range(3):
        path, log = f"file://{tmp_path}/killed-{k}", []
        with pytest.raises(Killed):
            run(spark, path, kill_after=k, log=log)
        assert run(spark, path, log=log) == want and run(spark, path, log=log) == want
        # a step is run again only if it was the one that died
        assert log == [*["load", "gate", "publish"][: k + 1], *["load", "gate", "publish"][k:]]


def test_a_halt_stands_until_it_is_lifted(spark, tmp_path):
    path = f"file://{tmp_path}/run"
    with pytest.raises(GateError) as error:
        run(spark, path, bad=True)
    assert error.value.code == 2
    with pytest.raises(GateError, match="halted at gate: a gate trips") as error:
        run(spark, path)
    assert error.value.code == HALTED
    journal = Journal(spark, f"{path}/journal")
    assert journal.halt()["code"] == 2
    journal.lift()
    assert run(spark, path) == ([0, 1, 2], 1)
