"""Configuration snapshots, and the catalog tables that configuration changes make."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.operators import dims
from tidewell.sinks.batches import globbed
from tidewell.sinks.catalog import CatalogTables
from tidewell.sources import literal, tables
from tidewell.streaming import jobs
from tidewell.streaming.config import ConfigSnapshots
from test_streaming_trade import START, change, same


def log(spark, *changes, start=0):
    """(op, source table, sink table, columns, key) as configuration changes."""
    rows = []
    for seq, (op, *entry) in enumerate(changes, start):
        entry = (*entry, None)
        rows.append((op, entry, None, seq) if op == "d" else (op, None, entry, seq))
    return literal.rows(spark, rows, s.DIM_CONFIG_CHANGE)


def test_a_snapshot_advanced_piece_by_piece_equals_the_whole_log(spark, tmp_path):
    whole = tables.dim_config_log(spark)
    snapshots = ConfigSnapshots(str(tmp_path / "config"))
    assert snapshots.newest(spark).isEmpty()
    handed = []
    for number, upto in enumerate([2, 2, 4, 6]):
        part = whole.where(F.col("seq") < upto)
        if number == 3:  # what a snapshot holds is not read again
            part = part.where("seq >= 4")
        got = snapshots.advance(part, number, lambda c: handed.append(sorted(r.sink_table for r in c.collect())))
        same(dims.current_config(got), dims.current_config(whole.where(F.col("seq") < upto)))
    assert handed == [["dim_nation", "dim_region"], ["dim_sku", "dim_supplier"], ["dim_nation"]]
    assert len(globbed(spark, str(tmp_path / "config" / "batch=*"))) == 2
    # A repeated micro-batch finds its snapshot.
    same(snapshots.advance(whole, 3), snapshots.newest(spark))


def test_changes_are_handed_over_again_when_the_batch_fails(spark, tmp_path):
    snapshots = ConfigSnapshots(str(tmp_path / "config"))

    def fail(_):
        raise OSError("lost")

    with pytest.raises(OSError):
        snapshots.advance(tables.dim_config_log(spark), 0, fail)
    handed = []
    snapshots.advance(tables.dim_config_log(spark), 0, lambda c: handed.append(c.count()))
    assert handed == [3]


@pytest.fixture()
def warehouse(spark, tmp_path):
    name = f"dims_{uuid.uuid4().hex}"
    yield jobs.Warehouse(spark, str(tmp_path), trigger={"availableNow": True}, catalog=name)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def arrive(spark, w, changes, seq):
    rows = [(json.dumps(c), seq + k) for k, c in enumerate(changes)]
    spark.createDataFrame(rows, s.MESSAGE).coalesce(1).write.mode("append").parquet(w.folder("topic_db"))


def sync(w):
    query = jobs.dimensions(w)
    query.awaitTermination(120)
    assert query.exception() is None


def rows(w, name):
    table = w.dimension_tables()
    columns = table.columns(w.spark, name)
    return columns, sorted(map(tuple, w.spark.table(table.name(name)).select(*columns).collect()))


def test_tables_are_made_and_widened_by_their_configuration(spark, warehouse):
    w = warehouse
    config = w.folder("table_process")
    log(spark, ("r", "part", "dim_sku", "p_partkey,p_name", "p_partkey"),
        ("r", "region", "dim_region", "r_regionkey,r_name", "r_regionkey")).write.parquet(config)
    arrive(spark, w, [change("part", "insert", START, {"p_partkey": k, "p_name": f"n{k}", "p_brand": "b"}) for k in range(40)], 0)
    sync(w)
    assert rows(w, "dim_sku") == (["p_partkey", "p_name"], sorted((str(k), f"n{k}") for k in range(40)))
    # Configured, no row so far: the table is there, empty.
    assert rows(w, "dim_region") == (["r_regionkey", "r_name"], [])
    # Between two batches one table gets a column, and another one appears.
    log(spark, ("u", "part", "dim_sku", "p_partkey, p_brand", "p_partkey"),
        ("c", "nation", "dim_nation", "n_name", "n_nationkey"), start=2).write.mode("append").parquet(config)
    arrive(spark, w, [
        change("part", "update", START + 9, {"p_partkey": 3, "p_name": "new", "p_brand": None}),
        change("part", "update", START - 9, {"p_partkey": 4, "p_name": "old", "p_brand": "old"}),
        change("region", "insert", START, {"r_regionkey": 1, "r_name": "it's"}),
    ], 100)
    sync(w)
    columns, got = rows(w, "dim_sku")
    assert columns == ["p_partkey", "p_name", "p_brand"] and len(got) == 40
    assert [r for r in got if r[0] == "3"] == [("3", None, "")]  # the row of the new configuration, a null is empty text
    assert ("4", "n4", None) in got  # an older version does not replace
    assert rows(w, "dim_region")[1] == [("1", "it's")]
    assert rows(w, "dim_nation") == (["n_name"], [])


def test_a_batch_may_come_again_and_a_catalog_may_be_new(spark, warehouse):
    w = warehouse
    log(spark, ("r", "part", "dim_sku", "p_partkey,p_name", "p_partkey")).write.parquet(w.folder("table_process"))
    arrive(spark, w, [change("part", "insert", START, {"p_partkey": k, "p_name": f"n{k}"}) for k in range(5)], 0)
    sync(w)
    before = rows(w, "dim_sku")
    stored = spark.read.schema(s.DIM_ROW).parquet(f"{w.dimensions().path}/kind=delta/batch=*")
    w.dimension_tables().upsert(w.dimensions().read(spark))
    assert stored.count() == 5 and rows(w, "dim_sku") == before
    # The session ends: another catalog gets the tables with their rows when the job starts.
    spark.sql(f"DROP TABLE {w.dimension_tables().name('dim_sku')}")
    sync(w)
    assert rows(w, "dim_sku") == before


def test_odd_names_and_keys(spark, tmp_path):
    made = CatalogTables(str(tmp_path / "it's"), f"dims_{uuid.uuid4().hex}")
    config = dims.current_config(log(spark, ("r", "t", "dim_odd", "a b,select", "k")))
    made.provide(spark, config)
    made.provide(spark, config)
    values = [("dim_odd", None, {"a b": "1"}, 1), ("dim_odd", "x", {"a b": "2", "select": ""}, None)]
    made.upsert(spark.createDataFrame(values, s.DIM_ROW))
    got = spark.table(made.name("dim_odd")).select("_pk", "a b", "select").collect()
    assert sorted(map(tuple, got), key=repr) == [("x", "2", ""), (None, "1", None)]
    spark.sql(f"DROP DATABASE {made.database} CASCADE")
