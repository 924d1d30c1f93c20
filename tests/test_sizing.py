"""Tasks of bounded size: the goal for a task's bytes, and partitions by the tables' size."""

import pytest

from paidpath.operators import sizing
from paidpath.sources.tables import Catalog, TableCatalog


@pytest.fixture()
def fresh(spark):
    """A session of its own settings, without a goal for tasks."""
    s = spark.newSession()
    for key in (sizing.TASK_KEY, sizing.PARTITIONS_KEY):
        s.conf.unset(key)
    return s


@pytest.fixture()
def tables(spark, tmp_path):
    spark.range(0, 200000, numPartitions=4).selectExpr("id", "uuid() AS k").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_a_read_table_bounds_the_tasks(fresh, tables, monkeypatch):
    monkeypatch.setattr(sizing, "PARTITION_BYTES", 1 << 18)
    monkeypatch.setattr(sizing, "TASK_BYTES", 1 << 20)
    t = Catalog(fresh, tables)("orders", ["id", "k"])
    counts = t.groupBy("k").count().select("k")
    assert int(fresh.conf.get(sizing.TASK_KEY)) == 1 << 20
    assert int(fresh.conf.get(sizing.PARTITIONS_KEY)) == -(-sizing.estimated_bytes(fresh.read.parquet(f"{tables}/orders.parquet")) // (1 << 18))
    assert counts.rdd.getNumPartitions() >= 6  # 8 MB of texts that do not compress; 4 at most by the cores alone
    assert counts.count() == 200000


def test_a_session_keeps_its_own_bounds(fresh, tables, monkeypatch):
    monkeypatch.setattr(sizing, "PARTITION_BYTES", 1 << 18)
    fresh.conf.set(sizing.TASK_KEY, "1234567")
    fresh.conf.set(sizing.PARTITIONS_KEY, "5000")
    fresh.read.parquet(f"{tables}/orders.parquet").createOrReplaceTempView("own_orders")
    TableCatalog(fresh, names={"orders": "own_orders"})("orders", ["id"])
    assert (fresh.conf.get(sizing.TASK_KEY), fresh.conf.get(sizing.PARTITIONS_KEY)) == ("1234567", "5000")


def test_small_tables_leave_the_partitions(fresh, tables):
    Catalog(fresh, tables)("orders", ["id"])
    assert fresh.conf.get(sizing.PARTITIONS_KEY, None) is None
