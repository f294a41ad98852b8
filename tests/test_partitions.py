"""Catalog tables whose partitions are replaced as a whole, and the newest-version table on top of them."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from florin.operators import merge
from florin.operators.channels import latest_accounts
from florin.operators.merge import existing, holds_partitions, remove_replaced, upsert, upsert_table
from florin.operators.newest import maintain_newest
from florin.operators.refunds import latest_date
from florin.sources.catalog import from_frames, from_tables
from tiny import schema_of

KEYS, PARTITIONS = ["k"], ["d"]


@pytest.fixture
def table(spark):
    name = "florin_partitions"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, *rows, columns="k int, v string, d string"):
    return spark.createDataFrame(list(rows), columns)


def content(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("k", "v", "d").collect()), key=repr)


def test_a_run_that_ends_before_the_catalog_changes_leaves_the_old_rows(spark, table, monkeypatch):
    upsert_table(frame(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "y")), table, KEYS, PARTITIONS)
    before = content(spark, table)
    assert holds_partitions(spark, table, PARTITIONS)

    def ends(*_):
        raise RuntimeError("the driver is gone")

    batch = frame(spark, (1, "A", "x"), (4, "D", "z"))
    with monkeypatch.context() as patch:
        patch.setattr(merge, "point_partition", ends)
        with pytest.raises(RuntimeError):
            upsert_table(batch, table, KEYS, PARTITIONS)
    spark.catalog.refreshTable(table)
    assert content(spark, table) == before
    upsert_table(batch, table, KEYS, PARTITIONS)
    assert content(spark, table) == [(1, "A", "x"), (2, "b", "x"), (3, "c", "y"), (4, "D", "z")]


def test_a_run_that_ends_between_two_partitions_is_completed_by_the_next(spark, table, monkeypatch):
    upsert_table(frame(spark, (1, "a", "x"), (2, "b", "y")), table, KEYS, PARTITIONS)
    batch, real, done = frame(spark, (1, "A", "x"), (2, "B", "y")), merge.point_partition, []

    def ends(*args):
        if done:
            raise RuntimeError("the driver is gone")
        done.append(real(*args))

    with monkeypatch.context() as patch:
        patch.setattr(merge, "point_partition", ends)
        with pytest.raises(RuntimeError):
            upsert_table(batch, table, KEYS, PARTITIONS)
    spark.catalog.refreshTable(table)
    # Every partition is wholly old or wholly new.
    assert content(spark, table) in ([(1, "A", "x"), (2, "b", "y")], [(1, "a", "x"), (2, "B", "y")])
    upsert_table(batch, table, KEYS, PARTITIONS)
    assert content(spark, table) == [(1, "A", "x"), (2, "B", "y")]


def test_odd_partition_values(spark, table):
    values = [None, "a b", "it's", "50%", "x=y", "a/b", "é:ß", "back\\slash", "%20"]
    upsert_table(frame(spark, *[(i, "old", v) for i, v in enumerate(values)]), table, KEYS, PARTITIONS)
    upsert_table(frame(spark, *[(i, "new", v) for i, v in enumerate(values)]), table, KEYS, PARTITIONS)
    assert content(spark, table) == sorted([(i, "new", v) for i, v in enumerate(values)], key=repr)
    for i, v in enumerate(values):
        assert spark.table(table).where(F.col("d").eqNullSafe(F.lit(v))).select("k").collect() == [(i,)]


def test_replaced_files_go_on_request_only(spark, table):
    for v in "abc":
        upsert_table(frame(spark, (1, v, "x"), (2, v, v)), table, KEYS, PARTITIONS)
    rows = content(spark, table)
    reader = spark.table(table)
    assert remove_replaced(spark, table) >= 1
    assert content(spark, table) == rows == sorted(tuple(r) for r in reader.select("k", "v", "d").collect())
    assert remove_replaced(spark, table) == 0


def versions(rng, n):
    """No two versions of an account share modification time and number."""
    start = datetime(2024, 1, 1)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "A", "B"]), start + timedelta(hours=rng.randrange(200)), i) for i in range(n)]
    return rows + [(99, "no time", None, n)]


@pytest.mark.parametrize("in_catalog", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_maintained_versions_equal_those_of_the_whole_history(spark, tmp_path, table, seed, in_catalog):
    """Whatever the order of the change days, and however often they come."""
    rng = random.Random(seed)
    rows = versions(rng, 300)
    days = {}
    for row in rows:
        days.setdefault(row[2] and row[2].date(), []).append(row)
    target = table if in_catalog else str(tmp_path / "newest")
    order = [*days, rng.choice(list(days))]
    rng.shuffle(order)
    for day in order:
        maintain_newest(accounts(spark, days[day]), target, buckets=4)
    whole = latest_accounts(accounts(spark, rows))
    kept = existing(spark, target)
    assert kept.count() == whole.count()
    # The table can take the history's place.
    src = from_frames(spark, {"accounts": kept})
    assert sorted(map(repr, latest_accounts(src["accounts"]).collect())) == sorted(map(repr, whole.collect()))


def accounts(spark, rows):
    return spark.createDataFrame(rows, schema_of("accounts"))


def adapter(spark, *days):
    frame = spark.createDataFrame([(d,) for d in days], "fecha_consulta date")
    empty = [F.lit(None).cast("string").alias(c) for c in schema_of("adapter").names if c != "fecha_consulta"]
    return frame.select(*empty, "fecha_consulta")


def test_latest_date_reads_the_newest_partition_that_has_rows(spark, table):
    days = [date(2024, 1, d) for d in (9, 10, 11)]
    adapter(spark, *days).write.partitionBy("fecha_consulta").saveAsTable(table)
    src = from_tables(spark, {"adapter": table})
    found = latest_date(src)
    assert found.collect() == [(days[-1],)]
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(fecha_consulta" in scan and "= 2024-01-11" in scan
    # Two newer partitions without rows, and one that is no date.
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (fecha_consulta = '2024-01-12')")
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (fecha_consulta = '2024-01-15')")
    upsert(adapter(spark, None).withColumn("name", F.lit("n")), table, ["name"], ["fecha_consulta"])
    assert latest_date(from_tables(spark, {"adapter": table})).collect() == [(days[-1],)]


def test_latest_date_without_partitions_or_rows(spark, table):
    adapter(spark, date(2024, 1, 9), date(2024, 1, 10)).write.saveAsTable(table)
    assert latest_date(from_tables(spark, {"adapter": table})).collect() == [(date(2024, 1, 10),)]
    assert latest_date(from_frames(spark, {"adapter": adapter(spark).limit(0)})).collect() == [(None,)]
    spark.sql(f"DROP TABLE {table}")
    adapter(spark).write.partitionBy("fecha_consulta").saveAsTable(table)
    assert latest_date(from_tables(spark, {"adapter": table})).collect() == [(None,)]
