"""Keyed merge into partitioned tables without a table format.

With a table format that supports ``MERGE INTO`` the catalog does this. Of tables of plain
files, only the partitions the batch touches are read and rewritten: a catalog table's
beside the old ones, to which the catalog then points, a folder's through dynamic
partition overwrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florin.session import cut_lineage, folders, remove


def schema_sync(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both, with the columns of both; absent ones are NULL."""
    return current.unionByName(batch, allowMissingColumns=True)


def unique_by(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch itself; running it fails when two rows share a key, NULLs counting as equal."""
    rest = [c for c in batch.columns if c not in keys]
    counted = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    message = F.lit(f"the batch has several rows for one key {list(keys)}")
    single = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.where(single).select(*batch.columns)


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, NULLs counting as equal; the other side's keys are named by ``_named``."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])


def _named(rows: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *others)


def merge_by_keys(current: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace current rows of the same key; all others stay.

    A column that the batch does not have keeps its stored value.
    """
    kept = current.join(_named(batch, keys), _same(keys), "left_anti")
    absent = [c for c in current.columns if c not in batch.columns]
    if absent:
        batch = batch.join(_named(current, keys, *absent), _same(keys), "left").select(*batch.columns, *absent)
    return schema_sync(kept, batch)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all its files."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def affected_partitions(current: DataFrame, batch: DataFrame, partition_keys: Sequence[str]) -> DataFrame:
    """Current rows of the partitions that the batch touches.

    The touched partitions are listed on the driver, as the partition overwrite
    does anyway, so that the scan reads no other directory.
    """
    touched = batch.select(*partition_keys).distinct()
    values = touched.collect()
    listed = current
    for position, key in enumerate(partition_keys):
        found = {row[position] for row in values}
        among = F.col(key).isin(found - {None})
        listed = listed.where(among | F.col(key).isNull() if None in found else among)
    if len(partition_keys) == 1:
        return listed
    return listed.join(_named(touched, partition_keys), _same(partition_keys), "left_semi")


def upsert_partitioned(
    batch: DataFrame, path: str, keys: Sequence[str], partition_keys: Sequence[str]
) -> None:
    """Create the table, or merge the batch into it; new columns are added.

    The merge writes whole partitions, so a task that is lost and retried ends in
    the same result, and running the same batch again changes nothing. The overwrite is
    not atomic: a driver lost while it commits can leave a partition without its old rows.
    """
    result = checked = cut_lineage(unique_by(batch, keys))
    current = existing(batch.sparkSession, path)
    if current is not None:
        # Stored before the overwrite: the rows survive in the checkpoint if the commit fails.
        result = cut_lineage(merge_by_keys(affected_partitions(current, checked, partition_keys), checked, keys))
    # Few files per partition, while a large partition is still split over tasks.
    (
        result.hint("rebalance", *partition_keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_keys)
        .parquet(path)
    )


def existing(spark: SparkSession, target: str) -> DataFrame | None:
    """The table, or None where there is none yet or a first write left no data."""
    if not is_path(target):
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return read_partitioned(spark, target)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_path(target: str) -> bool:
    """Whether a target names a folder; a catalog table's name has no slash."""
    return "/" in target


def upsert(batch: DataFrame, target: str, keys: Sequence[str], partition_keys: Sequence[str]) -> None:
    """Create or merge into a folder of files, or into a catalog table of the name."""
    if is_path(target):
        upsert_partitioned(batch, target, keys, partition_keys)
    else:
        upsert_table(batch, target, keys, partition_keys)


def upsert_table(batch: DataFrame, table: str, keys: Sequence[str], partition_keys: Sequence[str]) -> None:
    """Create the catalog table, or add the batch's new columns and merge the batch into it.

    A table whose format takes row-level changes gets ``MERGE INTO``. Tables of plain files
    get the touched partitions written to a new folder, to which the catalog then points;
    see ``replace_partitions``.
    """
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        checked = cut_lineage(unique_by(batch, keys))
        checked.hint("rebalance", *partition_keys).write.partitionBy(*partition_keys).saveAsTable(table)
        return
    if table_format(spark, table) not in PLAIN_FORMATS:
        merge_into(batch, table, keys)
        return
    stored = spark.table(table)
    added = [f for f in batch.schema if f.name not in stored.columns]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    checked = cut_lineage(unique_by(batch, keys))
    current = spark.table(table)
    result = cut_lineage(merge_by_keys(affected_partitions(current, checked, partition_keys), checked, keys))
    ordered = result.hint("rebalance", *partition_keys).select(*[f"`{c}`" for c in current.columns])
    if holds_partitions(spark, table, partition_keys):
        replace_partitions(ordered, table, partition_keys)
        return
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


VERSIONS = "_versions"  # a hidden folder of the table: readers of its files do not look into it
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """Provider, location and the like of a catalog table."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def holds_partitions(spark: SparkSession, table: str, partition_keys: Sequence[str]) -> bool:
    """Whether the catalog holds where each partition of a table of plain files lies, by these keys."""
    if table_format(spark, table) not in SELF_DESCRIBING:
        return False
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return columns == list(partition_keys) and described(spark, table).get("Partition Provider") == "Catalog"


def _partition_spec(folder: str, partition_keys: Sequence[str]) -> str:
    """SQL of the partition whose files a folder ``.../key=value/...`` holds."""
    parts = (unquote(p).split("=", 1) for p in folder.rstrip("/").split("/")[-len(partition_keys) :])
    return ", ".join(f"`{k}` = " + ("NULL" if v == NO_VALUE else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'") for k, v in parts)


def point_partition(spark: SparkSession, table: str, spec: str, folder: str) -> None:
    """Make the catalog read a partition from a folder: one change, seen wholly or not at all."""
    place = folder.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{place}'")


def replace_partitions(rows: DataFrame, table: str, partition_keys: Sequence[str]) -> None:
    """Replace the partitions that ``rows`` has, each as a whole.

    All files are written to a new folder first; then the catalog is pointed to it, partition by
    partition. A run that ends before leaves every old row readable, one that ends in between
    has some partitions new and the others old, and running it again completes it. Replaced
    files stay for readers under way, until ``remove_replaced``.
    """
    spark = rows.sparkSession
    facts = described(spark, table)
    folder = f"{facts['Location'].rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"
    kind = table_format(spark, table)
    rows.write.format(kind).partitionBy(*partition_keys).save(folder)
    files = spark.read.format(kind).load(folder).inputFiles()
    for place in sorted({f.rsplit("/", 1)[0] for f in files}):
        # Names of folders are encoded twice in the list of files: as partition values and as addresses.
        place = unquote(place)
        point_partition(spark, table, _partition_spec(place, partition_keys), place)
    spark.catalog.refreshTable(table)


def remove_replaced(spark: SparkSession, table: str) -> int:
    """Delete the written partitions to which the catalog points no more; returns how many went."""
    root = f"{described(spark, table)['Location'].rstrip('/')}/{VERSIONS}"
    depth = sum(c.isPartition for c in spark.catalog.listColumns(table))
    files = (unquote(f) for f in spark.table(table).inputFiles())
    used = {f.split(f"/{VERSIONS}/", 1)[1].rsplit("/", 1)[0] for f in files if f"/{VERSIONS}/" in f}
    places = folders(spark, root)
    for _ in range(depth):
        places = [f"{place}/{name}" for place in places for name in folders(spark, f"{root}/{place}")]
    gone = [place for place in places if place not in used]
    for place in gone:
        remove(spark, f"{root}/{place}")
    return len(gone)


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
SELF_DESCRIBING = {"parquet", "orc", "json"}  # files that name their columns
PLAIN_FORMATS = {"parquet", "orc", "csv", "json", "hive"}


def table_format(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else "hive"


def merge_into(batch: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same merge for a catalog table whose format supports ``MERGE INTO``."""
    view = f"batch_{uuid.uuid4().hex}"
    unique_by(batch, keys).createOrReplaceTempView(view)
    same_key = " AND ".join(f"t.`{k}` <=> b.`{k}`" for k in keys)
    spark = batch.sparkSession
    try:
        spark.sql(
            f"MERGE WITH SCHEMA EVOLUTION INTO {table} AS t USING {view} AS b ON {same_key} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )
    finally:
        spark.catalog.dropTempView(view)
