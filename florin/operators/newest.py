"""A maintained table of the newest version of every account.

The history of versions grows for ever; what the report needs of it does not. Each day's
changed versions are merged into a table with one row per account by the same
``max(struct)`` that finds the newest version of a whole history. As a maximum does not
depend on order or repetition, changes may come late, twice or out of order.

The table has the columns of the accounts source, so it can stand in its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.operators.merge import affected_partitions, existing, upsert
from florin.session import cut_lineage

KEY = "clave_codificada"
BUCKET = "bucket"
BUCKETS = 64  # partitions of the table; a merge rewrites those that the changes fall into


def newest_versions(versions: DataFrame) -> DataFrame:
    """Of every account the last modified version, of equal times the highest number."""
    order = F.struct("fecha_ultima_modificacion", "version")
    newest = F.max(F.struct(order.alias("modified"), F.col("id").alias("id"))).alias("newest")
    return versions.groupBy(KEY).agg(newest).select(
        KEY,
        F.col("newest.id").alias("id"),
        F.col("newest.modified.fecha_ultima_modificacion").alias("fecha_ultima_modificacion"),
        F.col("newest.modified.version").alias("version"),
    )


def maintain_newest(changes: DataFrame, target: str, buckets: int = BUCKETS) -> None:
    """Merge changed versions into the table of newest versions: a folder, or a catalog table's name.

    ``buckets`` must stay the same for a table. Only the buckets of changed accounts are
    read and written, and of them only the changed accounts are compared.
    """
    bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")
    batch = cut_lineage(newest_versions(changes).withColumn(BUCKET, bucket))
    current = existing(batch.sparkSession, target)
    if current is not None:
        asked = batch.select(F.col(KEY).alias("_key"))
        held = affected_partitions(current, batch, [BUCKET]).join(asked, F.col(KEY).eqNullSafe(F.col("_key")), "left_semi")
        versions = held.select(*batch.columns).unionByName(batch)
        batch = newest_versions(versions).withColumn(BUCKET, bucket)
    upsert(batch, target, [KEY], [BUCKET])
