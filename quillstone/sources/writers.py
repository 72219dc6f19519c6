"""Sinks: CSV with or without typed headers, batch partitions, one-row JSON metadata, property batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_csv(df: DataFrame, path: str, headers: Mapping[str, str] | None = None, single: bool = False, mark: bool = False, bare_if_empty: bool = False) -> int:
    """CSV with a header, cells as they are; returns the number of rows. `headers` renames columns for the reader ("id" to "id:ID(Node)");
    `single` writes one file, for tables that a loader wants whole; `mark` puts a byte-order mark before the header of
    every file; `bare_if_empty` leaves the header out where there are no rows."""
    names = [(headers or {}).get(c, c) for c in df.columns]
    if mark and names:
        names[0] = "\ufeff" + names[0]
    from pyspark.sql import Observation

    seen = Observation()
    named = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names, strict=True))).observe(seen, F.count(F.lit(1)).alias("n"))
    out = named.coalesce(1) if single else named
    header = not (bare_if_empty and df.isEmpty())
    out.write.mode("overwrite").csv(path, header=header, quote='"', escape='"', quoteAll=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return int(seen.get["n"])


def write_batch(df: DataFrame, root: str, batch: str = "batch") -> None:
    """Parquet below `root`/batch=.../; only the batches in `df` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(root)


def metrics(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """One row of counters in one pass."""
    return df.agg(*(c.alias(n) for n, c in counts.items()))


def write_metadata(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)


def batch_numbers(df: DataFrame, order: str, size: int = 500) -> DataFrame:
    """Rows with `batch_no`, `size` consecutive rows by `order` to a batch. Numbered by range partitions and their
    counts, so no task sees more than its share."""
    from quillstone.runtime import cut

    ranged = cut(df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    before = Window.partitionBy(F.lit(1)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select("_p", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = ranged.join(F.broadcast(starts), ["_p"])
    return numbered.withColumn("batch_no", F.floor((F.col("_start") + F.col("_m") - F.col("_first")) / size).cast("int")).drop("_p", "_m", "_first", "_start")


def publish(spark, tables: Mapping[str, str], root: str, tag: str | None = None) -> dict[str, str]:
    """Copies tables (name to path) below `root`/batch_job=`tag`/, on any file system Spark reaches; a table that is not
    there is passed over. Returns where each went. The tag is the time of day if left out."""
    import datetime

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    prefix = f"{root.rstrip('/')}/batch_job={tag or datetime.datetime.now(datetime.UTC).strftime('%Y%m%d_%H%M%S')}"
    done = {}
    for name, path in tables.items():
        source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{prefix}/{name}")
        there, here = source.getFileSystem(conf), target.getFileSystem(conf)
        if there.exists(source):
            here.mkdirs(target.getParent())
            jvm.org.apache.hadoop.fs.FileUtil.copy(there, source, here, target, False, conf)
            done[name] = f"{prefix}/{name}"
    return done


def import_files(nodes: Mapping[str, str], edges: Mapping[str, str], overwrite: bool = True) -> list[str]:
    """Arguments for a bulk loader of graphs: one for each node table (label to path) and edge table (type to path)."""
    return [*(["--overwrite-destination"] if overwrite else []), *(f"--nodes={label}={path}" for label, path in nodes.items()), *(f"--relationships={kind}={path}" for kind, path in edges.items())]
