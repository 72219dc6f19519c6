"""Session helpers: building a session, cutting lineage, checking sizes before a broadcast."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few dozen bytes that every executor can hold; a table is only broadcast after a count against this bound.
BROADCAST_ROWS = 500_000


def session(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine is tested under."""
    return (
        SparkSession.builder.master(master)
        .appName("quillstone")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def _shared_folder(spark: SparkSession) -> str | None:
    """The folder the cluster names for checkpoints, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once per application, so that they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    if here.is_dir():  # else the package already runs from an archive
        # built where executors can see it too, if such a folder is known; Spark serves it to them in any case
        shared = _shared_folder(spark)
        local = shared.removeprefix("file://") if shared and (shared.startswith("file://") or "://" not in shared) else None
        folder = Path(local) / f"ship-{sc.applicationId}" if local else Path(tempfile.mkdtemp(prefix="quillstone-ship-"))
        folder.mkdir(parents=True, exist_ok=True)
        target = folder / "quillstone.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(here.rglob("*.py")):
                z.write(f, f"{here.name}/{f.relative_to(here)}")
        sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = _shared_folder(spark)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillstone-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, below the one for checkpoints."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the shared checkpoint folder, so that a lost executor costs nothing upstream."""
    _ensure_checkpoint_dir(df.sparkSession)
    ship(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows (counted), else `df` as it is, for a shuffled join."""
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
