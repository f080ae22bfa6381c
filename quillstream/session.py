"""Sessions and the one place where the shared work folder is looked up."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quillstream") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_quillstream_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quillstream-")) / "quillstream.zip"  # the driver's file server hands it out
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"quillstream/{source.relative_to(root)}")
    context.addPyFile(str(archive))
    context._quillstream_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; one is set only where the cluster names none (local tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="quillstream-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so that later stages neither recompute it nor depend on one executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
