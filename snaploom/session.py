"""Session construction for local runs; on a cluster the caller's session is used as it is."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(name: str = "snaploom", cores: int | str | None = None, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for a Spark context; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_snaploom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    name = Path(tempfile.mkdtemp(prefix="snaploom-")) / "snaploom.zip"
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    context.addPyFile(str(name))
    context._snaploom_shipped = True
