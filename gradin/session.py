"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, name: str = "gradin") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own.

    The JVM does not compile methods above 8,000 bytes to machine code. With the limit set
    to that, Spark generates smaller ones for projections that would exceed it. The report
    alone has more generated classes than the default of 100 that Spark keeps, and each one
    it drops is compiled again and starts cold.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    A local session without the setting gets a temporary folder. A cluster
    without it is an error: a folder on one machine is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="gradin-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Spark's setting that a query's shuffle files go when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a write are removed when the write ends. Otherwise they stay until the
    driver happens to collect its garbage, which over many writes is all of them at once."""
    before = spark.conf.get(RELEASE, None)
    if before == "true":
        yield
        return
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_root(spark)}/gradin-{label}-{uuid.uuid4().hex}"
