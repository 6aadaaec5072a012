"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not compile methods beyond 8000 bytes of bytecode. The contract rules
    # generate larger ones; with this limit Spark splits them instead of running them
    # interpreted, which is several times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Batches of Arrow tasks are bounded by bytes besides rows: ten thousand long texts at
    # once, with what is made from them, would set the memory of a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "lendmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partition counts are left to adaptive execution, which merges small
    partitions and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **RUNTIME_SETTINGS,
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job go when it ends. Otherwise they stay until the driver happens
    to collect its garbage, so a run of many steps keeps those of all of them on the disk."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared folder of the cluster.

    The cluster names that folder in ``spark.checkpoint.dir``. Only where it is unset and
    everything runs in this process, as in tests, a temporary folder of this machine is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lendmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
