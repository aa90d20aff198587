"""Session helpers: local sessions for tests and bench, and the checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def local_session(name: str = "campaign", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local
    folder would not survive the loss of an executor, so there the missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", "") or sc.getConf().get("spark.checkpoint.dir", "")
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="campaign-checkpoint-")
    sc.setCheckpointDir(folder)


def in_parallel(tasks: Sequence[Callable[[], object]], width: int = 4) -> list:
    """Run independent Spark actions side by side, so that small stages share the executors."""
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(tasks) or 1))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]
