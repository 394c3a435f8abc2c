"""Session helpers: a local session for tests/bench, and shared scratch space.

Library code never creates its own session; it takes the caller's. Scratch
output (written tables, model artifacts, checkpoints) goes under the shared
folder that the cluster names in ``spark.checkpoint.dir``. Only when that is
unset (local tests) do we pick a folder ourselves and register it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for the Python workers of the application.

    The sources go out once per application by Spark's own file server, as
    ``--py-files`` would send them; the driver keeps a zip of a few KB.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="attrix-py-")) / "attrix.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name) / f.relative_to(root))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def local_session(cpus: int | str = "*", app: str = "attrix", shuffle_partitions: int = 8,
                  **extra: str) -> SparkSession:
    """A local-mode session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ATTRIX_DRIVER_MEMORY", "16g"))
    )
    for k, v in extra.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def slots(spark: SparkSession) -> int:
    """Tasks that the application's executors can run at a time."""
    sc = spark.sparkContext._jsc.sc()
    return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir`` when set.

    When it is unset (tests, a laptop) a fresh folder is created and set as
    the checkpoint dir, so ``DataFrame.checkpoint()`` works as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set on {master}: it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="attrix-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    jsc = spark.sparkContext
    if jsc.getCheckpointDir() is None:
        jsc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch root (nothing is deleted)."""
    return f"{scratch_root(spark)}/attrix/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a long lineage would be recomputed on executor loss (search
    and explanation inputs). Never a local checkpoint.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=eager)
