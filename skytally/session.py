"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def make_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "skytally",
                 extra: dict[str, str] | None = None) -> SparkSession:
    """Local session used by tests and bench (a cluster passes its own)."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written state and lineage cuts.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory).  Only when neither is set and the master is local,
    as in tests, a fresh local folder is created and registered as checkpoint
    directory; on a cluster that is an error, as executors would write to
    disks that nobody else can read.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="skytally-checkpoint-")
        try:
            if sc is not None:
                sc.setCheckpointDir(path)
            else:
                spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # a session that does not accept it still gets the folder
            pass
    return path


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "skytally", f"{label}-{uuid.uuid4().hex[:12]}")
