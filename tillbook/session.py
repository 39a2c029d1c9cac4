"""Session helpers: a local session for tests/bench, and the shared scratch root.

Scratch data (staging of table writes, fixture tables) lives under the folder
the cluster names in ``spark.checkpoint.dir``; a machine-local folder is only
chosen when that setting is unset (tests on a laptop).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillbook") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")        # domains of a day run side by side
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # listing thousands of day folders: a few tasks, not one per folder
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(2 * int(cores) if str(cores).isdigit() else 16))
        .config("spark.driver.memory", os.environ.get("TILLBOOK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only where none is set and the
    driver is the only executor.  On a cluster a folder of the driver's own disk would
    be another one on each executor, so an unset folder is an error there."""
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is unset on {master}: it has to name a "
                               "folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tillbook-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the scratch root (never reused)."""
    return f"{scratch_root(spark)}/tillbook/{label}-{uuid.uuid4().hex[:12]}"


# --- session settings of one action -------------------------------------------
_CONF_GUARD = threading.Lock()
_CONF_USES: dict[tuple, list] = {}        # (session, key) -> [uses, value before]


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set SQL options for one action, then restore the caller's values.

    Uses may overlap in threads: the first one sets an option and the last one
    restores it (every use of an option here sets the same value).
    """
    session = id(spark._jsparkSession) if hasattr(spark, "_jsparkSession") else id(spark)
    with _CONF_GUARD:
        for k, v in settings.items():
            use = _CONF_USES.setdefault((session, k), [0, spark.conf.get(k, None)])
            use[0] += 1
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _CONF_GUARD:
            for k in settings:
                use = _CONF_USES[session, k]
                use[0] -= 1
                if not use[0]:
                    del _CONF_USES[session, k]
                    if use[1] is None:
                        spark.conf.unset(k)
                    else:
                        spark.conf.set(k, use[1])


def list_conf(spark: SparkSession) -> dict[str, str]:
    """Listing a table's day folders: at most one task per core, not one per
    folder (Spark's default allows 10,000 tasks for thousands of tiny days)."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism":
            str(max(1, spark.sparkContext.defaultParallelism))}
