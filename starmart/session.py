"""Session construction and the shared scratch folder.

Lineage is cut with reliable ``checkpoint()`` into the folder the cluster
names in ``spark.checkpoint.dir``. Only when the session has none (local
runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "starmart",
                  shuffle_partitions: int | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.scheduler.mode", "FAIR")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder, set from conf if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/starmart/{name}-{uuid.uuid4().hex[:12]}"


def concurrently(spark: SparkSession, *tasks: Callable) -> list:
    """Results of independent pieces of work whose Spark jobs run beside each other.

    Each piece keeps its own order of jobs; tasks of one fill the cores that a short
    stage of another leaves idle. The first failure is raised once all have ended.
    """
    if len(tasks) < 2:
        return [t() for t in tasks]
    with ThreadPoolExecutor(len(tasks)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
    return [f.result() for f in futures]


def default_parallelism(spark: SparkSession) -> int:
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present in practice
        n = 200
    return max(1, n)


def local_path(uri: str) -> str | None:
    """Plain path for a ``file:`` URI (tests only); None for other schemes."""
    if uri.startswith("file:"):
        p = uri[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" not in uri and os.path.isabs(uri):
        return uri
    return None
