"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs are designed for. The broadcast threshold is the size
# check behind every broadcast: only sides Spark measures below it are
# broadcast, larger ones fall back to shuffle joins.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(100 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the feature plans alias hundreds of generated expressions; constraint
    # inference over them grows combinatorially in the optimizer
    "spark.sql.constraintPropagation.enabled": "false",
    # a skewed join partition may be split even if that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the kinematic aggregate (exact quantiles) consumes the window output,
    # already sorted by trip: a sort aggregate streams one trip at a time with
    # no re-sort, where the object-hash aggregate re-sorts its input once a
    # task holds more than 128 trips
    "spark.sql.execution.useObjectHashAggregateExec": "false",
}


def build_session(master: str = "local[*]", app: str = "trackwise",
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()


@contextmanager
def constraints_off(spark: SparkSession) -> Iterator[None]:
    """Constraint inference as in RECOMMENDED_CONF while plans of many generated columns run
    one after the other, whatever the session's setting; the rows do not depend on it."""
    name = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, RECOMMENDED_CONF[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    Where it is unset, a local run (tests) gets a fresh folder under the system
    temp dir, removed when Python ends; on a cluster that is an error, as every
    executor would write to its own disk.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="trackwise-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        sc.setCheckpointDir(path)
    return path


def is_local(master: str) -> bool:
    """True for masters whose executors are this process (local, local[8], not local-cluster)."""
    return master == "local" or master.startswith("local[")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared folder, below the application's
    own staging folder (one folder to remove once the application's results are read)."""
    return os.path.join(shared_dir(spark), "trackwise-staging", spark.sparkContext.applicationId,
                        f"{name}-{uuid.uuid4().hex}")
