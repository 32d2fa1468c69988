"""Session set-up and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "listing-lake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Adaptive execution sizes the shuffle partitions and splits skewed joins; ``UTC`` keeps dates
    equal on every executor.  ``master`` is left to the cluster unless it is given.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Local stand-ins for the shared folder, by application, for sessions that name none.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session on one machine that names none (tests, a laptop) gets a fresh local folder, the same
    one for the life of the application.  On a cluster each executor would write to its own disk, so a
    session there must name a folder.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="listing-lake-")
        root = _LOCAL_ROOTS[application]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
