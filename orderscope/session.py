"""Spark session and shared-folder helpers.

The settings every job in this package relies on:

* the session time zone is UTC and every timestamp we produce is
  ``timestamp_ntz``, so year / month / hour never depend on where a job runs;
* ANSI mode stays on (the Spark 4 default): ratios go through ``try_divide``.

``get_session`` sets nothing else: master, memory, shuffle partitions and
adaptive execution are what the job was submitted with.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs need on any session, including one handed to us.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app_name: str = "orderscope", conf: dict[str, str] | None = None) -> SparkSession:
    """The active session, or a new one with what was submitted.

    ``conf`` is for callers that run locally on purpose (tests, benches).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return prepare(active)
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every job depends on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, for written tables and checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` as the cluster names it
    (an error if it is unset there). Only in local mode with the setting
    unset (tests, benches) do we make a fresh scratch folder and register it
    as the context's checkpoint folder, so that later calls and
    ``DataFrame.checkpoint`` use the same place.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    try:
        context = spark.sparkContext
    except Exception:  # a session without a local context (Spark Connect)
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors") from None
    registered = context.getCheckpointDir()
    if registered:
        return registered
    if not context.master.startswith("local"):
        # A machine-local folder is not shared by executors: refuse instead.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="orderscope-ckpt-")
    context.setCheckpointDir(local)
    return context.getCheckpointDir() or local


def fresh_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new, unique path under the shared folder.

    Unless ``keep`` is set, what is written there is released when the driver
    ends: intermediate tables are not left behind.
    """
    holder = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if keep:
        return holder
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(holder)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)              # only a path that exists can be marked
        system.deleteOnExit(path)
    except AttributeError:               # a session without a local context (Spark Connect)
        pass
    return f"{holder}/data"


def saved(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)      # registers the folder where none is set
    return df.checkpoint()
