"""Session settings and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs one more shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Window and session state larger than memory stays on the executors' disks.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Merge a session's rows in each map task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(master: str | None = None, app: str = "marlstone", **settings: str) -> SparkSession:
    """A session with the settings this library expects.

    ``settings`` override or extend them; on a cluster leave ``master`` unset so that
    spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path that all executors can reach, below ``spark.checkpoint.dir``.

    Where that setting is missing, as in tests, the folder is ``scratch`` in the session's warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to Python workers that would not find it by themselves.

    Needed where the package is neither on ``PYTHONPATH`` nor in the folder a local session was started in. Spark's
    own file service hands the archive to every executor, those that join later too; it holds code only.
    """
    context = spark.sparkContext
    folder = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(folder)
    found = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.master.startswith("local"):
        found.append(os.getcwd())
    if context.applicationId in _shipped or not os.path.isdir(folder) or any(p and os.path.abspath(p) == root for p in found):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="marlstone-code-"), "marlstone.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, names in os.walk(folder):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(place, name)
                    out.write(full, os.path.relpath(full, root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
