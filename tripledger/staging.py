"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``.

Used where a plan must not be computed twice (numbering rows, splitting good from bad) and
to cut lineage, so that a lost executor costs only its own tasks. Written as Parquet, so
later passes read just the columns they need and Spark knows the real size of the table.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A temporary one is set only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripledger-"))
    return spark.sparkContext.getCheckpointDir()


#: How tables are written that are stored for as long as a load or longer: a third of the size of the default.
DENSE = {"compression": "zstd"}
_CLEANUP, _SPLIT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.files.maxPartitionBytes"
#: Bytes of a split of such files, which hold several times the rows of others: tasks keep their size.
SPLIT_BYTES = 32 << 20

_LEAN: dict[str, tuple[int, dict[str, str | None]]] = {}
_LEAN_LOCK = threading.Lock()


@contextlib.contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when the query that wrote them ends, and scans take smaller splits.

    Otherwise shuffle files stay until the driver's garbage collector finds that nothing refers to them, so a load
    of many queries holds those of most of them at once. A query that runs within it must not be run again by
    the same frame, or it makes its shuffles anew; frames that are made within and run after it are as ever. These
    are settings of the session, and have their values again when the last of those who are within has left.
    """
    session = spark._jsparkSession.sessionUUID()
    with _LEAN_LOCK:
        users, before = _LEAN.get(session) or (0, {k: spark.conf.get(k, None) for k in (_CLEANUP, _SPLIT)})
        _LEAN[session] = users + 1, before
        if not users:
            spark.conf.set(_CLEANUP, "true")
            split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
            spark.conf.set(_SPLIT, str(min(split, SPLIT_BYTES)))
    try:
        yield
    finally:
        with _LEAN_LOCK:
            users, before = _LEAN.pop(session)
            if users > 1:
                _LEAN[session] = users - 1, before
            else:
                for key, value in before.items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Staging:
    """Stages frames under one folder; as a context manager it deletes them at the end. ``options`` are
    those of the writer."""

    def __init__(self, spark: SparkSession, **options: str):
        self.spark, self.options = spark, options
        self.folder = f"{shared_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        return f"{self.folder}/{label}-{uuid.uuid4().hex[:8]}"

    def part(self, label: str) -> "Staging":
        """A staging folder within this one, which can be cleared before it."""
        inner = Staging(self.spark, **self.options)
        inner.folder = self.path(label)
        return inner

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.options(**self.options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        self.clear()


_SESSIONS: dict[str, Staging] = {}


def session_staging(spark: SparkSession) -> Staging:
    """One staging folder for a whole application, for results that are read after the call that
    made them. It is cleared when the interpreter ends, or earlier by ``clear_session``."""
    app = spark.sparkContext.applicationId
    if app not in _SESSIONS:
        _SESSIONS[app] = Staging(spark)
        atexit.register(clear_session, app)
    return _SESSIONS[app]


def clear_session(app: str) -> None:
    """Delete the application's staging folder. A session that has ended cannot."""
    staging = _SESSIONS.pop(app, None)
    if staging is not None:
        with contextlib.suppress(Py4JError, Py4JNetworkError, ConnectionError, AttributeError):
            staging.clear()
