"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_LOCAL_SCRATCH: list[tempfile.TemporaryDirectory] = []
#: Folders of saved frames, for as long as the frames are held.
_SAVED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_RUN: ContextVar[Stages | None] = ContextVar("marquee_run", default=None)


def get_session(app_name: str = "marquee", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for.

    The master, memory, shuffle width and checkpoint folder belong to the submitter;
    pass them in ``conf`` with underscores for dots, or as a dict: ``**{"spark.x": "y"}``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Streaming state grows with the number of (entity, day) groups: keep it off the heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name if "." in name else name.replace("_", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str = "scratch") -> str:
    """A fresh path in the folder shared by all executors (``spark.checkpoint.dir``).

    Only a session that shows a local master may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", None) or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if not _LOCAL_SCRATCH:
            _LOCAL_SCRATCH.append(tempfile.TemporaryDirectory(prefix="marquee-"))
        shared = _LOCAL_SCRATCH[0].name
    path = f"{shared.rstrip('/')}/marquee-{purpose}-{uuid.uuid4().hex}"
    if (run := _RUN.get()) is not None:
        run.paths.add(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of any file system that Spark reads; one that is not there is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def create_file(spark: SparkSession, path: str, data: bytes) -> bool:
    """Create a small file with ``data``; False, and nothing is changed, if it is there already.

    Creation is as exclusive as the file system's own without overwriting: on HDFS by its name node, on object
    stores if their connector creates conditionally.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(where.getParent())
    try:
        out = store.create(where, False)
    except Py4JJavaError as failed:
        if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    out.write(bytearray(data))
    out.close()
    return True


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is deleted at its end; else it stays on disk until the driver's heap is collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialise(df: DataFrame, purpose: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation, and later
    passes stay columnar and pruned. Inside :func:`stages` the folder belongs to that run. Its shuffles go
    once it is written.
    """
    path = scratch_dir(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    _SAVED[saved] = path
    return saved


class Stages:
    """The scratch folders of one run, see :func:`stages`."""

    def __init__(self, spark: SparkSession, around: Stages | None):
        self.spark, self.around, self.paths = spark, around, set()

    def keep(self, df: DataFrame, purpose: str = "kept", **options: str) -> DataFrame:
        """``df`` in a form that outlives this run: it belongs to the run around it, or to nobody.

        A frame that :func:`materialise` has returned stays as it is; any other is saved first, as it may read
        stages that go.
        """
        saved = df if _SAVED.get(df) in self.paths else materialise(df, purpose, **options)
        self._hand_over(_SAVED[saved])
        return saved

    def keep_path(self, path: str, schema: StructType) -> DataFrame:
        """The same for Parquet files that were written to ``path``, to be read with ``schema``."""
        saved = self.spark.read.schema(schema).parquet(path)
        _SAVED[saved] = path
        self._hand_over(path)
        return saved

    def _hand_over(self, path: str) -> None:
        self.paths.discard(path)
        if self.around is not None:
            self.around.paths.add(path)

    def release(self, *frames: DataFrame) -> None:
        """Delete the folders of saved frames that nothing reads any more; frames of others are left alone."""
        for frame in frames:
            if (path := _SAVED.get(frame)) in self.paths:
                self.paths.discard(path)
                remove_path(self.spark, path)

    def end(self) -> None:
        while self.paths:
            remove_path(self.spark, self.paths.pop())


@contextmanager
def stages(spark: SparkSession) -> Iterator[Stages]:
    """A run that owns the scratch folders made inside it and deletes them at its end, failed or not.

    What must stay is named with ``keep``, what is used up earlier can go with ``release``. Runs nest: a
    kept frame then belongs to the outer run. Frames built inside must not be read after the end unless
    kept, as they read folders that are gone; a saved stage has no lineage, so a lost executor never needs
    the stages before it.
    """
    run = Stages(spark, _RUN.get())
    token = _RUN.set(run)
    try:
        yield run
    finally:
        _RUN.reset(token)
        run.end()
