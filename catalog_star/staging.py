"""Stage tables: lineage is cut by writing Parquet to storage all executors reach."""

from __future__ import annotations

import atexit
import hashlib
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


class StageScope:
    """The stages of one run, which can be dropped without touching those of others."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.paths: list[str] = []

    def drop(self) -> int:
        """Delete the scope's stages; returns how many paths were there. Call it once nothing reads them any more."""
        hadoop = self._spark._jvm.org.apache.hadoop.fs
        conf = self._spark.sparkContext._jsc.hadoopConfiguration()
        dropped = 0
        while self.paths:
            path = hadoop.Path(self.paths.pop())
            dropped += bool(path.getFileSystem(conf).delete(path, True))
        return dropped


class ResumableScope(StageScope):
    """The stages of a job that may be started again: their paths follow from what the job reads and how, and from their order in it.

    A stage that an earlier attempt finished bears Spark's marker and is taken up as it is; one that broke off is written anew.
    """

    def __init__(self, spark: SparkSession, fingerprint: str):
        super().__init__(spark)
        self._folder = f"{stage_root(spark)}/catalog_star/resumable/{fingerprint}"
        self.count = 0
        self.taken_up: list[str] = []

    def place(self, label: str) -> str:
        self.count += 1
        path = f"{self._folder}/{self.count:03d}-{label}"
        self.paths.append(path)
        return path

    def finished(self, path: str) -> bool:
        marker = self._spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return marker.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def fingerprint(inputs: list[DataFrame], *parameters: object) -> str:
    """What a job reads and how: name, size and time of change of every input file, plans and schemas of the inputs, and parameters."""
    digest = hashlib.sha256()
    for df in inputs:
        spark = df.sparkSession
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
        files = set(df.inputFiles())
        found = []
        for folder in sorted({f.rsplit("/", 1)[0] for f in files}):  # one listing a folder
            path = hadoop.Path(spark._jvm.java.net.URI(folder))
            found += [(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in path.getFileSystem(conf).listStatus(path) if s.isFile()]
        plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
        digest.update(repr((sorted(found), plan, df.schema.json())).encode())
    digest.update(repr(parameters).encode())
    return digest.hexdigest()[:40]


#: Bytes of a stage after which the driver's garbage is collected.
LARGE = 32 << 20

_PROGRAM = uuid.uuid4().hex
_to_remove: set[str] = set()
_scope: ContextVar[StageScope | None] = ContextVar("scope", default=None)


@contextmanager
def stage_scope(spark: SparkSession, resume: str | None = None) -> Iterator[StageScope]:
    """Stages made inside belong to the scope, and to no scope around it. Leaving it drops nothing: results may still read them.

    ``resume`` is the fingerprint of a job whose finished stages are taken up when it runs again.
    """
    scope = ResumableScope(spark, resume) if resume else StageScope(spark)
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)


def current_scope() -> StageScope | None:
    return _scope.get()


def stage_root(spark: SparkSession) -> str:
    """Folder for stage tables: the one ``spark.checkpoint.dir`` names, else one below the warehouse folder.

    Both are shared by driver and executors. What a local program without the setting stages goes when it ends.
    """
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages/{_PROGRAM}"
    if spark.conf.get("spark.master", "").startswith("local") and root not in _to_remove:
        _to_remove.add(root)
        atexit.register(shutil.rmtree, root.removeprefix("file:"), ignore_errors=True)
    return root


def stage_path(spark: SparkSession, label: str) -> str:
    """A path under the stage root that no other run uses."""
    path = f"{stage_root(spark)}/catalog_star/{label}-{uuid.uuid4().hex}"
    if scope := _scope.get():
        scope.paths.append(path)
    return path


def _let_go(spark: SparkSession, path: str) -> None:
    """Have Spark delete the shuffle files of queries that have ended, once a large stage is written.

    It does so when the driver's JVM has collected what refers to them, for which a heap with room may wait until disks are full.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength() >= LARGE:
        spark._jvm.System.gc()


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Readers of the result prune columns, push filters down, and see its true
    size, so joins against it are broadcast only when the files are small.
    """
    spark = df.sparkSession
    scope = _scope.get()
    if path is None and isinstance(scope, ResumableScope):
        path = scope.place(label)
        if scope.finished(path):
            scope.taken_up.append(label)
            return spark.read.schema(df.schema).parquet(path)
    target = path or stage_path(spark, label)
    df.write.mode("overwrite").parquet(target)
    _let_go(spark, target)
    return spark.read.schema(df.schema).parquet(target)
