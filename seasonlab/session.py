"""Session for tests and benchmarks, and the shared folder for written tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "seasonlab", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings a configured one."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="seasonlab-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used.

    The session owns what is written there: :func:`drop_written` removes it.
    """
    path = f"{shared_folder(spark)}/seasonlab/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(drop_written, spark)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_written: dict[str, list[str]] = {}
_derived: dict[tuple, str] = {}


def _version(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a stored table from another: its files, sizes and times."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)


PART_MB = 4  # of stored input, or of shuffled rows, for one task of a derived table
_SIZED = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


@contextmanager
def sized_shuffles(spark: SparkSession, stored: int) -> Iterator[None]:
    """Within it, shuffles have a task for every ``PART_MB`` of ``stored`` bytes of input, or
    more if so configured, and adaptive execution joins none to tasks beyond that size, so
    what one task sorts or hashes does not grow with the input. A session that sets no number
    of tasks has Spark's own."""
    before = {name: spark.conf.get(name, None) for name in _SIZED}  # None: not set
    tasks = max(int(spark.conf.get(_SIZED[0])), ceil(stored / (PART_MB * 2**20)))
    try:
        for name, value in zip(_SIZED, (str(tasks), f"{int(PART_MB * 1024)}k")):
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def derived_table(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """A table that queries share: written by the first that needs it, then read.

    It is built again when the files of an input have changed. Its shuffles have tasks in
    proportion to the inputs' size.
    """
    versions = [_version(spark, p) for p in inputs]
    key = (spark.sparkContext.applicationId, name, *versions)
    if key not in _derived:
        path = new_path(spark, name)
        with sized_shuffles(spark, sum(size for files in versions for _, size, _ in files)):
            build().write.parquet(path)
        _derived[key] = path
    return spark.read.parquet(_derived[key])


def drop_written(spark: SparkSession) -> None:
    """Remove all that this session has written below the shared folder: derived tables,
    and tables that cut a plan's lineage, which results still read. Called when Python
    ends, unless the session has been stopped before."""
    if spark.sparkContext._jsc is None:
        return
    app = spark.sparkContext.applicationId
    for path in _written.pop(app, []):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    for key in [k for k in _derived if k[0] == app]:
        del _derived[key]
