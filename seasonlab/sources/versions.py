"""Stored tables that change in one step: written aside, checked, then named.

A table's folder holds versions (folders of Parquet files) and numbered manifests, small
JSON files that name the versions, and the partitions of them, that make up the table.
A write goes to a folder of its own. Only when its checks have passed is the next
manifest made, which readers take as the table from then on. So a write that is killed or
fails its checks leaves the table as it was, a table can be read and replaced by what is
computed from it, and readers never see half of a write. Of two writers that started from
one manifest, the second fails: a manifest's number is made once.

A manifest lists partitions, not rows; it grows with the number of partitions. An
unfinished manifest counts as none. Creating a file that must not exist has to be atomic
in the store (it is in HDFS and local folders).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

Check = tuple[str, Callable[[DataFrame], DataFrame]]  # name, and the rows that must not be


class CheckFailed(ValueError):
    """A check found rows; the table is as it was."""


class Conflict(RuntimeError):
    """Someone else has changed the table since this write began."""


class _Store:
    """A folder in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str = "") -> list[str]:
        at = self.at(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> dict | None:
        stream = self.fs.open(self.at(name))
        try:
            text = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None  # its writer was killed

    def create(self, name: str, content: dict) -> None:
        try:
            stream = self.fs.create(self.at(name), False)
        except Exception as error:  # whatever the file system calls it
            if self.fs.exists(self.at(name)):
                raise Conflict(f"{self.path}/{name} was made by another writer") from error
            raise
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _manifests(store: _Store) -> list[int]:
    return [int(n[1:-5]) for n in store.names() if n.startswith("m") and n.endswith(".json")]


def _name(number: int) -> str:
    return f"m{number:010d}.json"


def _current(store: _Store) -> tuple[int, dict | None]:
    """The last number used, and the last finished manifest."""
    numbers = sorted(_manifests(store), reverse=True)
    for n in numbers:
        told = store.read(_name(n))
        if told is not None:
            return numbers[0], told
    return (numbers[0] if numbers else 0), None


def _partitions(store: _Store, folder: str, depth: int) -> list[str]:
    """The partition folders of a version, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{n}".lstrip("/") for p in found for n in store.names(f"{folder}/{p}".rstrip("/")) if "=" in n]
    return found


def publish(df: DataFrame, path: str, checks: Sequence[Check] = (), partition_by: Sequence[str] = (), replace: str = "all", keep: int = 2) -> int:
    """Make ``df`` the table at ``path``, once all checks pass on what was written.

    ``replace="partitions"`` replaces the partitions that ``df`` has rows of and leaves the
    others; ``"none"`` adds to them. Returns the manifest's number. Versions that the
    last ``keep`` manifests do not name are removed.
    """
    if replace not in ("all", "partitions", "none"):
        raise ValueError(f"replace is all, partitions or none, not {replace}")
    if replace == "partitions" and not partition_by:
        raise ValueError("a table without partitions has none to replace")
    spark = df.sparkSession
    store = _Store(spark, path)
    last, before = _current(store)
    if before and replace != "all" and before["partition_by"] != list(partition_by):
        raise ValueError(f"the table is partitioned by {before['partition_by']}, not {list(partition_by)}")
    folder = f"v-{uuid.uuid4().hex}"
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(f"{store.path}/{folder}")
    told = {"schema": df.schema.jsonValue(), "partition_by": list(partition_by)}
    try:
        made = {"folder": folder, "partitions": _partitions(store, folder, len(partition_by)) if partition_by else None}
        written = _read(spark, store, {**told, "parts": [made]})
        for name, violations in checks:
            bad = violations(written).count()
            if bad:
                raise CheckFailed(f"{name}: {bad} rows")
        kept = [] if replace == "all" or before is None else before["parts"]
        if replace == "partitions":
            gone = set(made["partitions"])
            kept = [{**p, "partitions": [q for q in p["partitions"] if q not in gone]} for p in kept]
            kept = [p for p in kept if p["partitions"]]
        store.create(_name(last + 1), {**told, "number": last + 1, "parts": [*kept, made]})
    except Exception:
        store.delete(folder)
        raise
    _retire(store, keep)
    return last + 1


def _retire(store: _Store, keep: int) -> None:
    """Remove versions that only older manifests name, then those manifests."""
    numbers = sorted(_manifests(store), reverse=True)
    told = {n: store.read(_name(n)) for n in numbers}
    finished = [n for n in numbers if told[n] is not None]
    used = {p["folder"] for n in finished[:keep] for p in told[n]["parts"]}
    for n in finished[keep:]:
        for folder in {p["folder"] for p in told[n]["parts"]} - used:
            store.delete(folder)
        store.delete(_name(n))


def _read(spark: SparkSession, store: _Store, told: dict) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(told["schema"])
    frames = [spark.createDataFrame([], schema)]
    for part in told["parts"]:
        base = f"{store.path}/{part['folder']}"
        if part["partitions"] is None:
            frames.append(spark.read.schema(schema).parquet(base))
        elif part["partitions"]:
            frames.append(spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}" for p in part["partitions"]]))
    frames = frames[1:] or frames
    return reduce(DataFrame.unionByName, frames).select(*[f"`{c}`" for c in schema.names])


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as its last finished manifest names it."""
    store = _Store(spark, path)
    _, told = _current(store)
    if told is None:
        raise FileNotFoundError(f"no table has been published at {path}")
    return _read(spark, store, told)


def kept_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished manifests that are kept, in order."""
    store = _Store(spark, path)
    return [n for n in sorted(_manifests(store)) if store.read(_name(n)) is not None]


def read_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The table as an earlier manifest named it, while it is kept."""
    store = _Store(spark, path)
    told = store.read(_name(number)) if number in _manifests(store) else None
    if told is None:
        raise FileNotFoundError(f"version {number} of {path} is not kept")
    return _read(spark, store, told)
