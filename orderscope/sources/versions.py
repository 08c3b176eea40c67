"""Versions of a set of tables, published together.

A writer puts all tables of a version into a folder of its own
(``<base>/v-<id>/…``, through Spark's commit protocol) and then publishes it
with one rename: a small manifest, written aside, becomes
``<base>/manifest-<number>.json``. Readers take the manifest with the highest
number and read the folder it names, so they see all tables of the old version
or all of the new one, never some of each, and a writer that dies before its
rename leaves nothing that a reader can see.

The rename does not replace: of two writers that prepared the same number, one
fails with :class:`Conflict` and starts over from the version that won. Old
versions stay readable (a reader may hold one) until :func:`prune`.

A manifest is a few hundred bytes and goes through the driver; tables never do.
The file system must rename files at once (HDFS and local disks do).
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

MANIFEST = "manifest-{:012d}.json"
_NUMBER = re.compile(r"manifest-([0-9]{12})\.json$")


class Conflict(RuntimeError):
    """Another writer published this number first."""


@dataclass(frozen=True)
class Version:
    """A published version: its number, the folder of its tables, and what its writer noted."""

    number: int
    path: str
    notes: dict = field(default_factory=dict)


def _hadoop(spark: SparkSession, base: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = fs.Path(base)
    return fs, conf, folder, folder.getFileSystem(conf)


def _numbers(spark: SparkSession, base: str) -> list[int]:
    _, _, folder, system = _hadoop(spark, base)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(m.group(1)) for m in map(_NUMBER.match, names) if m)


def _read(spark: SparkSession, base: str, number: int) -> Version:
    fs, _, _, system = _hadoop(spark, base)
    path = fs.Path(base, MANIFEST.format(number))
    stream = system.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    found = json.loads(text)
    return Version(number, f"{base.rstrip('/')}/{found['folder']}", found["notes"])


def current(spark: SparkSession, base: str) -> Version | None:
    """The newest published version; None where there is none."""
    numbers = _numbers(spark, base)
    return _read(spark, base, numbers[-1]) if numbers else None


def new_folder(base: str) -> str:
    """A folder name for the tables of a version that is not published yet."""
    return f"v-{uuid.uuid4().hex}"


def publish(spark: SparkSession, base: str, folder: str, after: Version | None, notes: dict | None = None) -> Version:
    """Make ``<base>/<folder>`` the version that follows ``after``; :class:`Conflict` if that number is taken."""
    fs, conf, base_path, system = _hadoop(spark, base)
    number = after.number + 1 if after else 1
    system.mkdirs(base_path)
    aside, final = fs.Path(base, f"_aside-{uuid.uuid4().hex}"), fs.Path(base, MANIFEST.format(number))
    stream = system.create(aside, False)
    try:
        stream.write(json.dumps({"folder": folder, "notes": notes or {}}).encode())
    finally:
        stream.close()
    if system.exists(final):
        system.delete(aside, False)
        raise Conflict(f"version {number} of {base} exists")
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        # without OVERWRITE this fails where the manifest exists, also if it appeared since
        fs.FileContext.getFileContext(base_path.toUri(), conf).rename(aside, final, none)
    except Exception as exc:
        if "FileAlreadyExists" not in str(exc):
            raise
        system.delete(aside, False)
        raise Conflict(f"version {number} of {base} exists") from None
    return Version(number, f"{base.rstrip('/')}/{folder}", notes or {})


def prune(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, manifest first; the numbers removed."""
    if keep < 1:
        raise ValueError("keep must be >= 1")
    fs, _, _, system = _hadoop(spark, base)
    old = _numbers(spark, base)[:-keep]
    for number in old:
        version = _read(spark, base, number)
        system.delete(fs.Path(base, MANIFEST.format(number)), False)
        system.delete(fs.Path(version.path), True)
    return old
