"""Versions of a set of tables, made visible by one atomic pointer.

Writers put new folders next to the old ones; nothing a reader can see
changes until a pointer file of the next number appears. A pointer names the
folder of every table and carries a few facts about the commit. It is written
under a name of its own and renamed into place, which a file system does whole
or not at all; a number that is already taken means that another writer came
first, and the commit is refused. A run that dies before its pointer leaves
folders that no pointer names: they are invisible, and the next commit
removes them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.landing import _fs, path_exists

POINTERS = "_tidemark_pointer"
KEEP = 2  # commits whose folders stay for readers that are still at them


class ConcurrentCommit(RuntimeError):
    """Another writer published the same number."""


@dataclass(frozen=True)
class Version:
    number: int
    places: dict[str, str] = field(default_factory=dict)  # table -> folder below the root
    facts: dict = field(default_factory=dict)


def _pointer_numbers(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root.rstrip('/')}/{POINTERS}"
    if not path_exists(spark, folder):
        return []
    fs, p = _fs(spark, folder)
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_note(spark: SparkSession, path: str):
    """The content of a small JSON file, None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, content) -> None:
    """A small JSON file, written by the driver without a job."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()


def _read_pointer(spark: SparkSession, root: str, number: int) -> Version:
    held = read_note(spark, f"{root.rstrip('/')}/{POINTERS}/{number:012d}.json")
    return Version(number, held["places"], held["facts"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The version that readers see, None before the first."""
    numbers = _pointer_numbers(spark, root)
    return _read_pointer(spark, root, numbers[-1]) if numbers else None


def publish(spark: SparkSession, root: str, after: Version | None, places: dict[str, str], facts: dict) -> Version:
    """Make ``places`` the visible version, the one after ``after``."""
    root = root.rstrip("/")
    number = 1 if after is None else after.number + 1
    fs, to = _fs(spark, f"{root}/{POINTERS}/{number:012d}.json")
    name = f"{root}/{POINTERS}/draft-{uuid.uuid4().hex}"
    write_note(spark, name, {"places": places, "facts": facts})
    _, draft = _fs(spark, name)
    # rename does not replace on a distributed file system; a local one may, hence the look before
    if fs.exists(to) or not fs.rename(draft, to):
        fs.delete(draft, False)
        raise ConcurrentCommit(f"version {number} of {root} is already there")
    return Version(number, places, facts)


def path_of(root: str, version: Version, table: str) -> str:
    return f"{root.rstrip('/')}/{version.places[table]}"


def read(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame:
    """A table of the visible version (or of ``version``)."""
    version = version or current(spark, root)
    if version is None or table not in version.places:
        raise LookupError(f"no published table {table} under {root}")
    return spark.read.parquet(path_of(root, version, table))


def clean(spark: SparkSession, root: str, folders: str, keep: int = KEEP) -> int:
    """Remove what lies in ``root/folders`` that none of the last ``keep``
    versions names (older versions, runs that died) and the older pointers;
    returns how many folders went. Only for the writer, between commits."""
    root = root.rstrip("/")
    numbers = _pointer_numbers(spark, root)
    named = {p for n in numbers[-keep:] for p in _read_pointer(spark, root, n).places.values()}
    if path_exists(spark, f"{root}/{folders}"):
        gone = _remove_unnamed(spark, root, folders, named)
    else:
        gone = 0
    for n in numbers[:-keep]:
        fs, p = _fs(spark, f"{root}/{POINTERS}/{n:012d}.json")
        fs.delete(p, False)
    return gone


def _remove_unnamed(spark: SparkSession, root: str, folder: str, named: set[str]) -> int:
    """Below ``folder``, delete folders that neither are nor hold a named one."""
    fs, p = _fs(spark, f"{root}/{folder}")
    gone = 0
    for st in fs.listStatus(p):
        if not st.isDirectory():
            continue
        child = f"{folder}/{st.getPath().getName()}"
        if child in named:
            continue
        if any(n.startswith(child + "/") for n in named):
            gone += _remove_unnamed(spark, root, child, named)
        else:
            fs.delete(st.getPath(), True)
            gone += 1
    return gone
