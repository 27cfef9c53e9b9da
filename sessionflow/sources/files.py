"""Paths and file moves through the Hadoop file system API, so any storage Spark reads works.

The only module that uses the driver's JVM directly, which a Spark Connect session does not offer.
"""

from __future__ import annotations

import heapq
import re
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession

MOVES_AT_ONCE = 16
#: Waiting files that are remembered from one listing of their folder.
LISTED = 20_000

#: The folder that intermediate tables are made in, while ``work_scope`` holds.
_scope: ContextVar[str | None] = ContextVar("work scope", default=None)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    return _file_system(spark, target).exists(target)


@cache
def _local_work_dir() -> str:
    return tempfile.mkdtemp(prefix="sessionflow-")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session (tests) may do without: it takes a temporary folder. Executors of a
    cluster do not see each other's local folders, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_work_dir()


def new_work_path(spark: SparkSession, name: str) -> str:
    return f"{_scope.get() or work_dir(spark)}/sessionflow-{name}-{uuid.uuid4().hex}"


@contextmanager
def work_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for all intermediate tables made meanwhile, which is removed at the end."""
    path = new_work_path(spark, name)
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table made by ``new_work_path``."""
    if "/sessionflow-" not in path:
        raise ValueError(f"not an intermediate table: {path}")
    target = _path(spark, path)
    _file_system(spark, target).delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, or None where there is none."""
    if not path_exists(spark, path):
        return None
    target = _path(spark, path)
    stream = _file_system(spark, target).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name first, so that it is there as a whole or not at all."""
    own, target = _path(spark, f"{path}.{uuid.uuid4().hex}"), _path(spark, path)
    fs = _file_system(spark, target)
    stream = fs.create(own, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(own, target):
        raise OSError(f"could not write {path}")


def remove_file(spark: SparkSession, path: str) -> None:
    target = _path(spark, path)
    _file_system(spark, target).delete(target, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = _path(spark, path)
    _file_system(spark, target).delete(target, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it is absent."""
    if not path_exists(spark, path):
        return []
    target = _path(spark, path)
    found = _file_system(spark, target).listStatus(target)
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target is absent, its parents are made."""
    old, new = _path(spark, source), _path(spark, target)
    fs = _file_system(spark, new)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def replace_folder(spark: SparkSession, source: str, target: str, old: str) -> None:
    """Put the folder ``source`` in the place of ``target``, which goes to ``old``.

    Two renames, and whatever the first try has done, a second one does the rest: as long as
    ``source`` is there, the target is what it was or is gone to ``old``.
    """
    if not path_exists(spark, source):
        return
    if path_exists(spark, target):
        move_folder(spark, target, old)
    move_folder(spark, source, target)


def at_once(action, items: list) -> list:
    """``action`` on every item, several at a time."""
    with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
        return list(pool.map(action, items))


def _listed(spark: SparkSession, folder: str) -> Iterator[tuple[int, str]]:
    """(modification time, path) of the Parquet files below a folder, one after the other."""
    root = _path(spark, folder)
    fs = _file_system(spark, root)
    root = fs.makeQualified(root)
    found, above = fs.listFiles(root, True), len(root.toUri().getPath().rstrip("/")) + 1
    while found.hasNext():
        status = found.next()
        path = status.getPath()
        below = path.toUri().getPath()[above:].split("/")
        if below[-1].endswith(".parquet") and not any(n.startswith(("_", ".")) for n in below):
            yield status.getModificationTime(), path.toString()


def waiting_files(
    spark: SparkSession, folder: str, size: int, listed: int = LISTED
) -> Iterator[list[str]]:
    """The Parquet files that wait in a folder, in order of time, ``size`` at a time.

    The driver remembers the first ``listed`` of them and lists the folder again for more, so a
    backlog of any length takes the same memory. Files that come after the start wait on.
    """
    if not path_exists(spark, folder):
        return
    done, last = (-1, ""), None
    while last is None or done < last:
        newest = (-1, "")

        def open_files() -> Iterator[tuple[int, str]]:
            nonlocal newest
            for file in _listed(spark, folder):
                if done < file and (last is None or file <= last):
                    newest = max(newest, file)
                    yield file

        found = heapq.nsmallest(max(size, listed // size * size), open_files())
        if not found:
            return
        last = newest if last is None else last
        for begin in range(0, len(found), size):
            yield [path for _, path in found[begin : begin + size]]
        done = found[-1]


def archive_files(spark: SparkSession, files: list[str], archive_dir: str) -> int:
    """Move consumed files away, several at a time; also to another file system.

    ``files`` are paths, not URIs. A file that is gone already was moved by an earlier try. A file
    of the name of an archived one gets a name of its own.
    """
    folder = _path(spark, archive_dir)
    _file_system(spark, folder).mkdirs(folder)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    hadoop = spark._jvm.org.apache.hadoop.fs

    def move(name: str) -> int:
        source = hadoop.Path(name)
        fs = source.getFileSystem(conf)
        if not fs.exists(source):
            return 0
        target = hadoop.Path(folder, source.getName())
        there = target.getFileSystem(conf)
        if there.exists(target):
            stem, dot, ending = source.getName().rpartition(".")
            target = hadoop.Path(folder, f"{stem or ending}-{uuid.uuid4().hex}{dot}{ending if stem else ''}")
        if fs.getUri().equals(there.getUri()):
            moved = fs.rename(source, target)
        else:
            moved = hadoop.FileUtil.copy(fs, source, there, target, True, conf)
        if not moved:
            raise OSError(f"could not move {name} to {archive_dir}")
        return 1

    return sum(at_once(move, files))
