"""Paths on whatever file system they name: local, HDFS or an object store."""

from __future__ import annotations

import os
import re
from enum import Enum

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

PathLike = str | os.PathLike


# Fixed value: the folder Spark's writers keep unfinished files in.
WRITE_IN_PROGRESS = "_temporary"


class PathState(Enum):
    """What a target path holds before a write."""

    ABSENT = "absent"
    UNFINISHED = "unfinished"
    TABLE = "table"
    FOREIGN = "foreign"


def child(root: PathLike, *parts: str) -> str:
    """Join with slashes, leaving URI schemes such as ``s3a://`` intact."""
    return "/".join([os.fspath(root).rstrip("/"), *parts])


def _resolve(spark: SparkSession, path: PathLike) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(os.fspath(path))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: PathLike) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: PathLike) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def delete_empty(spark: SparkSession, path: PathLike) -> None:
    """Remove a folder unless something is in it by now."""
    fs, hadoop_path = _resolve(spark, path)
    try:
        fs.delete(hadoop_path, False)
    except Py4JJavaError:
        pass


def create_exclusively(spark: SparkSession, path: PathLike, content: str) -> bool:
    """Write a small file unless one exists; tells whether this call made it. Atomic where the
    file system creates files exclusively, as HDFS and local ones do."""
    fs, hadoop_path = _resolve(spark, path)
    try:
        stream = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            return False
        raise error
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    return True


def read_text(spark: SparkSession, path: PathLike) -> str:
    """Content of a small file."""
    fs, hadoop_path = _resolve(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def touch(spark: SparkSession, path: PathLike, millis: int) -> None:
    """Set a file's modification time."""
    fs, hadoop_path = _resolve(spark, path)
    fs.setTimes(hadoop_path, millis, -1)


def entries(spark: SparkSession, path: PathLike) -> list[tuple[str, int]]:
    """Names and modification times (milliseconds) in a folder; empty if there is none."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    listed = fs.listStatus(hadoop_path)
    return sorted((e.getPath().getName(), e.getModificationTime()) for e in listed)


def size_bytes(spark: SparkSession, path: PathLike) -> int:
    """Bytes below a path; 0 when it does not exist."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def qualified(spark: SparkSession, path: PathLike) -> str:
    """Absolute form of a path, with its scheme."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def path_state(spark: SparkSession, path: PathLike, fmt: str) -> PathState:
    """Tell a table of the format from other content, without opening any data file.

    A Delta table is a folder with a transaction log. For plain file formats every visible
    entry must be a file of the format. A folder that holds nothing but the marks of a first
    write that did not come to its end is unfinished: that write can be repeated.
    """
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return PathState.ABSENT
    if fmt == "delta":
        is_table = exists(spark, child(path, "_delta_log"))
        return PathState.TABLE if is_table else PathState.FOREIGN
    if not fs.getFileStatus(hadoop_path).isDirectory():
        return PathState.FOREIGN
    entries = fs.listStatusIterator(hadoop_path)
    files, begun = False, False
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().getName()
        begun |= name == WRITE_IN_PROGRESS
        if name.startswith(("_", ".")):
            continue
        if not (entry.isFile() and name.endswith(f".{fmt}")):
            return PathState.FOREIGN
        files = True
    if files:
        return PathState.TABLE
    return PathState.UNFINISHED if begun else PathState.FOREIGN


def literal_name(name: str) -> str:
    """A name for one folder: characters that separate or match are written as codes."""
    return re.sub(r"[^A-Za-z0-9_.=-]|^[_.]", lambda m: f"%{ord(m[0]):02X}", name)


def literal(path: PathLike) -> str:
    """A path that readers take as it stands and not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", os.fspath(path))


def data_files(spark: SparkSession, path: PathLike) -> list[tuple[str, int]]:
    """Paths and sizes of the visible files a path or a pattern names, those of folders at
    any depth included. Empty when there is nothing."""
    fs, hadoop_path = _resolve(spark, path)
    named = [fs.getFileStatus(hadoop_path)] if fs.exists(hadoop_path) else fs.globStatus(hadoop_path)
    found: list[tuple[str, int]] = []
    waiting = list(named or [])
    while waiting:
        entry = waiting.pop()
        if entry.isDirectory():
            inside = fs.listStatus(entry.getPath())
            waiting += [e for e in inside if not e.getPath().getName().startswith(("_", "."))]
        else:
            found.append((entry.getPath().toString(), entry.getLen()))
    return sorted(found)
