"""Small Hadoop FileSystem helpers (driver side, metadata only).

They go through the session's Hadoop configuration, so the same calls work
on local disk, HDFS and object stores.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def qualify(spark: SparkSession, path: str) -> str:
    fs, hpath = _path(spark, path)
    return fs.makeQualified(hpath).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _path(spark, path)
    return bool(fs.exists(hpath))


def is_missing_or_empty_dir(spark: SparkSession, path: str) -> bool:
    fs, hpath = _path(spark, path)
    if not fs.exists(hpath):
        return True
    if not fs.getFileStatus(hpath).isDirectory():
        return False
    return len(fs.listStatus(hpath)) == 0


def size_of(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (one metadata call)."""
    fs, hpath = _path(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def delete(spark: SparkSession, path: str) -> bool:
    fs, hpath = _path(spark, path)
    return bool(fs.delete(hpath, True))


def mkdirs(spark: SparkSession, path: str) -> bool:
    fs, hpath = _path(spark, path)
    return bool(fs.mkdirs(hpath))


def same_store(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two paths are on one file system, so that one can be renamed to the other."""
    return _path(spark, a)[0].getUri().equals(_path(spark, b)[0].getUri())


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename within one file system (see ``same_store``)."""
    fs, hsrc = _path(spark, src)
    _, hdst = _path(spark, dst)
    parent = hdst.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(hsrc, hdst))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if it does not exist."""
    fs, hpath = _path(spark, path)
    if not fs.exists(hpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hpath)]


def first_folder(spark: SparkSession, path: str) -> str | None:
    """Name of some visible folder directly under ``path``; None if there is none."""
    fs, hpath = _path(spark, path)
    if not fs.exists(hpath):
        return None
    found = fs.listStatusIterator(hpath)
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if status.isDirectory() and not name.startswith(("_", ".")):
            return name
    return None


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small new file; False, and nothing written, if it exists already.

    Of several writers of one path exactly one gets True. On local disk the
    file is linked into place, so it appears whole. Elsewhere it is created
    without overwriting: atomic on HDFS, and on object stores that support
    conditional writes.
    """
    jvm = spark.sparkContext._jvm
    fs, hpath = _path(spark, path)
    fs.mkdirs(hpath.getParent())
    data = bytearray(text.encode())
    if fs.getUri().getScheme() == "file":
        import uuid

        files, target = jvm.java.nio.file.Files, jvm.java.io.File(hpath.toUri().getPath()).toPath()
        hidden = target.resolveSibling(f".{uuid.uuid4().hex}.part")
        files.write(hidden, data, spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
        try:
            files.createLink(target, hidden)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            files.delete(hidden)
        return True
    try:
        out = fs.create(hpath, False)
    except Exception as e:
        if "AlreadyExists" in str(e):
            return False
        raise
    out.write(data)
    out.close()
    return True
