"""Names of a table's folders, and their removal, by the session's file systems."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Sorted names of the folders in ``path`` ([] if it is missing); ``complete``: only those of ended write jobs."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    child = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(f.getName() for f in found if not f.getName().startswith(("_", ".")) and (not complete or fs.exists(child(f, "_SUCCESS"))))


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def first_lines(spark: SparkSession, paths: list[str], most: int = 1000) -> dict[str, str] | None:
    """The first line of each file under ``paths`` (files, folders or patterns; empty files left out), read alone; None if there are over ``most``
    files, which are for a job, not for the driver."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    files = []
    for path in paths:
        fs, p = _at(spark, path)
        for status in fs.globStatus(p) or ():
            if status.isDirectory():
                files += [(fs, s.getPath()) for s in fs.listStatus(status.getPath()) if s.isFile()]
            else:
                files.append((fs, status.getPath()))
        if len(files) > most:
            return None
    out = {}
    for fs, p in files:
        if p.getName().startswith(("_", ".")):
            continue
        stream, codec = fs.open(p), codecs.getCodec(p)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
            line = reader.readLine()
        finally:
            stream.close()
        if line is not None:
            out[p.toString()] = line
    return out


def empty_files(spark: SparkSession, path: str, glob: str = "*") -> list[tuple[str, int]]:
    """(name, modification time in milliseconds) of the files of no bytes under ``path``, which Spark's scans leave out."""
    fs, p = _at(spark, path)
    out = []
    for root in fs.globStatus(p) or ():
        found = fs.listFiles(root.getPath(), True)
        while found.hasNext():
            f = found.next()
            name = f.getPath().getName()
            if f.getLen() == 0 and fnmatch(name, glob) and not name.startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getModificationTime()))
    return out
