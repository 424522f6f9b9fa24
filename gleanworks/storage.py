"""The folder that driver and executors share, and files through Hadoop's file systems."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset a folder of this machine, on a local master only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="gleanworks-")
    return _OWN[context.applicationId]


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let ``checkpoint()`` write to the shared folder, unless the session names another."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def fresh(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/gleanworks/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(file system of ``path``, Hadoop's class of paths)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = file_system(spark, path)
    return fs.exists(hadoop(path))


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; false if there was none."""
    fs, hadoop = file_system(spark, path)
    return fs.delete(hadoop(path), True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = file_system(spark, path)
    stream = fs.open(hadoop(path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    fs, hadoop = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop(path))) if fs.exists(hadoop(path)) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder."""
    fs, hadoop = file_system(spark, path)
    return fs.getContentSummary(hadoop(path)).getLength()


def move(spark: SparkSession, source: str, target: str, overwrite: bool = True) -> bool:
    """Rename in one step; false if ``target`` is there and may not be replaced.

    On a local file system, which only a local master writes to, Hadoop's rename deletes the target
    first, so a file is replaced there by the system's own call; its checksum goes before and comes after.
    """
    fs, hadoop = file_system(spark, target)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    if fs.getScheme() == "file" and overwrite and not fs.getFileStatus(hadoop(source)).isDirectory():
        here, there = (fs.makeQualified(hadoop(p)).toUri().getPath() for p in (source, target))
        crc = lambda p: f"{os.path.dirname(p)}/.{os.path.basename(p)}.crc"
        if os.path.exists(crc(there)):
            os.remove(crc(there))
        os.replace(here, there)
        if os.path.exists(crc(here)):
            os.replace(crc(here), crc(there))
        return True
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, int(overwrite))
    if overwrite:
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(hadoop(source), hadoop(target), options)
    except Exception as why:
        if not overwrite and "FileAlreadyExistsException" in str(why):
            return False
        raise
    return True


def join_files(spark: SparkSession, parts: list[str], target: str) -> None:
    """One file of ``parts``, in their order; it appears under its name, replacing what was there, in one step.

    Parts are joined by the file system where it can (no bytes move then), else copied from stream to
    stream in the JVM, a buffer at a time. The parts may be gone afterwards.
    """
    fs, hadoop = file_system(spark, target)
    jvm, whole = spark.sparkContext._jvm, f"{target}.whole-{uuid.uuid4().hex}"
    fs.create(hadoop(whole), True).close()
    sizes = [fs.getFileStatus(hadoop(p)).getLen() for p in parts]
    held = [p for p, n in zip(parts, sizes, strict=True) if n]
    try:
        if fs.getScheme() != "hdfs":
            raise NotImplementedError
        for k in range(0, len(held), 500):
            some = spark.sparkContext._gateway.new_array(hadoop, len(held[k : k + 500]))
            for i, p in enumerate(held[k : k + 500]):
                some[i] = hadoop(p)
            fs.concat(hadoop(whole), some)
    except NotImplementedError:
        out = fs.create(hadoop(whole), True)
        try:
            for p in held:
                stream = fs.open(hadoop(p))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()
    move(spark, whole, target)


def write_text(spark: SparkSession, path: str, pieces, overwrite: bool = True) -> bool:
    """Write strings one after another; the file appears under its name once it is whole. False if it is there and may not be replaced."""
    fs, hadoop = file_system(spark, path)
    part = f"{path}.part-{uuid.uuid4().hex}"
    stream = fs.create(hadoop(part), True)
    held, size = [], 0
    try:
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size >= 1 << 18:
                stream.write(bytearray("".join(held).encode()))
                held, size = [], 0
        stream.write(bytearray("".join(held).encode()))
    finally:
        stream.close()
    done = move(spark, part, path, overwrite)
    if not done:
        remove(spark, part)
    return done
