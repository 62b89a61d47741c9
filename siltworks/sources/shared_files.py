"""Small files on any file system that Spark reaches: listing, reading, and creation in one step."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# File systems without a rename that refuses to replace, but on which a file appears when it is
# closed, whole or not at all.
_APPEARS_ON_CLOSE = ("s3a", "s3", "gs", "abfs", "abfss")


def _place(spark: SparkSession, path: str) -> tuple:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def _raised(error: Py4JJavaError, *names: str) -> bool:
    return any(n in error.java_exception.getClass().getName() for n in names)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _place(spark, path)
    return files.exists(target)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if there is no such folder."""
    files, target = _place(spark, folder)
    hadoop, lang = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jvm.org.apache.commons.lang3
    try:
        listed = hadoop.FileUtil.stat2Paths(files.listStatus(target))
    except Py4JJavaError as error:
        if _raised(error, "FileNotFound"):
            return []
        raise
    # All paths in one call: {folder/name,folder/name}
    before = files.makeQualified(target).toString().rstrip("/") + "/"
    return sorted(part.rstrip(",") for part in lang.ArrayUtils.toString(listed)[1:-1].split(before)[1:])


def read_text(spark: SparkSession, path: str) -> str | None:
    """All of a small file; None if there is none."""
    files, target = _place(spark, path)
    try:
        opened = files.open(target)
    except Py4JJavaError as error:
        if _raised(error, "FileNotFound"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def first_text(spark: SparkSession, uri: str, length: int) -> str:
    """The first bytes of a file, uncompressed if its name tells how, one character each."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(uri))
    opened = target.getFileSystem(configuration).open(target)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(configuration).getCodec(target)
    opened = codec.createInputStream(opened) if codec else opened
    try:
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(opened, length)
        return jvm.org.apache.commons.io.IOUtils.toString(bounded, "ISO-8859-1")
    finally:
        opened.close()


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed, in microseconds."""
    files, target = _place(spark, path)
    return files.getFileStatus(target).getModificationTime() * 1000


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        files, target = _place(spark, path)
        files.delete(target, True)


def _write(files, target, text: str) -> None:
    out = files.create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` to a new file; False, and no change, if the file exists.

    The file appears whole or not at all, whenever its writer dies: it is written under another name
    and then renamed by a call that refuses to replace (on a local file system, linked).  Object
    stores show a file once it is closed; there, only one writer wins where the connector is set to
    conditional writes.
    """
    files, target = _place(spark, path)
    scheme = files.getUri().getScheme()
    try:
        if scheme in _APPEARS_ON_CLOSE:
            _write(files, target, text)
            return True
        jvm = spark.sparkContext._jvm
        # Readers pass over names with a point in front.
        draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
        _write(files, draft, text)
        try:
            _rename_once(spark, files, draft, target, scheme)
        finally:
            files.delete(draft, False)
    except Py4JJavaError as error:
        if _raised(error, "FileAlreadyExists"):
            return False
        raise
    return True


def _rename_once(spark: SparkSession, files, draft, target, scheme: str) -> None:
    context = spark.sparkContext
    jvm = context._jvm
    if scheme == "file":
        # Local renames replace; a link to an existing name is refused by the system.
        local = [jvm.java.nio.file.Paths.get(files.makeQualified(p).toUri()) for p in (target, draft)]
        jvm.java.nio.file.Files.createLink(*local)
        return
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    refusing = context._gateway.new_array(rename, 1)
    refusing[0] = rename.NONE
    configuration = context._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), configuration).rename(draft, target, refusing)
