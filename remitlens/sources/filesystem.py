"""Small file-system steps of the driver, on whatever store a path names: listing, committing and removing."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; nothing if there is no such folder."""
    if not exists(spark, folder):
        return []
    return sorted(status.getPath().getName() for status in _files(spark, folder).listStatus(_path(spark, folder)))


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch of the last change."""
    return _files(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Moves a file or folder in one step; fails if the target exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    mode = getattr(hadoop, "Options$Rename").NONE
    modes = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    modes[0] = mode
    context = hadoop.FileContext.getFileContext(_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, source), _path(spark, target), modes)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def create(spark: SparkSession, path: str, content: bytes) -> bool:
    """Makes a file with its whole content visible in one step; False if the file is there already."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    files = _files(spark, path)
    stream = files.create(_path(spark, draft), False)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    try:
        rename(spark, draft, path)
    except Exception as error:  # noqa: BLE001 - anything but a lost race is raised again
        files.delete(_path(spark, draft), False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True
