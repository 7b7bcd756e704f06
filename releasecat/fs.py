"""Small file-system calls made by the driver, on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with its scheme; local files have three slashes."""
    file_system, hadoop_path = _resolve(spark, path)
    uri = file_system.makeQualified(hadoop_path).toString()
    return "file:///" + uri[5:].lstrip("/") if uri.startswith("file:") else uri


def rename(spark: SparkSession, source: str, target: str) -> None:
    file_system, source_path = _resolve(spark, source)
    if exists(spark, target):
        raise FileExistsError(target)
    if not file_system.rename(source_path, _resolve(spark, target)[1]):
        raise OSError(f"Cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def make_directory(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.mkdirs(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory."""
    file_system, hadoop_path = _resolve(spark, path)
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def partition_name(spark: SparkSession, column: str, value: str) -> str:
    """Directory that a partitioned write uses for a value, with special characters escaped by Spark itself."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    stream = file_system.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


# Schemes of file systems that rename over a file in one step.  Elsewhere a file appears whole when it is closed.
_RENAMING = ("file", "hdfs", "viewfs")


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a file in the place of another: readers see the old text or the new one."""
    file_system, hadoop_path = _resolve(spark, path)
    if file_system.getScheme() not in _RENAMING:
        write_text(spark, path, text)
        return
    written = f"{path}.__new"
    write_text(spark, written, text)
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(file_system.getUri(), spark._jsc.hadoopConfiguration())
    source, target = (file_system.makeQualified(_resolve(spark, p)[1]) for p in (written, path))
    context.rename(source, target, over)


def read_text(spark: SparkSession, path: str) -> str:
    file_system, hadoop_path = _resolve(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def length_and_time(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes of a file, or of all files in a folder, and when it was changed last."""
    file_system, hadoop_path = _resolve(spark, path)
    length = file_system.getContentSummary(hadoop_path).getLength()
    return length, file_system.getFileStatus(hadoop_path).getModificationTime()
