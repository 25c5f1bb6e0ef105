"""Path questions answered by the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _file_system(spark, path)
    return bool(fs.exists(where))


def child_names(spark: SparkSession, path: str) -> list[str]:
    where, fs = _file_system(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def delete_path(spark: SparkSession, path: str) -> None:
    where, fs = _file_system(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    where, fs = _file_system(spark, path)
    fs.mkdirs(where)


def claim_file(spark: SparkSession, path: str, owner: str) -> bool:
    """Create ``path`` with ``owner`` in it, or find it there with the same one that is not empty.

    Creation without overwriting is atomic on HDFS and local disks, so of two writers one gets it.
    """
    where, fs = _file_system(spark, path)
    try:
        out = fs.create(where, False)
    except Exception:
        if not fs.exists(where):
            raise
        return bool(owner) and read_text(spark, path) == owner
    out.write(bytearray(owner.encode()))
    out.close()
    return True


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file with ``text``; without ``overwrite`` an existing one is an error."""
    where, fs = _file_system(spark, path)
    out = fs.create(where, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    where, fs = _file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
