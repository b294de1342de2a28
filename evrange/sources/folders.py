"""Folders on whatever file system a path names, through Spark's own file system classes."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list:
    """Names of what lies directly in a folder."""
    files, place = _at(spark, path)
    return sorted(found.getPath().getName() for found in files.listStatus(place))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    files, place = _at(spark, path)
    files.create(place).close()


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def scheme(spark: SparkSession, path: str) -> str:
    files, _ = _at(spark, path)
    return files.getUri().getScheme()
