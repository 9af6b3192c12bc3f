"""Files moved by the driver: names only, never content."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, name: str):
    """``(file system, path)`` for a name as Spark prints it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, making the folder it goes to; raises if that fails."""
    fs, path = hadoop_path(spark, source)
    _, to = hadoop_path(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(path, to):
        raise OSError(f"could not move {source} to {target}")


def exists(spark: SparkSession, name: str) -> bool:
    fs, path = hadoop_path(spark, name)
    return fs.exists(path)


#: Renames under way at a time.
_MOVES = 16


def place_parts(spark: SparkSession, staged: str, target: str) -> None:
    """Give the parts in ``staged/stream=<s>/name=<n>`` the names ``target/<s>/<n>``.

    Every folder must hold one part.  One rename for each, no content is moved.
    """
    fs, pattern = hadoop_path(spark, f"{staged}/stream=*/name=*/part-*")
    # Looked up once: a name in the JVM costs several calls.
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    sources = [status.getPath().toString() for status in fs.globStatus(pattern)]
    goals = [[part.split("=", 1)[1] for part in source.split("/")[-3:-1]] for source in sources]
    for stream in {stream for stream, _ in goals}:
        fs.mkdirs(path_of(f"{target}/{stream}"))

    def place(source: str, goal: list[str]) -> None:
        to = "/".join([target, *goal])
        if not fs.rename(path_of(source), path_of(to)):
            raise OSError(f"could not move {source} to {to}")

    with ThreadPoolExecutor(_MOVES) as pool:
        list(pool.map(place, sources, goals))
