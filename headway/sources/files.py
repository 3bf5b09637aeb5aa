"""Small-file and folder calls on whatever file system a path names.

Goes through Hadoop's FileSystem, so one code path serves local disks, HDFS and
object stores. Only markers and pointers pass through here, never table data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


#: Of written tables: row digests are hex text, which the default codec cannot shorten.
COMPRESSION = "zstd"
#: Shuffle files are removed at the end of the statement that wrote them, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What the statements in here shuffle goes with each of them; only for frames that are run once."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._gateway = spark.sparkContext._gateway
        self._hadoop = spark._jvm.org.apache.hadoop
        self._path = self._hadoop.fs.Path
        self.root = root.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Visible children of a folder, sorted; empty if it does not exist."""
        if not self.exists(name):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at(name))]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def _fill(self, path, text: str) -> None:
        stream = self._fs.create(path, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a small new file; of several writers of one name exactly one succeeds."""
        try:
            self._fill(self._at(name), text)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise FileExistsError(f"{self.root}/{name}") from e
            raise

    def write(self, name: str, text: str) -> None:
        """Write a whole small file in place of an earlier one: readers find either, never none."""
        draft = self._at(f"{name.rpartition('/')[0]}/_{uuid.uuid4().hex}".lstrip("/"))
        self._fill(draft, text)
        kind = getattr(self._hadoop.fs, "Options$Rename")
        over = self._gateway.new_array(kind, 1)
        over[0] = kind.OVERWRITE
        context = self._hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._at(name)), over)

    def remove_at_exit(self) -> None:
        """Make the folder; it goes when the session's process ends."""
        self._fs.mkdirs(self._at(""))
        self._fs.deleteOnExit(self._at(""))

    def size(self, name: str = "") -> int:
        """Bytes of a file, or of all files below a folder."""
        return self._fs.getContentSummary(self._at(name)).getLength()

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor reaches: ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging").rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new shared folder, removed at the latest when the session's process ends."""
    folder = f"{shared_folder(spark)}/headway-{label}-{uuid.uuid4().hex}"
    Files(spark, folder).remove_at_exit()
    return folder


class Staging:
    """Written intermediate tables of one job, removed when the job is done.

    Staging cuts lineage with files in the shared folder: a lost executor is
    replaced by reading them again, not by recomputing the job.
    """

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self.folder = fresh_folder(spark, label)
        self._count = 0

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_exc) -> None:
        Files(self._spark, self.folder).remove()

    def keep(self, rows: DataFrame, name: str | None = None) -> DataFrame:
        return self.keep_each([rows], name)[0]

    def keep_each(self, parts: Iterable[DataFrame], name: str | None = None) -> tuple[DataFrame, list[DataFrame]]:
        """Frames of one schema, written one after the other: all their rows, and those of each."""
        self._count += 1
        top = f"{self.folder}/{name or self._count}"
        schema, paths = None, []
        for rows in parts:
            schema = schema or rows.schema
            paths.append(f"{top}/{len(paths)}")
            with shuffles_removed(self._spark):
                rows.write.option("compression", COMPRESSION).parquet(paths[-1])
        read = self._spark.read.schema(schema)
        return read.parquet(*paths), [read.parquet(p) for p in paths]

    def remove(self, name: str) -> None:
        """Remove what was kept under ``name``, once nothing reads it any more."""
        Files(self._spark, self.folder).remove(name)


def written_bytes(rows: DataFrame) -> int:
    """Bytes of a written table's files, by Spark's own estimate."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
