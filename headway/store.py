"""File operations through the Hadoop FileSystem the session is set up for.

Works alike on local disk, HDFS and object stores, unlike ``os.path``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """Folder-level operations below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        hadoop_conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(hadoop_conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def child_dirs(self, path: str) -> list[str]:
        """Names of the folders directly below ``path``, sorted."""
        if not self.exists(path):
            return []
        entries = self._fs.listStatus(self._path(path))
        return sorted(
            e.getPath().getName() for e in entries if e.isDirectory()
        )

    def size(self, path: str) -> tuple[int, int]:
        """(bytes, files) below a folder; marker files count as nothing."""
        summary = self._fs.getContentSummary(self._path(path))
        return summary.getLength(), summary.getFileCount()

    def make_dir(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def delete_at_end(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))

    def rename(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()


def partition_dir(spark: SparkSession, name: str, value: str) -> str:
    """``name=value`` with the escaping Spark itself uses for folders."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{name}={utils.escapePathName(value)}"
