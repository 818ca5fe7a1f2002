"""The few file-system calls that publishing a table needs, over Hadoop's FileSystem."""

from __future__ import annotations

from pyspark.sql import SparkSession


class SharedFs:
    """Path operations on whatever file system ``root`` belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        self._make_path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._make_path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._make_path(path))

    def is_dir(self, path: str) -> bool:
        p = self._make_path(path)
        return self._fs.exists(p) and self._fs.getFileStatus(p).isDirectory()

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._make_path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._make_path(path))]

    def sizes(self, path: str) -> list[int]:
        """Bytes of the files in a folder."""
        return [status.getLen() for status in self._fs.listStatus(self._make_path(path)) if status.isFile()]

    def delete(self, path: str) -> None:
        self._fs.delete(self._make_path(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename ``source`` to ``target``, which must not exist yet."""
        if self.exists(target):
            raise FileExistsError(target)
        self.mkdirs(target.rsplit("/", 1)[0])
        if not self._fs.rename(self._make_path(source), self._make_path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._make_path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._make_path(path), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
