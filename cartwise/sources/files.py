"""Small files and folders on whatever file system Spark uses, by its Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Lists, reads, removes, and creates files that must not exist yet."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def children(self, path: str) -> dict[str, float]:
        """Names below a folder and when each was last changed (seconds since 1970); none if it is absent."""
        if not self.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._fs(path).listStatus(self._path(path))}

    def size(self, paths: list[str]) -> int:
        """Bytes of these files together."""
        return sum(self._fs(p).getFileStatus(self._path(p)).getLen() for p in paths)

    def read(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Makes a file with this text, whole or not at all; False if there is one already.

        The text goes to a hidden neighbour, which is renamed without
        overwriting; readers never see a part of it.
        """
        import uuid

        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        stream = self._fs(path).create(self._path(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(path).getUri(), self._conf)
        plain = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(draft), self._path(path), plain)
        except Exception as e:  # noqa: BLE001 - only "exists" is an answer, the rest is raised
            if "FileAlreadyExists" not in str(e):
                raise
            self.remove(draft)
            return False
        return True

    def remove(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)
