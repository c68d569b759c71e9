"""Tables that are published together: written beside the present ones, audited, then switched to.

A release is a folder of Parquet tables. Readers follow a pointer, one small file that names the present
release, so they see all tables of one release or all of another. Nothing of a release is ever
changed after the switch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "present"


class Folder:
    """A folder of any file system Spark reaches, with small files in it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")

    def path(self, name: str = "") -> str:
        return f"{self.root}/{name}" if name else self.root

    def _at(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, name: str = "") -> bool:
        files, at = self._at(name)
        return files.exists(at)

    def names(self, name: str = "") -> list[str]:
        """What is in the folder, in order of name."""
        files, at = self._at(name)
        return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []

    def write(self, name: str, text: str) -> None:
        files, at = self._at(name)
        out = files.create(at, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        files, at = self._at(name)
        stream = files.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Writes a file under another name and renames it over the old one, in one step."""
        draft = f".{name}-{uuid.uuid4().hex}"
        self.write(draft, text)
        fs = self.spark._jvm.org.apache.hadoop.fs
        files, start = self._at(draft)
        _, end = self._at(name)
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        options[0] = fs.Options.Rename.OVERWRITE
        fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration()).rename(
            start, end, options
        )

    def remove(self, name: str) -> None:
        files, at = self._at(name)
        files.delete(at, True)


class Releases:
    """The releases below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def present(self) -> str | None:
        """The release readers see, None before the first."""
        return self.folder.read(POINTER) if self.folder.exists(POINTER) else None

    def all(self) -> list[str]:
        return [n for n in self.folder.names() if n.startswith("release-")]

    def begin(self) -> str:
        """A name for a new release, after those there are; two that begin at once differ."""
        number = max((int(n.split("-")[1]) for n in self.all()), default=0) + 1
        return f"release-{number:08d}-{uuid.uuid4().hex[:8]}"

    def write(self, release: str, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Writes a table of a release that is not published, and returns a scan of it."""
        path = self.folder.path(f"{release}/{name}")
        writer = df if partition_by is None else df.hint("rebalance", partition_by)
        writer = writer.write.mode("overwrite")
        (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(path)
        return self._scan(release, name, df)

    def _scan(self, release: str, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read if like is None else self.spark.read.schema(like.schema)
        return reader.parquet(self.folder.path(f"{release}/{name}"))

    def publish(self, release: str) -> None:
        """The switch: from now on readers see all tables of this release."""
        self.folder.replace(POINTER, release)

    def tables(self, release: str | None = None) -> dict[str, DataFrame]:
        """The tables of a release, of the present one if none is named."""
        release = release or self.present()
        if release is None:
            raise LookupError("nothing is published yet")
        names = [n for n in self.folder.names(release) if not n.startswith((".", "_"))]
        return {name: self._scan(release, name) for name in names}

    def register_views(self) -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    def sweep(self, keep: int = 2) -> list[str]:
        """Removes releases older than the ``keep`` newest; the present one and drafts after it stay."""
        present = self.present()
        old = [n for n in self.all() if present is not None and n < present]
        gone = old[: max(0, len(old) + 1 - keep)]
        for release in gone:
            self.folder.remove(release)
        return gone
