"""Tables that are replaced as one step: data in folders of their own, and a log that says which hold.

A store is a folder. data/ has what writers wrote, each in a new folder; log/<number> is a small file that names the folder of
every table of one version. A writer that wants to be next puts its file to the next number by a rename that fails if the place
is taken: of two, one wins, and the other is told. Readers take the version with the highest number, and see it whole, before,
while and after others write. A writer that dies leaves data that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class ConflictError(RuntimeError):
    """Another writer made the version that this one was to be."""


class VersionedTables:
    """Named tables at a path, changed together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p}")
        self._files = self._at("log").getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the version that holds; 0 before the first."""
        at = self._at("log")
        return max((int(s.getPath().getName()) for s in self._files.listStatus(at)), default=0) if self._files.exists(at) else 0

    def folders(self, version: int | None = None) -> dict[str, str]:
        """Folder by table of a version, the one that holds by default."""
        number = self.version() if version is None else version
        if not number:
            return {}
        file = self._files.open(self._at(f"log/{number:012d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as it is in a version; raises KeyError if that lacks it."""
        return self.spark.read.parquet(f"{self.path}/data/{self.folders(version)[table]}")

    def _claim(self, number: int, folders: Mapping[str, str]) -> None:
        jvm = self.spark._jvm
        staged, place = self._at(f"staging/{uuid.uuid4().hex}"), self._at(f"log/{number:012d}")
        self._files.mkdirs(place.getParent())
        out = self._files.create(staged, False)
        out.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
        out.close()
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._files.makeQualified(staged), self._files.makeQualified(place), no_options)  # without leave to overwrite
        except Py4JJavaError as error:
            self._files.delete(staged, False)
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            raise ConflictError(f"version {number} of {self.path} is another's") from error

    def replace(self, tables: Mapping[str, DataFrame], base: int | None = None) -> int:
        """Replace these tables whole, all at once; others stay as they are. The new version's number.

        base: the version that the frames were made from, by default the one that holds now. Raises ConflictError if another
        version has come since.
        """
        base = self.version() if base is None else base
        folders = self.folders(base)
        for name, frame in tables.items():
            folders[name] = f"{name}-{uuid.uuid4().hex}"
            frame.write.parquet(f"{self.path}/data/{folders[name]}")
        self._claim(base + 1, folders)
        return base + 1

    def change(self, table: str, how: Callable[[DataFrame], DataFrame], tries: int = 5) -> int:
        """Replace a table by what `how` makes of it, again from the newest version where another writer was first."""
        for k in range(tries):
            base = self.version()
            try:
                return self.replace({table: how(self.read(table, base))}, base)
            except ConflictError:
                if k == tries - 1:
                    raise
        raise AssertionError

    def upsert(self, table: str, rows: DataFrame, key: Sequence[str]) -> int:
        """Rows in place of those with their keys, the others kept."""
        return self.change(table, lambda old: old.join(rows.select(*key).distinct(), list(key), "left_anti").select(*old.columns).unionByName(rows))

    def publish(self, rows: DataFrame, parts: Mapping[str, str | None]) -> int:
        """Several tables of one frame (name -> predicate, None for all rows), all in one version."""
        return self.replace({name: rows.where(p) if p else rows for name, p in parts.items()})

    def remove_old(self, keep: int = 2) -> int:
        """Delete data that none of the last `keep` versions names and older log files; readers of those fail from then on.

        Not while another writes: its data is not named yet.
        """
        last = self.version()
        named = {f for v in range(max(1, last - keep + 1), last + 1) for f in self.folders(v).values()}
        gone = [s.getPath() for s in self._files.listStatus(self._at("data")) if s.getPath().getName() not in named] if self._files.exists(self._at("data")) else []
        for path in gone:
            self._files.delete(path, True)
        for v in range(1, last - keep + 1):
            self._files.delete(self._at(f"log/{v:012d}"), False)
        return len(gone)
