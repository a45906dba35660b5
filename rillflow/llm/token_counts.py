"""Token counts as delta-maintained rollups: signed changes update additive totals, one idempotent commit per batch.

A store is a folder: data/ holds each commit's summed changes, in parquet, and commits/<id> is a small file that names those
of one batch. A commit writes its data first; then the file is moved to its place by a rename that fails if the place is taken.
So a batch counts whole or not at all, committing an id again changes nothing, and of two writers of an id one gets True.
compact() sums what is committed into one folder, named by a file compactions/<number> that is put to its place alike: totals
then read that folder and the batches that came since.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def inserts(counted: DataFrame) -> DataFrame:
    """Changes that add documents: rows of (source, lang, tokenizer, tokens). A null count adds a document without tokens."""
    return counted.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("n_tokens"))


def deletes(counted: DataFrame) -> DataFrame:
    """Changes that take documents away again, with the counts they were added with."""
    return counted.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.coalesce("tokens", F.lit(0))).cast("long").alias("n_tokens"))


def revisions(counted: DataFrame) -> DataFrame:
    """Changes of counts: rows of (source, lang, tokenizer, old_tokens, tokens). Documents stay as many."""
    return counted.select(*KEYS, F.lit(0).cast("long").alias("n_docs"), (F.coalesce("tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))).cast("long").alias("n_tokens"))


class TokenRollup:
    """Totals by source, language and tokenizer version, kept in one folder by any path that Spark opens."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Ids of the batches that are in the totals."""
        at = self._path(f"{self.path}/commits")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _claim(self, batch: str, folder: str) -> bool:
        """Make commits/<batch> name the folder; False where that file is there."""
        return self._put(f"commits/{batch}", folder)

    def _put(self, place: str, content: str) -> bool:
        """A file with this content at its place; False where one is there, whoever put it there and however lately."""
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        written, at = self._path(f"{self.path}/staging/{uuid.uuid4().hex}"), self._path(f"{self.path}/{place}")
        self._fs.mkdirs(at.getParent())
        out = self._fs.create(written, False)
        out.write(bytearray(content.encode()))
        out.close()
        no_options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(self._fs.makeQualified(written), self._fs.makeQualified(at), no_options)  # without leave to overwrite
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            self._fs.delete(written, False)
            return False
        return True

    def commit(self, batch: str, *changes: DataFrame) -> bool:
        """Add a batch's changes; False, and nothing added, where the id is committed already, or is by another writer meanwhile.

        Changes are summed by key before and after one shuffle; keys whose changes cancel out are left out. Null keys are
        keys; repeated rows count each. A batch without changes is committed, and adds nothing. A run that dies leaves a
        folder of data that no commit names and no total reads.
        """
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        if self._fs.exists(self._path(f"{self.path}/commits/{batch}")):
            return False
        union = changes[0].select(*KEYS, "n_docs", "n_tokens")
        for more in changes[1:]:
            union = union.unionByName(more.select(*KEYS, "n_docs", "n_tokens"))
        summed = union.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
        folder = uuid.uuid4().hex
        summed.write.parquet(f"{self.path}/data/{folder}")
        if self._claim(batch, folder):
            return True
        self._fs.delete(self._path(f"{self.path}/data/{folder}"), True)
        return False

    def _compacted(self) -> tuple[int, str | None, list[str]]:
        """Number, folder and batches of the newest compaction; (0, None, []) before the first."""
        at = self._path(f"{self.path}/compactions")
        last = max((int(s.getPath().getName()) for s in self._fs.listStatus(at)), default=0) if self._fs.exists(at) else 0
        if not last:
            return 0, None, []
        told = json.loads(self.spark.read.text(f"{self.path}/compactions/{last}", wholetext=True).first()["value"])
        return last, told["folder"], told["batches"]

    def _summed(self) -> tuple[int, list[str], DataFrame]:
        """Number of the newest compaction, batches in the totals, and the totals by key."""
        number, folder, covered = self._compacted()
        batches = self.committed()
        since = sorted(set(batches) - set(covered))
        # one small file for each batch since the last compaction
        folders = [r["value"] for r in self.spark.read.text([f"{self.path}/commits/{b}" for b in since]).collect()] if since else []
        read = self.spark.read.schema(SCHEMA).parquet(*(f"{self.path}/data/{f}" for f in [*([folder] if folder else []), *folders]))
        return number, batches, read.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        """Totals by key; keys without documents and tokens are gone. Without a batch: empty."""
        return self._summed()[2] if self.committed() else self.spark.createDataFrame([], SCHEMA)

    def compact(self) -> bool:
        """Sum all batches that are committed now; False if there are none since the last time, or another writer was first.

        Totals are the same before, while and after; batches that are committed meanwhile are read beside it.
        """
        if not set(self.committed()) - set(self._compacted()[2]):
            return False
        number, batches, sums = self._summed()
        folder = uuid.uuid4().hex
        sums.coalesce(1).write.parquet(f"{self.path}/data/{folder}")  # a row for each source, language and tokenizer
        if self._put(f"compactions/{number + 1}", json.dumps({"folder": folder, "batches": batches})):
            return True
        self._fs.delete(self._path(f"{self.path}/data/{folder}"), True)
        return False


def counted(docs: DataFrame, tokenizer: str, tokens: Column, *more: Column) -> DataFrame:
    """Rows of (source, lang, tokenizer, tokens, ...) for one version of a tokenizer."""
    return docs.select(F.col("source"), F.col("lang"), F.lit(tokenizer).alias("tokenizer"), tokens.cast("long").alias("tokens"), *more)
