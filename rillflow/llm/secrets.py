"""Secret scans with a ledger of blobs: every text is addressed by its content and scanned once for each version of a rule.

A history is rows of (path, text), one for every version of every file. Its distinct texts are blobs, named by their sha256.
The ledger is a parquet table of (blob, rule, version, spans), one row for each pair that was scanned, also where nothing was
found. A scan looks up which pairs of its blobs are missing, scans those alone, and appends them; findings are then joined
back to all paths that have the blob. A row of the ledger depends on the blob and the rule alone: a scan that dies halfway or
runs twice leaves nothing wrong, at worst rows that repeat, which count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import arrow_pass, salted, stored

#: Texts to scan whose keys (8 bytes each) travel to the texts; beyond, texts are shuffled to meet their keys.
BROADCAST_KEYS = 1_000_000
#: Tasks that share the paths of one blob.
SALTS = 16
ENTRIES = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are leftmost and don't overlap; those whose `group` is shorter than `least` are dropped.

    fold: the pattern is of small letters and stands for either case, A-Z alone. A changed rule needs a new version.
    """

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in the order in which spans of one start are listed.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}+"),  # a shorter run has no longer one inside
    Rule("hex", 1, r"[0-9a-f]{24,}+"),
)
#: What the ledger's rules add: private keys in armour, and signed web tokens, each with its whole body.
ADDED = (
    Rule("pem", 1, r"-----BEGIN (?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END (?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY-----)?"),
    Rule("jwt", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
)
RULES = (*BASE, *ADDED)


def spans_of(text: str, rule: Rule, folded: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of a rule's findings in code points, end exclusive. folded: the text with A-Z in small letters, if at hand."""
    if rule.fold:
        text = lowered(text) if folded is None else folded
    return [m.span() for m in re.finditer(rule.pattern, text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def lowered(text: str) -> str:
    """A-Z as small letters; all other characters, and so all places, stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def blob_of(text: str) -> Column:
    """Content address of a column of texts; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


class BlobLedger:
    """What was scanned and found, kept in one folder by any path that Spark opens."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        """(blob, rule, version, spans) of all scanned pairs; a pair can be there twice, with equal spans."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).parquet(self.path)

    def unseen(self, addressed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, path, rules): blobs of addressed() with rules, as bits of their place in `rules`, they weren't scanned for, and the
        least path that has them. Copies meet as one row before the shuffle, the ledger's rows by blob."""
        bit = lambda rule: F.when((F.col("rule") == rule.kind) & (F.col("version") == rule.version), F.lit(1 << rules.index(rule))).otherwise(F.lit(0))
        seen = self.entries().select(F.col("blob").alias("__blob"), sum((bit(r) for r in rules), F.lit(0)).alias("bit")).groupBy("__blob").agg(F.bit_or("bit").alias("seen"))
        blobs = addressed.groupBy("blob").agg(F.min("path").alias("path"))
        missing = F.coalesce(F.col("seen"), F.lit(0)).bitwiseXOR(F.lit((1 << len(rules)) - 1))
        return blobs.join(seen, F.col("blob") == F.col("__blob"), "left").select("blob", "path", missing.alias("rules")).where("rules <> 0")

    def scan(self, history: DataFrame, addressed: DataFrame | None = None, *, path: str = "path", text: str = "text", rules: tuple[Rule, ...] = RULES) -> int:
        """Scan the pairs of blobs and rules that the ledger lacks, and add them; the number of blobs that had any.

        addressed: addressed(history), if at hand. A text is scanned where it is read: of a blob's rows, in that of the least
        path; copies with that very path are scanned once in each task that holds one.
        """
        addressed = addressed if addressed is not None else stored(address(history, path=path, text=text), "secret-addresses")
        todo = stored(self.unseen(addressed, rules).select(F.xxhash64("blob", "path").alias("__key"), F.col("rules").alias("__rules")), "secret-todo")
        n = todo.count()
        if not n:
            return 0
        here = history.select(F.col(path).alias("__path"), F.coalesce(F.col(text), F.lit("")).alias("__text")).withColumn("__blob", blob_of("__text"))
        wanted = todo if n > BROADCAST_KEYS else F.broadcast(todo)
        # keys of 64 bits: two that met by chance would scan a text too many, and none too few
        met = here.join(wanted, F.xxhash64("__blob", "__path") == F.col("__key")).select("__blob", "__rules", "__text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: set[bytes] = set()
            for batch in batches:
                rows = []
                for blob, bits, value in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    if blob in done:
                        continue
                    done.add(blob)
                    folded = lowered(value)
                    rows += [(blob, r.kind, r.version, [{"start": a, "end": b} for a, b in spans_of(value, r, folded)]) for k, r in enumerate(rules) if bits >> k & 1]
                columns = zip(*rows, strict=True) if rows else [[], [], [], []]
                kinds = (pa.binary(), pa.string(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["blob", "rule", "version", "spans"])

        arrow_pass(met, run, ENTRIES).write.mode("append").option("compression", "zstd").parquet(self.path)
        return n

    def findings(self, addressed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """The rows of addressed() with spans: an array of (start, order, end, kind), by start and the rules' order.

        Only blobs with findings are joined; the paths of a blob that very many have are shared by tasks.
        """
        order = sum((F.when((F.col("rule") == r.kind) & (F.col("version") == r.version), F.lit(k + 1)).otherwise(F.lit(0)) for k, r in enumerate(rules)), F.lit(0))
        found = self.entries().withColumn("order", order).where("order > 0 and size(spans) > 0").dropDuplicates(["blob", "rule", "version"])
        each = found.select("blob", "order", "rule", F.explode("spans").alias("s")).select("blob", F.struct("s.start", "order", "s.end", F.col("rule").alias("kind")).alias("span"))
        by_blob = each.groupBy(F.col("blob").alias("__blob")).agg(F.array_sort(F.collect_list("span")).alias("spans"))
        return salted(addressed, "blob", "path", by_blob, "__blob", SALTS, "left").drop("__blob").withColumn("spans", F.coalesce("spans", F.expr("array()").cast(by_blob.schema["spans"].dataType)))


def address(history: DataFrame, *, path: str = "path", text: str = "text") -> DataFrame:
    """(path, blob) of every row of a history."""
    return history.select(F.col(path).alias("path"), blob_of(text).alias("blob"))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find_secrets(docs: DataFrame, ledger: BlobLedger, *, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, blob and spans of every row, after a scan of what the ledger lacks.

    A null text is empty, and so has nothing. Rows that repeat, or share a text, or have no id, each have its findings. Texts
    of any length are scanned whole, in time linear in their length. Of an empty table the result is empty. Columns other
    than the two aren't read, whatever their names.
    """
    addressed = stored(address(docs, path=doc_id, text=text), "secret-addresses")
    ledger.scan(docs, addressed, path=doc_id, text=text, rules=rules)
    return ledger.findings(addressed, rules)
