"""A digest index beside stored rows: what has been ingested, without reading it again.

For every stored file the index holds one narrow row per distinct content: a 64-bit
key, a SHA-256 digest over all columns, and the bucket of the key.  New rows meet the
index of the buckets that they touch; contents are equal if key and digest are.  The
index files carry bloom filters over the keys, for lookups by a few of them.

The index follows the files: it lists which ones it covers, and ``catch_up`` adds the
others.  So rows that were stored by a load that died before it could index them are
indexed by the next one, and rows stored before there was an index are, too.  Digests
are written before their file is listed; a death in between leaves repeated digests,
which change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.sources.marks import PLACE, marked, marks_of, with_places
from tallyroom.sources.readers import stored_files

BUCKETS = 64
_DIGEST_DDL = "Key long, Digest binary, Bucket int"
_FILES_DDL = "File string"


def content_key(columns: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def content_digest(columns: Iterable[str]) -> Column:
    """SHA-256 over all values; every value says its length, and NULL differs from all."""
    return digest_of(F.col(c) for c in columns)


def digest_of(values: Iterable[Column]) -> Column:
    """The same over any values."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


class ContentIndex:
    """The index of a folder of Parquet files, in a folder beside it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        """``schema`` has the columns that make up a content."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.base = f"{self.path}__index"

    def _digests(self, rows: DataFrame) -> DataFrame:
        names = self.schema.names
        key = content_key(names)
        bucket = F.pmod(key, F.lit(BUCKETS)).cast("int")
        return rows.select(key.alias("Key"), content_digest(names).alias("Digest"), bucket.alias("Bucket"))

    def _listed(self) -> set[str]:
        listed = stored_files(self.spark, f"{self.base}/files", T.StructType.fromDDL(_FILES_DDL))
        return set() if listed is None else {r[0] for r in listed.collect()}  # names of files

    def catch_up(self) -> int:
        """Indexes the stored files that are not covered yet; returns how many they were."""
        stored = stored_files(self.spark, self.path)
        if stored is None:
            return 0
        new = sorted(f for f in stored.inputFiles() if _name(f) not in self._listed())
        if not new:
            return 0
        rows = self.spark.read.schema(self.schema).parquet(*new)
        digests = self._digests(rows).distinct()
        (
            digests.repartition("Bucket")
            .write.mode("append")
            .partitionBy("Bucket")
            .option("parquet.bloom.filter.enabled#Key", "true")
            .option("compression", "zstd")
            .parquet(f"{self.base}/digests")
        )
        names = self.spark.createDataFrame([(_name(f),) for f in new], _FILES_DDL)
        names.coalesce(1).write.mode("append").parquet(f"{self.base}/files")
        return len(new)

    def unknown(self, rows: DataFrame) -> DataFrame:
        """The rows, all columns, whose content is not stored; what repeats among them stays."""
        known = self._known(rows)
        if known is None:
            return rows
        return self._without(self._keyed(rows), known).drop("_key", "_digest")

    def unknown_stored(self, rows: DataFrame) -> DataFrame:
        """The same where ``rows`` are a scan of stored files, perhaps with changed values.

        Keys, digests and places (see ``marks``) meet the index; the rows stay where they are.
        """
        known = self._known(rows)
        if known is None:
            return rows
        placed = with_places(rows)
        narrow = self._keyed(placed).select("_key", "_digest", *PLACE)
        marks = marks_of(self._without(narrow, known).select(*PLACE))
        return self.unknown(rows) if marks is None else marked(placed, marks).select(*rows.columns)

    def _known(self, rows: DataFrame) -> DataFrame | None:
        """The index of the buckets that the rows touch.

        A file's digests are distinct, and one that several files have leaves out a row no
        other than one: they go to the join as they are stored.
        """
        stored = stored_files(self.spark, f"{self.base}/digests", T.StructType.fromDDL(_DIGEST_DDL))
        if stored is None:
            return None
        bucket = F.pmod(content_key(self.schema.names), F.lit(BUCKETS)).cast("int")
        touched = [r[0] for r in rows.select(bucket.alias("b")).distinct().collect()]  # BUCKETS at most
        return stored.where(F.col("Bucket").isin(touched))

    def _keyed(self, rows: DataFrame) -> DataFrame:
        names = self.schema.names
        return rows.withColumns({"_key": content_key(names), "_digest": content_digest(names)})

    def _without(self, keyed: DataFrame, known: DataFrame) -> DataFrame:
        same = (keyed["_key"] == known["Key"]) & (keyed["_digest"] == known["Digest"])
        return keyed.join(known, same, "left_anti")


def _name(file: str) -> str:
    return file.rpartition("/")[2]
