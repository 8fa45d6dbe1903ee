"""Incremental application of numbered files to a keyed ledger, safe to replay."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import listed, remove
from ..operators import keyed as K

FOLDS = {"pmid": K.KNOWN, "title": K.LAST, "source_date": K.LAST, "first_seen": K.FIRST, "last_seen": K.LAST}
LEDGER = "doi string, pmid long, title string, source_date date, relevant boolean, download_status string, first_seen date, last_seen date"


_POINTERS = "batch long, versions map<int,string>, number long"


class Ledger:
    """A keyed table in buckets by key, below a folder; a pointer names each bucket's version in force and the last file applied.

    A batch rewrites the buckets that it touches and no others. Versions are
    written before their pointer row, so a crash between the two leaves the old
    ones in force, and a replayed batch finds its number applied. The number of
    buckets is set when a ledger begins and must stay.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def state(self) -> tuple[int, dict[int, str], int]:
        """(last batch, versions by bucket, last file number)."""
        try:
            last = self.spark.read.schema(_POINTERS).parquet(f"{self.folder}/pointers").orderBy(F.desc("batch")).first()
        except Exception as e:  # noqa: BLE001  no pointer yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            last = None
        return (last["batch"], dict(last["versions"]), last["number"]) if last else (-1, {}, -1)

    def _read(self, versions: dict[int, str]) -> DataFrame:
        paths = [f"{self.folder}/{version}/bucket={b}" for b, version in sorted(versions.items())]
        return self.spark.read.schema(LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER)

    def read(self) -> DataFrame:
        return self._read(self.state()[1])

    def apply(self, rows: DataFrame, batch: int, today: str, floor: str | None = None) -> None:
        """Upsert the rows of one batch, of one file or several: ``number`` (file), ``ordinal`` in it, and record columns."""
        last, versions, number = self.state()
        if batch <= last:
            return
        bucket = F.pmod(F.xxhash64("doi"), F.lit(self.buckets)).cast("int")
        rows = rows.where(F.col("number") > number)
        top = rows.agg(F.max("number")).first()[0]
        if floor:
            rows = rows.where(F.col("source_date") >= F.lit(floor).cast("date"))
        touched = {r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()}  # no more than there are buckets
        if touched:
            day = F.lit(today).cast("date")
            rows = rows.withColumns({"first_seen": day, "last_seen": day, "order": F.struct("number", "ordinal")})
            version = f"version-{uuid.uuid4().hex}"
            stored = self._read({b: v for b, v in versions.items() if b in touched})
            new = K.upsert(stored, rows, "doi", "order", FOLDS).withColumn("bucket", bucket)
            new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{version}")
            versions |= dict.fromkeys(touched, version)
        pointer = [(batch, versions, number if top is None else int(top))]
        self.spark.createDataFrame(pointer, _POINTERS).coalesce(1).write.mode("append").parquet(f"{self.folder}/pointers")

    def vacuum(self) -> int:
        """Delete the versions that the pointer in force does not name; readers of older states must be done. How many went."""
        named = set(self.state()[1].values())
        return remove(self.spark, [p for p in listed(self.spark, self.folder) if p.rsplit("/", 1)[-1].startswith("version-") and p.rsplit("/", 1)[-1] not in named])


def sync(spark: SparkSession, files: str, schema: str, ledger: Ledger, checkpoint: str, today: str, floor: str | None = None, files_at_once: int = 16) -> None:
    """Apply the files not yet applied, some at a time in order, then stop. Rows of a batch fold by file and place."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("latestFirst", "false").parquet(files)
    query = stream.writeStream.foreachBatch(lambda df, n: ledger.apply(df, n, today, floor)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def working_set(ledger: DataFrame, end: str, months: int = 6) -> DataFrame:
    """Rows within the closure horizon: calendar months before ``end``. Others stay in the ledger."""
    return ledger.where(F.col("source_date") >= F.add_months(F.lit(end).cast("date"), -months))
