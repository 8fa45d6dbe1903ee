"""A folder of versioned tables: a run database or a ledger.

A commit writes new versions of the changed tables and then one row that names
the versions in force, so several tables change together or not at all, and a
reader keeps the state it began with. Commits are numbered, and each has a
folder of its own that only one writer can make: of two that began from the same
state the later one fails and changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .folders import listed, remove

_COMMITS = "n long, token string, versions map<string,string>"


class Conflict(RuntimeError):
    """Another writer committed since this one read the state."""


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _commit(self, n: int) -> str:
        return f"{self.folder}/commits/{n:012d}"

    def _last(self) -> tuple[int, dict[str, str]]:
        """Number and versions of the last commit; of rows of one number, which only a race leaves, the least token counts."""
        found = sorted(int(p.rsplit("/", 1)[-1]) for p in listed(self.spark, f"{self.folder}/commits") if p.rsplit("/", 1)[-1].isdigit())
        for n in reversed(found):
            row = self.spark.read.schema(_COMMITS).parquet(self._commit(n)).orderBy("token").first()
            if row:
                return n, dict(row["versions"])
        return 0, {}

    def tables(self) -> dict[str, str]:
        return self._last()[1]

    def read(self, table: str) -> DataFrame:
        """The table's version in force; an empty frame before its first."""
        version = self.tables().get(table)
        if version is None:
            return self.spark.createDataFrame([], schemas.of(table))
        return self.spark.read.schema(schemas.of(table)).parquet(f"{self.folder}/{table}/{version}")

    def commit(self, **changed: DataFrame) -> None:
        """Make these the tables' new versions, all at once; raises ``Conflict`` if another commit came between."""
        n, versions = self._last()
        for table, df in changed.items():
            versions[table] = uuid.uuid4().hex
            schemas.checked(df, table).write.parquet(f"{self.folder}/{table}/{versions[table]}")
        token = uuid.uuid4().hex
        row = self.spark.createDataFrame([(n + 1, token, versions)], _COMMITS).coalesce(1)
        try:
            row.write.mode("errorifexists").parquet(self._commit(n + 1))
        except Exception as e:
            if "PATH_ALREADY_EXISTS" not in str(e):
                raise
            raise Conflict(f"commit {n + 1} of {self.folder} was made by another writer") from None
        first = self.spark.read.schema(_COMMITS).parquet(self._commit(n + 1)).orderBy("token").first()
        if first is None or first["token"] != token:
            raise Conflict(f"commit {n + 1} of {self.folder} was made by another writer")

    def vacuum(self) -> int:
        """Delete the table versions that the last commit does not name; readers of older states must be done. How many went."""
        versions = self.tables()
        old = [p for table in versions for p in listed(self.spark, f"{self.folder}/{table}") if p.rsplit("/", 1)[-1] != versions[table]]
        return remove(self.spark, old)
