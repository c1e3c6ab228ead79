"""Keys of a table in a bucketed catalog table, so that finding new rows never shuffles the target.

The index is a copy that can always be made again: it says, as a table property, which version of the table it
covers, and catches up before it is read. It is written after the table and its property
after it; a stop in between leaves keys twice, which an anti join doesn't mind, and never a key
that the table lacks. A version that dropped rows or rewrote files has the index made anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from brooklet.sources.tables import Table, Version

BUCKETS = 64
_PROPERTY = "brooklet.covers"


class KeyIndex:
    """The keys of a partitioned table as ``database.name``, clustered by key into buckets."""

    def __init__(self, table: Table, key: str, database: str, name: str, buckets: int = BUCKETS) -> None:
        self._spark, self._table, self.key, self.buckets = table.spark, table, key, buckets
        self._database, self._name = f"`{database}`", f"`{database}`.`{name}`"
        self._types = {c: table.schema[c].dataType.simpleString() for c in (key, table.partition)}

    def _covers(self) -> int:
        return int(self._spark.sql(f"SHOW TBLPROPERTIES {self._name} ('{_PROPERTY}')").first().value)

    def _cover(self, number: int) -> None:
        self._spark.sql(f"ALTER TABLE {self._name} SET TBLPROPERTIES ('{_PROPERTY}' = '{number}')")

    def _made(self) -> None:
        self._spark.sql(f"CREATE DATABASE IF NOT EXISTS {self._database}")
        self._spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name} (`{self.key}` {self._types[self.key]}, `{self._table.partition}` {self._types[self._table.partition]}) USING parquet "
            f"PARTITIONED BY (`{self._table.partition}`) CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS TBLPROPERTIES ('{_PROPERTY}' = '0')"
        )

    def _added(self, now: Version) -> tuple[tuple, bool]:
        """(what the index lacks of a version, whether the index is of no use)."""
        covers = self._covers()
        if not covers:
            return now.generations, True
        if covers not in self._table.versions():
            return now.generations, True
        old = dict(self._table.version(covers).generations)
        kept = {g: parts for g, parts in now.generations if g in old}
        whole = kept == old  # nothing was replaced
        return (tuple(x for x in now.generations if x[0] not in old), False) if whole else (now.generations, True)

    def keys(self) -> DataFrame:
        """(key, partition) of the table's newest version, scanned by bucket."""
        self._made()
        now = self._table.version() or Version(0)
        if self._covers() != now.number:
            missing, anew = self._added(now)
            if anew:
                self._cover(0)
                self._spark.sql(f"TRUNCATE TABLE {self._name}")
            if missing:
                rows = self._table.read_version(Version(now.number, missing)).select(self.key, self._table.partition)
                rows.repartition(self.buckets, self.key).write.insertInto(self._name)
            self._cover(now.number)
        return self._spark.table(self._name)

    def dealt(self, candidates: DataFrame) -> DataFrame:
        """Candidates dealt as the buckets are, so that the join moves them alone."""
        return candidates.repartition(self.buckets, self.key)
