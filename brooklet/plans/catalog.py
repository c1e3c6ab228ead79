"""The marts as tables of the session catalog: ``SHOW TABLES``, ``DESCRIBE`` and SQL without views.

A catalog table points to the folders of a version of a mart; partitions carry
locations of their own, so a refresh of some dates moves those dates alone. What
was published is kept as a table property, and only what changed since is
altered. Publishing after a refresh is what makes it visible here; readers in
between see the version before.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from brooklet.schemas import MARTS
from brooklet.sources.sinks import hadoop_path
from brooklet.sources.tables import Table, Version

_PROPERTY = "brooklet.version"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _places(table: Table, version: Version) -> dict[str, str]:
    """The folder of each partition folder's name (one generation each, since marts are replaced by date)."""
    return {p: f"{table.path}/generation={g}/{p}" for g, parts in version.generations for p in parts or ()}


def publish(tables: dict[str, Table], database: str, location: str | None = None) -> list[str]:
    """Create or move catalog tables to the newest versions; returns those that changed."""
    spark = next(iter(tables.values())).spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}" + (f" LOCATION {_text(location)}" if location else ""))
    changed = []
    for name, table in tables.items():
        now, full = table.version(), f"{_quoted(database)}.{_quoted(name)}"
        if now is None:
            continue
        new = not spark.catalog.tableExists(full)
        if new:
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in table.schema)
            partition = f" PARTITIONED BY ({_quoted(table.partition)})" if table.partition else ""
            spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{partition} LOCATION {_text(_folder(table, now))} TBLPROPERTIES ({_text(_PROPERTY)} = '0')")
        before = _published(spark, full)
        if before == now.number:
            continue
        if table.partition:
            _move_partitions(spark, full, table, before, now)
        else:
            spark.sql(f"ALTER TABLE {full} SET LOCATION {_text(_folder(table, now))}")
        spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({_text(_PROPERTY)} = '{now.number}')")
        spark.catalog.refreshTable(full)
        changed.append(name)
    return changed


def _folder(table: Table, version: Version) -> str:
    """Where an unpartitioned mart lies; its table's folder for a partitioned one, and an empty folder for one without rows."""
    if table.partition:
        return table.path
    if version.generations:
        return f"{table.path}/generation={version.generations[-1][0]}"
    empty = f"{table.path}/_empty"
    where, fs = hadoop_path(table.spark, empty)
    fs.mkdirs(where)
    return empty


def _published(spark: SparkSession, full: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {full} ({_text(_PROPERTY)})").first().value)


def _move_partitions(spark: SparkSession, full: str, table: Table, before: int, now: Version) -> None:
    held = {r.partition for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}  # one row for each date
    old = _places(table, table.version(before)) if before in table.versions() else {}
    wanted = _places(table, now)
    spec = lambda p: f"PARTITION ({_quoted(table.partition)} = {_text(p.partition('=')[2])})"
    if gone := sorted(held - wanted.keys()):
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS {', '.join(map(spec, gone))}")
    if added := sorted(wanted.keys() - held):
        spark.sql(f"ALTER TABLE {full} ADD {' '.join(f'{spec(p)} LOCATION {_text(wanted[p])}' for p in added)}")
    for p in sorted(held & wanted.keys()):
        if old.get(p) != wanted[p]:
            spark.sql(f"ALTER TABLE {full} {spec(p)} SET LOCATION {_text(wanted[p])}")


def mart_tables(house) -> dict[str, Table]:
    return {n: house.table(n) for n in MARTS}
