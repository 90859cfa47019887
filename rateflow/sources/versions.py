"""A database that is replaced as one step.

Each build goes to a database of its own, ``<name>__<version>``. The database
``<name>`` holds no tables but a pointer, a property that names the current
version; setting it is one call to the catalog, so a reader finds all tables of
the old build or all of the new one. Readers that already resolved a version go
on with it: versions before the current are kept until ``keep`` newer ones exist.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

POINTER = "rateflow.current"
_MARK = "__v"


def create(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The database of versions, if it is not there."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def current(spark: SparkSession, name: str) -> str | None:
    """The database of the current version; None before the first."""
    return _properties(spark, name).get(POINTER)


def open_version(spark: SparkSession, name: str) -> str:
    """A new, empty database to build the next version in.

    Numbers go up from the highest there is, also past builds that failed; what
    a failed build left is replaced by nothing and read by nobody.
    """
    numbers = [int(v.rpartition(_MARK)[2]) for v in versions(spark, name)]
    database = f"{name}{_MARK}{max(numbers, default=0) + 1}"
    location = spark.catalog.getDatabase(name).locationUri.rstrip("/")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{location}/{database}'")
    return database


def publish(spark: SparkSession, name: str, database: str, keep: int = 2) -> None:
    """Make ``database`` the current version, then drop all but ``keep`` of the
    versions up to it."""
    if keep < 1:
        raise ValueError("the current version is kept")
    spark.sql(f"ALTER DATABASE `{name}` SET DBPROPERTIES ('{POINTER}' = '{database}')")
    built = versions(spark, name)
    for old in built[: max(0, built.index(database) + 1 - keep)]:
        spark.sql(f"DROP DATABASE `{old}` CASCADE")


def versions(spark: SparkSession, name: str) -> list[str]:
    """The databases of the versions there are, oldest first."""
    pattern = re.compile(re.escape(name) + _MARK + r"\d+$")
    found = [d.name for d in spark.catalog.listDatabases() if pattern.match(d.name)]
    return sorted(found, key=lambda v: int(v.rpartition(_MARK)[2]))


def resolved(spark: SparkSession, table: str) -> str:
    """``database.table`` in the current version, where the database has any."""
    database, _, name = table.rpartition(".")
    if not database or not spark.catalog.databaseExists(database):
        return table
    at = current(spark, database)
    return f"{at}.{name}" if at else table


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(resolved(spark, table))


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{name}`").collect()
    text = {r["info_name"]: r["info_value"] for r in rows}.get("Properties") or ""
    return dict(re.findall(r"\(([^,()]+),([^()]*)\)", text))
