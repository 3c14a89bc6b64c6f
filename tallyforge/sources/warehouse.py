"""Named tables of one database: write, read, query, count."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Part of the name of a version of a table, and the property of its view that names the version.
STAGED, VERSION = "__staged_", "version"


class Warehouse(Mapping):
    """Tables of a catalog database, addressed by their short name."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")

    def qualified(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def write(
        self,
        table: str,
        df: DataFrame,
        tier: str = "",
        comment: str = "",
        partition_by: Sequence[str] = (),
    ) -> None:
        """Replace a table; its tier and comment are kept as properties.

        A table is a view of the last version of its rows, each of which is a table and a folder of its own. The view
        moves to a new version in one catalog call when all its rows are there, so a reader finds the old rows or the new
        ones, a failed write leaves the old ones, and ``df`` may read the table that it replaces. The version before stays
        for those who still read it; older ones, and what a write that died has left, go with the next write.
        """
        if partition_by:
            # Few files per folder, and a large folder is still split over tasks.
            df = df.hint("rebalance", *partition_by)
        versions = self._versions(table)
        number = 1 + max((int(name[len(table + STAGED) :].split("_")[0]) for name in versions), default=0)
        made = f"{table}{STAGED}{number}_{uuid.uuid4().hex}"
        folder = f"{self.spark.catalog.getDatabase(self.database).locationUri.rstrip('/')}/{made}"
        writer = df.write.mode("errorifexists").format("parquet").option("path", folder)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.saveAsTable(self.qualified(made))
        except Exception:
            self._delete(folder)
            raise
        before = self._shown(table)
        self._show(table, made, comment, {"quality": tier, VERSION: made})
        for name in versions:
            if name != before:
                self._drop(name)

    def _versions(self, table: str) -> list[str]:
        """Tables that hold versions of a table, also those that no view shows."""
        found = self.spark.catalog.listTables(self.database, f"{table}{STAGED}*")
        return [t.name for t in found if t.name.startswith(table + STAGED)]

    def _shown(self, table: str) -> str | None:
        """The version that a table shows. A table of another kind becomes its first version."""
        if table not in self:
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(table)}").collect()
        shown = {r.key: r.value for r in rows}.get(VERSION)
        if shown is None:
            shown = f"{table}{STAGED}0_{uuid.uuid4().hex}"
            self.spark.sql(f"ALTER TABLE {self.qualified(table)} RENAME TO {self.qualified(shown)}")
        return shown

    def _show(self, table: str, version: str, comment: str, properties: Mapping[str, str]) -> None:
        text = ", ".join(f"'{k}' = '{_escaped(v)}'" for k, v in properties.items() if v)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.qualified(table)} COMMENT '{_escaped(comment)}' TBLPROPERTIES ({text}) "
            f"AS SELECT * FROM {self.qualified(version)}"
        )

    def _drop(self, version: str) -> None:
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(version)}")
        place = about.where("col_name = 'Location'").first()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(version)}")
        if place and STAGED in place.data_type:
            self._delete(place.data_type)

    def _delete(self, folder: str) -> None:
        """Remove a folder that ``write`` made."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").format("parquet").saveAsTable(self.qualified(table))

    def probe(self, table: str) -> bool:
        """Whether the table can be read and holds a row; stops at the first one."""
        return self[table].select(F.lit(1).alias("ping")).limit(1).count() == 1

    def query(self, text: str, **args) -> DataFrame:
        """SQL with named parameters (``:name``), run inside this database.

        Short table names in braces, such as ``{gold_order_backlog}``, become
        qualified names; values go through parameters and are never spliced in.
        """
        return self.spark.sql(text.format_map(_Names(self)), args=args)

    def __contains__(self, table: object) -> bool:
        return self.spark.catalog.tableExists(self.qualified(str(table)))

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self:
            raise KeyError(table)
        return self.spark.table(self.qualified(table))

    def __iter__(self) -> Iterator[str]:
        return (t.name for t in self.spark.catalog.listTables(self.database) if STAGED not in t.name)

    def __len__(self) -> int:
        return sum(1 for _ in self)


class _Names(dict):
    def __init__(self, warehouse: Warehouse):
        super().__init__()
        self.warehouse = warehouse

    def __missing__(self, table: str) -> str:
        return self.warehouse.qualified(table)


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def table_inventory(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected: Sequence[str]
) -> DataFrame:
    """Row count per expected table, with NULL and ``found = false`` where missing."""
    parts = [
        tables[name].agg(
            F.lit(name).alias("table_name"),
            F.lit(True).alias("found"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for name in expected
        if name in tables
    ]
    missing = [(name, False, None) for name in expected if name not in tables]
    schema = "table_name string, found boolean, row_count bigint"
    if missing:
        parts.append(spark.createDataFrame(missing, schema))
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema))
