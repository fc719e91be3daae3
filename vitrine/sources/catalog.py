"""Catalog tables: create, read, replace, append, truncate."""

from __future__ import annotations

import re
import threading
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.upsert import has_key, insert_only, new_keyless, upsert
from ..schemas import MART_KEYS, STAGING_KEY, TABLES
from ..session import stored

# Schema names.
SCHEMAS = ("raw", "staging", "marts", "report", "lineage")
RUN_COLUMNS = "_run STRING, _batch STRING"


class Warehouse:
    """The tables of one deployment.

    `prefix` goes before the schema names, `location` is the folder that holds them (default: the session's
    warehouse). A changed table is a new version beside the old one, then the view that carries its name is switched.
    Readers always find the name, a failed write leaves the old version in place, and a plan may read the table it
    replaces.

    A table with a key is stored in cells: partitions (`_cell`, not shown by the view) of rows close in key order, one
    folder each. Versions share folders: a merge writes the cells that hold keys of the batch anew and lists all others
    where they are. Which cells those are is found from each cell's first and last key, kept beside the version, and then
    exactly by a semi-join with the keys of the cells left. A cell is forgotten with the last version that lists it.
    """

    def __init__(self, spark: SparkSession, prefix: str = "", location: str | None = None,
                 buckets: int | None = None):
        self.spark, self.prefix, self.location = spark, prefix, location
        self._append_lock = threading.Lock()
        self.cells = buckets  # how many cells a new table gets; left open, Spark's advisory partition size decides

    def name(self, table: str) -> str:
        return self.prefix + table

    def _split(self, table: str) -> tuple[str, str]:
        schema, base = self.name(table).split(".")
        return schema, base

    def create_schema(self, schema: str) -> None:
        where = f" LOCATION '{self.location}/{self.prefix}{schema}'" if self.location else ""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{schema}{where}")

    def create_all(self) -> None:
        """All schemas and the tables with a fixed definition, empty where new."""
        for schema in SCHEMAS:
            self.create_schema(schema)
        for table, definition in TABLES.items():
            if self.exists(table):
                continue
            if versions := self._versions(table):  # written, but the switch of the view was cut off
                self._show(table, versions[-1])
                continue
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in definition.schema.fields)
            if table.startswith("lineage."):
                self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}, {RUN_COLUMNS}) USING parquet PARTITIONED BY (_run, _batch)")
            else:
                self.replace(table, self.spark.createDataFrame([], definition.schema))

    def _show(self, table: str, version: int) -> None:
        name = f"{self.name(table)}__v{version}"
        columns = ", ".join(f"`{c}`" for c in self.spark.table(name).columns if c != "_cell")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT {columns} FROM {name}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        rows = self.spark.table(self.name(table))
        return rows.drop("_run", "_batch") if table.startswith("lineage.") else rows

    def key(self, table: str) -> tuple[str, ...]:
        if table in TABLES:
            return TABLES[table].key
        return MART_KEYS.get(table, STAGING_KEY if table.startswith("staging.") else ())

    def _versions(self, table: str) -> list[int]:
        schema, base = self._split(table)
        found = self.spark.sql(f"SHOW TABLES IN {schema} LIKE '{base}__v*'").collect()
        return sorted(int(m.group(1)) for r in found if (m := re.fullmatch(rf"{re.escape(base)}__v(\d+)", r.tableName)))

    def _folder(self, table: str) -> str:
        schema, base = self._split(table)
        root = f"{self.location}/{schema}" if self.location else f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{schema}.db"
        return f"{root}/{base}__cells/{uuid.uuid4().hex}"

    def _cells(self, table: str, df: DataFrame, first: int, keys: list[str], cells: int | None = None) -> DataFrame:
        """Write `df` as cells from number `first` on; returns their index rows (cell, folder, first and last key, rows)."""
        folder = self._folder(table)
        # The hash spreads rows without a key, which are alike to the ranges.
        order = [*keys, F.xxhash64(*df.columns)]
        dealt = df.repartitionByRange(cells, *order) if cells else df.repartitionByRange(*order)
        dealt.withColumn("_cell", F.spark_partition_id() + first).write.partitionBy("_cell").parquet(folder)
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", _cell int"
        key = F.struct(*[F.col(k) for k in keys])
        return self.spark.read.schema(shape).parquet(folder).groupBy("_cell").agg(
            F.min(F.when(has_key(keys), key)).alias("lo"), F.max(F.when(has_key(keys), key)).alias("hi"), F.count("*").alias("n"),
        ).withColumn("folder", F.concat(F.lit(f"{folder}/_cell="), F.col("_cell").cast("string")))

    def _index(self, table: str, version: int | None = None) -> DataFrame:
        return self.spark.table(f"{self.name(table)}__index{version or self._versions(table)[-1]}")

    def _publish(self, table: str, schema, index: DataFrame | None, keep: int = 2) -> None:
        """Show a new version that lists the cells of `index`; versions before the last `keep` go, and what only they list."""
        old = self._versions(table)
        version = old[-1] + 1 if old else 1
        name = f"{self.name(table)}__v{version}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}, _cell INT) USING parquet PARTITIONED BY (_cell) LOCATION '{self._folder(table)}'")
        index.write.saveAsTable(f"{self.name(table)}__index{version}")
        listed = [(r["_cell"], r.folder) for r in self._index(table, version).select("_cell", "folder").collect()]  # one a folder
        for at in range(0, len(listed), 1000):
            self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (_cell={c}) LOCATION '{f}'" for c, f in listed[at:at + 1000]))
        self._show(table, version)
        used = reduce(DataFrame.union, [self._index(table, v).select("folder") for v in [*old, version][-keep:]])
        for number in old[:-keep + 1]:
            gone = self._index(table, number).select("folder").join(used, "folder", "left_anti").collect()
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__v{number}")
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__index{number}")
            for row in gone:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(row.folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def replace(self, table: str, df: DataFrame, keys: list[str] | None = None) -> None:
        """Make `df` the content of `table`, in cells by `keys` (default: the table's key, if it has one); the version before
        stays readable until the next change."""
        self.create_schema(table.split(".")[0])
        if keys := keys or list(self.key(table)):
            self._publish(table, df.schema, self._cells(table, df, 0, keys, self.cells))
            return
        old = self._versions(table)
        version = old[-1] + 1 if old else 1
        df.write.format("parquet").saveAsTable(f"{self.name(table)}__v{version}")
        self._show(table, version)
        for number in old[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}__v{number}")

    def touched(self, table: str, batch: DataFrame, keys: list[str]) -> tuple[DataFrame, list[int]]:
        """The rows, with `_cell`, of the cells that hold a key of `batch`, and the numbers of these cells.

        Cells whose first and last keys enclose none of the batch's range are not read; of the others only the keys, next to
        those of the batch. Spark tests a Bloom filter of the smaller side at the scan of the larger one.
        """
        rows = self.spark.table(f"{self.name(table)}__v{self._versions(table)[-1]}")
        types = {f.name: f.dataType.simpleString() for f in rows.schema}
        wanted = batch.filter(has_key(keys)).select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
        key = F.struct(*[F.col(k) for k in keys])
        ends = wanted.agg(F.min(key).alias("first"), F.max(key).alias("last"))
        maybe = self._index(table).join(ends, F.expr("hi >= first and lo <= last")).select("_cell").collect()
        near = rows.filter(F.col("_cell").isin([r["_cell"] for r in maybe]))
        found = near.select("_cell", *keys).join(wanted, keys, "left_semi").select("_cell").distinct().collect() if maybe else []
        cells = sorted(r["_cell"] for r in found)
        return rows.filter(F.col("_cell").isin(cells)), cells

    def merge(self, table: str, batch: DataFrame, keys: list[str], ignore_conflicts: bool = False,
              touched: tuple[DataFrame, list[int]] | None = None) -> None:
        """Insert or overwrite the rows of `batch` (each key once); `ignore_conflicts` inserts new keys only.

        Rows without a key are new unless the table holds their values already. Only the cells that hold keys of the batch
        are read whole and written again, none of them where all keys are new.
        """
        rows, cells = touched or self.touched(table, batch, keys)
        target, index = self.read(table), self._index(table)
        inside = rows.drop("_cell")
        keyed, loose = batch.filter(has_key(keys)), new_keyless(target, batch, keys)
        if ignore_conflicts:
            written, cells = insert_only(inside, keyed, keys).unionByName(loose), []
            written = inside.limit(0).unionByName(written, allowMissingColumns=True).select(*target.columns)
        else:
            written = upsert(inside, keyed, keys).unionByName(upsert(inside.limit(0), loose, keys))
        first = index.agg(F.coalesce(F.max("_cell") + 1, F.lit(0)).alias("n")).first().n
        made = self._cells(table, written, first, keys)
        left = index.filter(~F.col("_cell").isin(cells)) if cells else index
        self._publish(table, target.schema, left.unionByName(made))

    def append(self, table: str, df: DataFrame, run: str = "", batch: str = "") -> None:
        """Add rows. Appends of one process take turns: commits into one folder share its temporary files. Lineage tables
        keep the rows of a run and batch in a partition of their own."""
        self.create_schema(table.split(".")[0])
        writer = df
        if table.startswith("lineage."):
            writer = df.withColumns({"_run": F.lit(run), "_batch": F.lit(batch)})
        with self._append_lock:
            out = writer.write.mode("append").format("parquet")
            (out.partitionBy("_run", "_batch") if table.startswith("lineage.") else out).saveAsTable(self.name(table))

    def append_once(self, table: str, rows: DataFrame, key: str, run: str, batch: str) -> None:
        """Append the rows of a run's batch whose key the same batch of the same run has not written yet: repeats change
        nothing, and no other partition of the table is read."""
        if self.exists(table):
            mine = self.spark.table(self.name(table)).filter((F.col("_run") == run) & (F.col("_batch") == batch)).select(key)
            rows = stored(rows.join(mine, key, "left_anti").select(*rows.columns), "new-rows")
        self.append(table, rows, run, batch)

    def truncate(self, table: str) -> None:
        """Empty a table and, as they would be left without parents, the tables that refer to it."""
        if table.startswith("lineage."):
            self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")
        else:
            self.replace(table, self.read(table).limit(0))
        for child, definition in TABLES.items():
            if self.exists(child) and any(parent == table for parent, _ in definition.parents.values()):
                self.truncate(child)

    def count(self, table: str) -> int:
        return self.read(table).count()


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in frames.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
