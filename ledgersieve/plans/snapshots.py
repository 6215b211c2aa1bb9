"""Which files make up the tables of a warehouse: a manifest for each table, and numbered versions of all.

Data files are written once under names of their own and never changed. A table's manifest has a row for each of its
files, with period, counts and the least and greatest time in it; a change writes the manifest anew (it is small) and
then a version file that names the manifest of every table. Making that file is the one step by which a change of any
number of tables becomes visible; of two writers that change a table from the same version, one gets it and the other
is told. Readers take the newest version when they start and see it to the end.

Reads are planned from the manifest: they open the files of the periods and times asked for and list no folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersieve import files as store

#: One row for each file. ``version`` is the newest one whose loads it holds; ``load_run_id`` is null for merged loads.
FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("write_id", T.StringType()),
        T.StructField("load_run_id", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("posted_period", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("byte_count", T.LongType()),
        T.StructField("least", T.TimestampNTZType()),
        T.StructField("greatest", T.TimestampNTZType()),
        T.StructField("version", T.LongType()),
    ]
)


#: Half of a stored row is the text of its hash, which Snappy leaves as it is.
COMPRESSION = "zstd"


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0, 0, 1, 1).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


class ConcurrentChange(RuntimeError):
    """Another commit came first and touched the same tables."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    grain: str | None = None
    #: For each table: the name of its manifest.
    tables: dict[str, str] = field(default_factory=dict)
    #: For each derived table: the version of the loads it holds, the clock of its last refresh and the latest of all.
    layers: dict[str, dict[str, Any]] = field(default_factory=dict)

    def held(self, table: str) -> int:
        return self.layers.get(table, {}).get("holds", 0)

    def clock(self, table: str, which: str = "as_of") -> datetime | None:
        text = self.layers.get(table, {}).get(which)
        return datetime.fromisoformat(text) if text else None

    def text(self) -> str:
        return json.dumps(vars(self), sort_keys=True)


class Snapshots:
    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self.log = f"{base_dir}/_log"

    # Versions ---------------------------------------------------------------------------------------

    def _version_path(self, number: int) -> str:
        return f"{self.log}/versions/{number:012d}"

    def at(self, number: int) -> Version:
        if not number:
            return Version()
        return Version(**json.loads(store.read_text(self.spark, self._version_path(number))))

    def newest(self) -> Version:
        numbers = [int(name) for name in store.names(self.spark, f"{self.log}/versions") if name.isdigit()]
        return self.at(max(numbers, default=0))

    def start(self, grain: str) -> Version:
        """The newest version; the first one is made if there is none. It fixes the grain of the warehouse."""
        found = self.newest()
        if found.number:
            return found
        store.make_folder(self.spark, f"{self.log}/versions")
        try:
            store.create_text(self.spark, self._version_path(1), Version(1, grain=grain).text())
        except store.AlreadyThere:
            pass
        return self.newest()

    # Reading ----------------------------------------------------------------------------------------

    def manifest(self, version: Version, table: str, schema: T.StructType = FILE) -> DataFrame:
        """The manifest of a table, or a small table that is kept and versioned in the same way."""
        if table not in version.tables:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(f"{self.log}/manifests/{version.tables[table]}")

    def kept(self, rows: DataFrame) -> DataFrame:
        """A small table stored beside the log, so that it is worked out once."""
        path = f"{self.log}/work/{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def read(self, version: Version, table: str, schema: T.StructType, chosen: Column | DataFrame | None = None) -> DataFrame:
        """Rows of the table's files that a condition on the manifest, or a table of periods, picks.

        The paths come to the driver, as those of any scan do; no folder is listed for them.
        """
        found = self.manifest(version, table)
        if isinstance(chosen, DataFrame):
            found = found.join(chosen, "posted_period", "left_semi")
        elif chosen is not None:
            found = found.where(chosen)
        return self.open(table, schema, [row.path for row in found.select("path").collect()])

    def open(self, table: str, schema: T.StructType, paths: list[str]) -> DataFrame:
        root = f"{self.base_dir}/{table}"
        if not paths:
            return no_rows(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[f"{root}/{path}" for path in sorted(paths)]).select(schema.fieldNames())

    # Writing ----------------------------------------------------------------------------------------

    def write(self, table: str, rows: DataFrame, folders: list[str], write_id: str) -> None:
        """Write files that no version names yet. A write with the same id that was not committed is replaced."""
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", COMPRESSION)
            .partitionBy(*folders)
            .parquet(f"{self.base_dir}/{table}/write={write_id}")
        )

    def listed(self, table: str, schema: T.StructType, write_id: str, moment: str | None, version: int, load_run_id: str | None = None) -> DataFrame:
        """Manifest rows of a write, from its files: at most one column is read, counts and sizes come from Spark."""
        root = f"{self.base_dir}/{table}"
        if not any("=" in name for name in store.names(self.spark, f"{root}/write={write_id}")):
            return no_rows(self.spark, FILE)
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(f"{root}/write={write_id}")
        folders = [name for name in ("route", "source_name", "posted_period") if name in schema.fieldNames()]
        at = F.col(moment) if moment else F.lit(None)
        # The path Spark tells is percent-encoded once more than the folder names are.
        inside = F.element_at(F.split("file_path", f"/write={write_id}/"), -1)
        named = F.url_decode(F.replace(inside, F.lit("+"), F.lit("%2B")))
        made = (
            rows.select(at.alias("at"), *folders, "_metadata.file_path", "_metadata.file_size")
            .groupBy("file_path", "file_size", *folders)
            .agg(F.count(F.lit(1)).alias("row_count"), F.min("at").alias("least"), F.max("at").alias("greatest"))
            .withColumn("path", F.concat(F.lit(f"write={write_id}/"), named))
            .withColumn("byte_count", F.col("file_size"))
            .withColumn("write_id", F.lit(write_id))
            .withColumn("load_run_id", F.lit(load_run_id))
            .withColumn("version", F.lit(version))
        )
        there = set(made.columns)
        return made.select(
            [(F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in FILE]
        )

    def store_manifest(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.coalesce(1).write.parquet(f"{self.log}/manifests/{name}")
        return name

    def commit(self, start: Version, tables: dict[str, DataFrame], layers: dict[str, dict[str, Any]] | None = None) -> Version:
        """Make changes visible in one step: new manifests of some tables, and what layers hold from now on.

        If commits of other writers came first and changed none of these tables, this one follows them; otherwise it was
        worked out from what is no longer there, and ``ConcurrentChange`` is raised.
        """
        stored = {table: self.store_manifest(rows) for table, rows in tables.items()}
        seen = start
        while True:
            new = replace(
                seen, number=seen.number + 1, tables={**seen.tables, **stored}, layers={**seen.layers, **(layers or {})}
            )
            try:
                store.create_text(self.spark, self._version_path(new.number), new.text())
                return new
            except store.AlreadyThere as error:
                seen = self.newest()
                if any(seen.tables.get(table) != start.tables.get(table) for table in tables):
                    raise ConcurrentChange(f"another writer changed {sorted(tables)} in version {seen.number}") from error
