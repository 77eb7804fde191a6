"""Releases of a partitioned dataset: all partitions of a run become visible at once, and no data file is touched.

Every run is staged in a directory of its own. A release is a manifest, one small file that names the directory of each
partition: the partitions of the run point to the run, all others to where they pointed before. It is there or it is not,
so readers see all of a run or nothing of it, whatever the number of partitions, and the directories of earlier releases
stay as they are.

In the catalog a release is an external table whose partitions have the manifest's locations, and the dataset's name is a
view of the newest one, replaced in a single step. Only directory names and the manifest are read for that.

Layout below the base path: ``runs/<run>/<partition directories>`` and ``releases/version=<n>/<one file>``. Two writers that
publish at the same moment may both write one version; reading it then raises instead of taking either.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.sources.catalog import add_partitions, create_fact_table, recover_partitions
from fareloom.sources.periods import Period
from fareloom.sources.publishing import DAY_PARTITIONS, stage

MANIFEST = "partition string, location string, writer string, version long"


class ReleaseConflict(Exception):
    """Two writers published the same version."""


def _values(directory: str) -> dict[str, str]:
    """Partition values of a directory like ``year=2024/month=06``, unescaped."""
    return {key: unquote(value) for key, _, value in (part.partition("=") for part in directory.split("/"))}


@dataclass(frozen=True)
class Releases:
    """A dataset published in releases: its catalog name, base path and contract."""

    name: str
    base: str
    contract: StructType
    partition_by: Sequence[str] = DAY_PARTITIONS

    @property
    def _manifests(self) -> str:
        return f"{self.base.rstrip('/')}/releases"

    def table_of(self, version: int) -> str:
        return f"{self.name}__v{version}"

    def new_run(self) -> str:
        """Path for the next run; nothing else ever writes there."""
        return f"{self.base.rstrip('/')}/runs/{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, max_records_per_file: int = 0) -> str:
        """Write a run and return its path. Until it is published no reader knows of it."""
        run = self.new_run()
        stage(df, run, self.partition_by, max_records_per_file)
        return run

    def manifests(self, spark: SparkSession) -> DataFrame:
        """``partition, location, writer, version`` of all releases."""
        try:
            return spark.read.schema(MANIFEST).parquet(self._manifests)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], MANIFEST)

    def newest(self, spark: SparkSession) -> int:
        """Newest version, 0 before the first."""
        return self.manifests(spark).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def locations(self, spark: SparkSession, version: int) -> dict[str, str]:
        """Directory of each partition in a release: as many entries as the dataset has partitions."""
        rows = self.manifests(spark).where(F.col("version") == version).collect()
        if len({row.writer for row in rows}) > 1:
            raise ReleaseConflict(f"{self.name}: version {version} was written twice; remove one of its files")
        return {row.partition: row.location for row in rows}

    def partitions_of_run(self, spark: SparkSession, run: str) -> list[str]:
        """Partition directories of a run, by directory names alone."""
        table = f"run_{uuid.uuid4().hex}"
        create_fact_table(spark, table, self.contract, self.partition_by, run)
        try:
            recover_partitions(spark, table)
            return [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        finally:
            spark.sql(f"DROP TABLE {table}")

    def publish(self, spark: SparkSession, run: str, period: Period | None = None) -> int:
        """Make the partitions of a run current, all at once; every other partition stays. Returns the new version.

        With a period, only that month's partitions of the run are taken.
        """
        staged = self.partitions_of_run(spark, run)
        if period:
            wanted = (int(period.year), int(period.month))
            staged = [p for p in staged if (int(_values(p)["year"]), int(_values(p)["month"])) == wanted]
        version = self.newest(spark)
        now = {**self.locations(spark, version), **{p: f"{run}/{p}" for p in staged}}
        version, writer = version + 1, uuid.uuid4().hex
        rows = [(partition, location, writer) for partition, location in sorted(now.items())]
        manifest = spark.createDataFrame(rows, "partition string, location string, writer string").coalesce(1)
        manifest.write.mode("error").parquet(f"{self._manifests}/version={version}")
        self.point(spark, version)
        return version

    def point(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Let the dataset's name show a release, by default the newest: after a publish, in a new session, or to go
        back to an earlier one."""
        version = self.newest(spark) if version is None else version
        locations = self.locations(spark, version)
        if not locations:
            raise ValueError(f"{self.name} has no release {version}")
        table = self.table_of(version)
        create_fact_table(spark, table, self.contract, self.partition_by, f"{self._manifests}/none")
        add_partitions(spark, table, [(_values(partition), location) for partition, location in locations.items()])
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {table}")
        return spark.table(self.name)

    def unused_runs(self, spark: SparkSession, keep: int) -> list[str]:
        """Runs that only releases older than the newest ``keep`` refer to; their directories may be removed."""
        rows = self.manifests(spark).select("location", "version").distinct().collect()
        runs = {(row.location[: row.location.index("/", row.location.rindex("/runs/") + 6)], row.version) for row in rows}
        newest = max((version for _, version in runs), default=0)
        used = {run for run, version in runs if version > newest - keep}
        return sorted({run for run, _ in runs} - used)
