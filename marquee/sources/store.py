"""Tables kept as Parquet folders that can be replayed safely.

Two shapes: a *run* table holds one sub-folder per run, and rerunning a run replaces exactly
its own folder; a *snapshot* table holds numbered versions and readers take the highest.
Nothing is ever overwritten while it is being read: run tables that are rewritten in fewer files
get a new *generation*, one number for the whole store, which readers follow once it is published.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENERATIONS = "generations"
GENERATION = "number INT"


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    #: The generation to work in, if it is known.
    pinned: int | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        """The table, or an empty frame of that schema if nothing was written yet."""
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def exists(self, name: str) -> bool:
        """Whether something was written there, if only no rows."""
        try:
            self.spark.read.schema("id BIGINT").parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def clear(self, name: str) -> None:
        """Remove all rows below a folder; the folder stays, without files to list or read."""
        nothing = self.spark.createDataFrame([], "id BIGINT, part INT")
        writer = nothing.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("part").parquet(self.path(name))

    def generation(self) -> int:
        """The number of the published generation of run tables; 0 before any rewriting."""
        return self.snapshot(GENERATIONS, GENERATION)[1] if self.pinned is None else self.pinned

    def pin(self) -> Store:
        """This store in the generation of now, for a job that asks often."""
        return replace(self, pinned=self.generation())

    def publish_generation(self, number: int) -> None:
        """Make readers follow the run tables of generation ``number``, all at once."""
        row = self.spark.createDataFrame([(number,)], GENERATION)
        self.write_snapshot(row.coalesce(1), GENERATIONS, number)

    def write_run(self, df: DataFrame, name: str, run: str) -> None:
        """Write one run's rows; a repeated run replaces what it wrote before.

        Rows with a ``bucket`` go to a folder for each.
        """
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if "bucket" in df.columns:
            writer = writer.partitionBy("bucket")
        writer.parquet(f"{self.path(name)}/{run}")

    def snapshot(self, name: str, schema: T.StructType | str) -> tuple[DataFrame, int]:
        """(rows, version) of the latest snapshot; version 0 is the empty one."""
        versions = T.StructType([T.StructField("version", T.IntegerType())])
        stored = self.read(name, versions)
        latest = stored.agg(F.max("version")).head()[0] or 0
        if not latest:
            return self.spark.createDataFrame([], schema), 0
        return self.spark.read.schema(schema).parquet(f"{self.path(name)}/version={latest}"), latest

    def write_snapshot(self, df: DataFrame, name: str, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path(name)}/version={version}")
