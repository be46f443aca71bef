"""Table access with fallbacks."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripstream.schema import TRIP_SCHEMA
from tripstream.sinks.snapshot_table import SnapshotTable


class TableService:
    """Read the trip table by catalog name, else by path, else empty."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark = spark
        self.name = name
        self.path = path

    @property
    def table(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path)

    def get_table(self) -> DataFrame:
        """Catalog name -> path -> empty frame with the 13 columns."""
        try:
            if self.spark.catalog.tableExists(self.name):
                return self.spark.table(self.name)
        except AnalysisException as e:
            warnings.warn(f"catalog read of {self.name} failed: {e}")
        try:
            if self.table.exists():
                return self.table.current()
        except AnalysisException as e:
            warnings.warn(f"path read of {self.path} failed: {e}")
        return self.spark.createDataFrame([], TRIP_SCHEMA)

    def register(self) -> bool:
        """K6 + K7: make the namespace and point the catalog name at the table."""
        parts = self.name.split(".")
        if len(parts) > 1:
            try:
                self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {'.'.join(parts[:-1])}")
            except AnalysisException as e:
                warnings.warn(f"could not create namespace for {self.name}: {e}")
        return self.table.register(self.name)

    def execute_query(self, sql: str) -> DataFrame:
        """Run SQL; ``{table}`` in it stands for the table (S5). When a table
        is missing from the catalog, run the same SQL again with the table
        bound under the missing name, ``name`` or ``namespace.name``.

        Other errors are raised: the text is never rewritten (D7). A name in a
        catalog that Spark does not have cannot be bound; use ``{table}``.
        """
        frames = {"table": self.get_table()} if "{table}" in sql else {}
        try:
            return self.spark.sql(sql, **frames)
        except AnalysisException as e:
            cond = getattr(e, "getCondition", lambda: None)() or ""
            if "TABLE_OR_VIEW_NOT_FOUND" not in cond:
                raise
            missing = [p for p in (e.getMessageParameters() or {}).get("relationName", "").replace("`", "").split(".") if p]
            if missing and missing[0] == "spark_catalog":
                missing = missing[1:]
            if not 1 <= len(missing) <= 2:
                raise
            if len(missing) == 1:
                self.get_table().createOrReplaceTempView(missing[0])
            else:
                self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{missing[0]}`")
                if not self.table.register(".".join(f"`{p}`" for p in missing)):
                    raise
            return self.spark.sql(sql, **frames)

    def describe(self) -> DataFrame:
        """``col_name, data_type, partition_key`` of the existing table as it is:
        the columns of the catalog name (else of the files at the path), and the
        partition fields, last. A table that is not there only warns: no rows."""
        columns, fields = [], []
        try:
            if self.spark.catalog.tableExists(self.name):
                schema = self.spark.table(self.name).schema
                keys = {c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition}
                columns = [(f.name, f.dataType.simpleString(), f.name in keys) for f in schema]
            if self.table.exists():
                stored = self.spark.read.parquet(self.table.data_path).schema
                fields = [(f.name, f.dataType.simpleString(), True) for f in stored if f.name in self.table.partition_fields()]
                columns = columns or [(f.name, f.dataType.simpleString(), False) for f in stored
                                      if f.name not in self.table.partition_fields()]
        except AnalysisException as e:
            warnings.warn(f"describe of {self.name} failed: {e}")
        if not columns:
            warnings.warn(f"no table {self.name} and none at {self.path}")
        rows = sorted(columns, key=lambda c: c[2]) + [f for f in fields if f[0] not in {c[0] for c in columns}]
        return self.spark.createDataFrame(rows, "col_name string, data_type string, partition_key boolean")


def list_namespaces(spark: SparkSession) -> DataFrame:
    """K8: ``SHOW NAMESPACES``."""
    return spark.sql("SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str = "default") -> DataFrame:
    """K8: ``SHOW TABLES IN namespace``."""
    return spark.sql(f"SHOW TABLES IN {namespace}")
