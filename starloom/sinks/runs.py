"""A warehouse of files: a run's rows go to a place of its own, and one mark makes them visible."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class FileWarehouse:
    """Tables as Parquet below ``base``, one folder a run.

    What a broken attempt leaves is never read, and the next attempt of its run replaces it. Within
    an attempt Spark's committer takes one output of each task, however often it was run.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self._spark, self._base = spark, base.rstrip("/")

    def run_folder(self, table: str, run_id: str) -> str:
        """Where a run puts its rows."""
        return f"{self._base}/{table}/rows/{run_id}"

    def _marks(self, table: str) -> str:
        return f"{self._base}/{table}/loaded"

    def runs(self, table: str) -> list[str]:
        """The runs that were loaded to the end."""
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(self._marks(table))
        files = folder.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(folder))

    def append(self, table: str, df: DataFrame, run_id: str) -> None:
        """Add the rows of a run; a run that is loaded already adds nothing."""
        if run_id in self.runs(table):
            return
        df.write.mode("overwrite").parquet(self.run_folder(table, run_id))
        mark = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._marks(table)}/{run_id}")
        mark.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(mark, True).close()

    def read(self, table: str) -> DataFrame | None:
        """The rows of all loaded runs; None if there is none."""
        runs = self.runs(table)
        return self._spark.read.parquet(*[self.run_folder(table, run) for run in runs]) if runs else None
