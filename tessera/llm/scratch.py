"""Tables of one run in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.session import work_path


class Scratch:
    """Writes tables that end the lineage, and drops those that nothing reads any more.

    A table may go as soon as all that was made from it is itself a table.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame) -> DataFrame:
        path = work_path(self.spark, "scratch")
        df.write.parquet(path)
        table = self.spark.read.parquet(path)
        self.paths[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove(self.spark, self.paths.pop(id(table))[1])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
