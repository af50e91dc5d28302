"""Written intermediate results of an operator, given back as soon as nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import remove, scratch_path


class Steps:
    """Writes steps to the shared folder and drops those that are done.

    After each step the driver collects its garbage, because Spark removes the shuffle
    files of finished plans only then; on a large input they would pile up until the
    end. A dropped step is never read again: whatever came from it is on file itself.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str, done: tuple[DataFrame, ...] = ()) -> DataFrame:
        """The written rows of ``df``, which was the last to read the frames in ``done``."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        for frame in done:
            remove(self.spark, self.paths.pop(id(frame)))
        self.spark.sparkContext._jvm.System.gc()
        return out
