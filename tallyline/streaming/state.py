"""What slices hold after each micro-batch, as versions in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.session import children, remove

#: Micro-batches after which everything is written as one version.
COMPACT = 20


class SliceState:
    """Values by key, as of each micro-batch.

    A batch writes the values of the keys it touched under its own number and reads only what earlier batches wrote, so
    it may run again at any time.  Every ``compact`` batches all values are written as one version.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, values: str, compact: int = COMPACT):
        self.spark, self.folder, self.compact = spark, folder, compact
        self.shape = f"{key}, {values}, version long"
        self.key = [c.split()[0] for c in key.split(", ")]
        self.values = [c.split()[0] for c in values.split(", ")]

    def versions(self) -> tuple[dict[int, str], dict[int, str]]:
        """Folders of whole versions and of single batches, by number."""
        found: tuple[dict[int, str], dict[int, str]] = {}, {}
        for name in children(self.spark, self.folder):
            kind, _, number = name.partition("=")
            found[kind == "batch"][int(number)] = f"{self.folder}/{name}"
        return found

    def before(self, number: int) -> DataFrame:
        """What stood before a batch; a key stands once for each version that has it."""
        whole, batches = self.versions()
        base = max((n for n in whole if n < number), default=-1)
        paths = [whole[base]] if base >= 0 else []
        paths += [path for n, path in batches.items() if base < n < number]
        if not paths:
            return self.spark.createDataFrame([], self.shape)
        return self.spark.read.schema(self.shape).parquet(*paths)

    def latest(self, versions: DataFrame) -> DataFrame:
        """One row for each key."""
        return versions.groupBy(*self.key).agg(*[F.max_by(c, "version").alias(c) for c in self.values])

    def all(self) -> DataFrame:
        """One row for each key, after all batches."""
        return self.latest(self.before(1 << 62))

    def write(self, values: DataFrame, number: int) -> None:
        def written(rows: DataFrame, kind: str) -> None:
            columns = [*self.key, *self.values, F.lit(number).cast("long").alias("version")]
            rows.select(*columns).write.mode("overwrite").parquet(f"{self.folder}/{kind}={number}")

        written(values, "batch")
        if number % self.compact == self.compact - 1:
            written(self.latest(self.before(number + 1)), "whole")

    def forget(self, number: int) -> None:
        """Remove what a batch of this number, and all after it, do not read."""
        whole, batches = self.versions()
        base = max((n for n in whole if n < number), default=-1)
        for n, path in whole.items():
            if n < base:
                remove(self.spark, path)
        for n, path in batches.items():
            if n <= base:
                remove(self.spark, path)
