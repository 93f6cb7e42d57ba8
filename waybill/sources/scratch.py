"""Intermediate results written to the shared folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from waybill.session import shared_folder


#: Codec of stored tables and of what is stored on the way to them: two thirds of the bytes of Spark's default in the same time.
CODEC = "zstd"


class Scratch:
    """A folder of its own for intermediate results, in the session's codec unless another is named."""

    def __init__(self, spark: SparkSession, codec: str | None = None) -> None:
        self.spark = spark
        self.options = {"compression": codec} if codec else {}
        self.path = f"{shared_folder(spark)}/waybill/{uuid.uuid4().hex}"
        self._written = 0
        self._paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        """Write a result that several later steps read, and read it back.

        With `by` the files are partitioned by these columns, which come last. Readers then prune columns and push filters into it, and a lost executor costs a re-read
        of files instead of the whole lineage.
        """
        self._written += 1
        path = self._paths[name] = f"{self.path}/{self._written:03d}-{name}"
        df.write.options(**self.options).partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, name: str) -> None:
        """Delete what was last written under a name; nothing may read it any more."""
        self._delete(self._paths.pop(name))

    def drop(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(
            folder, True
        )


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Intermediate results that are no longer needed once the block ends."""
    space = Scratch(spark, CODEC)
    try:
        yield space
    finally:
        space.drop()


_lasting: dict[str, Scratch] = {}


def _drop_if_running(space: Scratch) -> None:
    if space.spark.sparkContext._jsc is not None:
        space.drop()


def lasting(spark: SparkSession) -> Scratch:
    """The folder for results that a caller reads later; it goes when the program ends."""
    app = spark.sparkContext.applicationId
    if app not in _lasting:
        _lasting[app] = Scratch(spark, CODEC)
        atexit.register(_drop_if_running, _lasting[app])
    return _lasting[app]


def staged(df: DataFrame, name: str, space: Scratch | None = None) -> DataFrame:
    """One intermediate result: in the caller's folder, or in one that lasts as long as the program."""
    return (space or lasting(df.sparkSession)).write(df, name)
