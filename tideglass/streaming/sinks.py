"""Sinks of streams: changelogs, upserts, partitioned events, quarantine; and runs over what is available."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideglass.functions.scalars import md5_partition
from tideglass.session import shared_folder


def checkpoint_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tideglass/stream-{uuid.uuid4().hex}"


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "update", checkpoint: str | None = None) -> None:
    """Runs a stream over all that is available now, each batch through sink(rows, batch id)."""
    place = checkpoint or checkpoint_folder(stream.sparkSession)
    q = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", place).foreachBatch(sink).start()
    q.awaitTermination()


def run_every(stream: DataFrame, sink: Callable[[DataFrame, int], None], interval: str, mode: str = "update", checkpoint: str | None = None):
    """Starts a stream that takes a batch every `interval` of the clock (such as `5 seconds`); returns the running query."""
    place = checkpoint or checkpoint_folder(stream.sparkSession)
    return stream.writeStream.outputMode(mode).trigger(processingTime=interval).option("checkpointLocation", place).foreachBatch(sink).start()


def to_table(stream: DataFrame, mode: str = "update", checkpoint: str | None = None) -> DataFrame:
    """The rows that a stream emits over all that is available, with the number of their batch, as a table.

    A batch that is run again after a failure replaces its own folder."""
    spark = stream.sparkSession
    path = f"{shared_folder(spark)}/tideglass/rows-{uuid.uuid4().hex}"

    def sink(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    run_available(stream, sink, mode, checkpoint)
    empty = spark.createDataFrame([], stream.schema)
    empty.write.mode("overwrite").parquet(f"{path}/batch=-1")
    return spark.read.parquet(path)


def changelog_files(path: str, kind: str = "json") -> Callable[[DataFrame, int], None]:
    """Appends rows (with time and diff) as CSV or JSON lines."""

    def sink(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").format(kind).options(header=True).save(f"{path}/batch={batch}")

    return sink


class UpsertTable:
    """A keyed table that batches are written over: the row of each key that is greatest by `order` wins, of equal ones the later.

    Keys fall into `buckets`; a batch rewrites only the buckets that it touches, into its own folder, and then commits a small manifest of
    where each bucket stands by one rename. A new object on the same path goes on from the last manifest; a batch that was committed
    is not applied again, and what an unfinished batch left is overwritten."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: str, buckets: int = 16):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path, key, order, buckets

    def _hadoop(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self) -> tuple[int, dict[int, int]]:
        """(last batch, the batch that wrote each bucket); -1 and none for a new table."""
        folder, fs = self._hadoop("manifest")
        names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
        last = max((int(n) for n in names if n.isdigit()), default=-1)
        if last < 0:
            return last, {}
        text = self.spark.read.text(f"{self.path}/manifest/{last}").first()[0]
        return last, {int(k): v for k, v in json.loads(text).items()}

    def _commit(self, batch: int, at: dict[int, int]) -> None:
        draft, fs = self._hadoop(f"manifest/_{batch}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(at).encode()))
        out.close()
        fs.rename(draft, self._hadoop(f"manifest/{batch}")[0])

    def _folders(self, at: dict[int, int]) -> list[str]:
        return [f"{self.path}/batch={b}/bucket={k}" for k, b in sorted(at.items())]

    def __call__(self, rows: DataFrame, batch: int) -> None:
        last, at = self.committed()
        if batch <= last:
            return
        new = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")).persist()
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if touched:
            old = self._folders({k: at[k] for k in touched if k in at})
            base = self.spark.read.schema(rows.schema).parquet(*old) if old else rows.limit(0)
            back = Window.partitionBy(*self.key).orderBy(F.desc_nulls_last(self.order), F.desc("__new"))
            both = base.withColumn("__new", F.lit(0)).unionByName(new.drop("bucket").withColumn("__new", F.lit(1)))
            both = both.withColumn("__r", F.row_number().over(back)).where(F.col("__r") == 1).drop("__r", "__new")
            both = both.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))
            both.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={batch}")
        new.unpersist()
        self._commit(batch, at | dict.fromkeys(touched, batch))

    def read(self, schema=None) -> DataFrame:
        """The table as of the last commit; one that has no rows yet needs a schema."""
        folders = self._folders(self.committed()[1])
        return self.spark.read.parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def event_files(path: str) -> Callable[[DataFrame, int], None]:
    """JSON below day, hour and symbol of event_time."""

    def sink(rows: DataFrame, batch: int) -> None:
        at = rows.withColumns({"day": F.date_format("event_time", "yyyyMMdd"), "hour": F.date_format("event_time", "HH"), "key": F.col("symbol")})
        at.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("day", "hour", "key").json(path)

    return sink


def symbol_files(path: str) -> Callable[[DataFrame, int], None]:
    """CSV with a header, a folder for each symbol, to which every batch adds its files."""

    def sink(rows: DataFrame, batch: int) -> None:
        rows.withColumn("key", F.col("symbol")).write.mode("append").partitionBy("key").option("header", True).csv(path)

    return sink


def kafka_rows(rows: DataFrame, topic: str, parts: int = 3) -> DataFrame:
    """key, value, partition, topic as Spark's Kafka sink takes them; the partition is md5 of the symbol."""
    return rows.select(F.col("symbol").alias("key"), F.to_json(F.struct("*")).alias("value"), md5_partition(F.col("symbol"), parts).alias("partition"), F.lit(topic).alias("topic"))
