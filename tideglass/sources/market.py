"""Sources of the market and news streams, of pages and of maps, batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideglass.functions.scalars import pad_cik

TICK = "timestamp BIGINT, symbol STRING, price DOUBLE, volume BIGINT, bid DOUBLE, ask DOUBLE, high DOUBLE, low DOUBLE, open DOUBLE, partition INT, time BIGINT, diff INT"
TICK_CSV = "timestamp BIGINT, symbol STRING, price DOUBLE, volume BIGINT, bid DOUBLE, ask DOUBLE, high DOUBLE, low DOUBLE, open DOUBLE, time BIGINT, diff INT"
NEWS = "symbol STRING, title STRING, description STRING, url STRING, published_at STRING, source STRING, category STRING, time BIGINT, diff INT"


def kafka_json(spark: SparkSession, servers: str, topic: str, schema: str, group: str, **options: str) -> DataFrame:
    """A topic's JSON messages from the earliest offset on. Needs Spark's Kafka package on the class path."""
    raw = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "kafka.group.id": group} | options).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def json_lines(text: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): messages that parse to `schema`, and those that don't, for quarantine. Works on streams too."""
    read = text.withColumn("__m", F.from_json(column, f"{schema}, __bad STRING", {"columnNameOfCorruptRecord": "__bad"}))
    bad = F.col("__m").isNull() | F.col("__m.__bad").isNotNull()
    return read.where(~bad).select("__m.*").drop("__bad"), read.where(bad).select(column)


def csv_replay(spark: SparkSession, folder: str, schema: str = TICK_CSV, files_per_trigger: int = 1) -> DataFrame:
    """A folder of CSV files as a stream, some files at a time; pacing by the clock is left to the trigger."""
    return spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table, one file or many, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # As a pattern the path may be a single file as well as a folder.
    return reader.parquet(f"{folder}/{name}.parque[t]")


def replay_steps(rows: DataFrame, at: str, path: str, steps: int = 12, most: int = 1_000_000) -> str:
    """Writes rows below `path` in steps of arrival `at`, a file each, one after the other, so that a stream with one file per trigger
    takes them as so many batches in order of arrival. Rows of one arrival may fall into one step only; steps hold about `most` rows at the most."""
    n = rows.agg(F.count(at)).first()[0]
    steps = max(min(steps, n), -(-n // most), 1)
    found = rows.agg(F.percentile_approx(at, [i / steps for i in range(1, steps)], 10_000).alias("cuts")).first()["cuts"] if n and steps > 1 else []
    cuts = sorted(set(found or []))
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.where(F.col(at) > low)
        part = part if high is None else part.where(F.col(at) <= high)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def whole_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, ticker (the file's folder), text of whole files, such as `filings/*/*.html`."""
    path = F.input_file_name()
    return spark.read.text(pattern, wholetext=True).select(path.alias("path"), F.element_at(F.split(path, "/"), -2).alias("ticker"), F.col("value").alias("text"))


def transcripts(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Multi-line JSON files but for those whose names end in `_chunks.json`."""
    read = spark.read.schema(schema).json(pattern, multiLine=True).withColumn("path", F.input_file_name())
    return read.where(~F.col("path").endswith("_chunks.json"))


def cik_map(text: DataFrame, column: str) -> DataFrame:
    """ticker, cik from JSON in any of four shapes: a table of fields and data, a list of objects, an object of objects, or a list of
    pairs. Tickers are in upper case, cik has ten digits; rows without either are left out."""
    v = F.try_parse_json(column)
    get = lambda x, p: F.try_variant_get(x, p, "string")
    pick = lambda x: F.struct(F.coalesce(get(x, "$.ticker"), get(x, "$.symbol")).alias("ticker"), F.coalesce(get(x, "$.cik_str"), get(x, "$.cik")).alias("cik"))
    at = lambda fields, name: F.array_position(F.transform(fields, lambda f: F.lower(f)), name) - 1
    kinds = text.select(v.alias("v")).select(
        F.try_variant_get("v", "$.fields", "array<string>").alias("fields"), F.try_variant_get("v", "$.data", "array<array<string>>").alias("data"),
        F.try_variant_get("v", "$", "array<variant>").alias("items"), F.try_variant_get("v", "$", "map<string,variant>").alias("byname"),
    )
    tabled = F.transform("data", lambda r: F.struct(F.get(r, at(F.col("fields"), "ticker").cast("int")).alias("ticker"), F.get(r, at(F.col("fields"), "cik").cast("int")).alias("cik")))
    pair = lambda x: F.struct(F.try_variant_get(x, "$[0]", "string").alias("ticker"), F.try_variant_get(x, "$[1]", "string").alias("cik"))
    listed = F.transform("items", lambda x: F.when(F.schema_of_variant(x).startswith("ARRAY"), pair(x)).otherwise(pick(x)))
    rows = F.when(F.col("data").isNotNull(), tabled).when(F.col("items").isNotNull(), listed).otherwise(F.transform(F.map_values("byname"), pick))
    flat = kinds.select(F.explode(rows).alias("r")).select(F.upper(F.trim("r.ticker")).alias("ticker"), pad_cik(F.col("r.cik")).alias("cik"))
    return flat.where(F.col("ticker").isNotNull() & F.col("cik").isNotNull()).dropDuplicates(["ticker"])


def previous_quarter(day: Column) -> Column:
    """struct(year, quarter) of the last completed quarter before day."""
    before = F.add_months(F.trunc(day, "quarter"), -3)
    return F.struct(F.year(before).alias("year"), F.quarter(before).alias("quarter"))
