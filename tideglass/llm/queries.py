"""Queries of the operators of this package (problems 6 and 8 to 10) and the SQL that they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.llm import encode, nearest, packing, residue
from tideglass.operators.ticks import clean_symbol, usable_ticks
from tideglass.operators.zones import normal_news
from tideglass.plans.core_queries import USABLE
from tideglass.plans.time_sql import NEWS_TIMES
from tideglass.session import materialise
from tideglass.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    news = normal_news(table(spark, folder, "news"), table(spark, folder, "news_sources"))
    left = news.select(clean_symbol(c("symbol")).alias("entity"), c("published_ms").alias("at"), c("news_id").alias("id"))
    right = usable_ticks(table(spark, folder, "ticks")).select(c("symbol").alias("entity"), c("event_ms").alias("at"), c("tick_id").alias("id"))
    return nearest.nearest_in_time(left, right).select(c("left_id").alias("news_id"), c("right_id").alias("tick_id"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode_documents(table(spark, folder, "documents"))


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Each document, or piece of one that is too long, with its container."""
    return packing.pack(encode.token_counts(table(spark, folder, "documents")))


def p9_load(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the containers: every document in them, none piece twice or missing, none over capacity, little unused space."""
    c = F.col
    pieces = materialise(p9_containers(spark, folder), "containers")
    items = pieces.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("kinds"), F.max("piece").alias("last"), F.sum("n_tokens").alias("tokens"), F.max(F.struct("piece", "first_token", "n_tokens")).alias("end"))
    broken = (c("n") != c("kinds")) | (c("last") + 1 != c("n")) | (c("end.first_token") + c("end.n_tokens") != c("tokens")) | ((c("n") > 1) & (c("tokens") <= packing.CAPACITY))
    whole = items.agg(F.count(F.lit(1)).alias("documents"), F.count_if(broken).alias("broken"))
    loads = pieces.groupBy("container_id").agg(F.sum("n_tokens").alias("load"))
    # A shard may leave its last container less than full.
    full = loads.agg(F.count_if(c("load") > packing.CAPACITY).alias("overfull"), (F.sum("load") >= 0.97 * packing.CAPACITY * (F.count(F.lit(1)) - 1)).alias("well_filled"))
    one = F.lit(1).alias("one")
    return whole.select("*", one).join(full.select("*", one), "one").drop("one")  # a row and a row


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue_scores(table(spark, folder, "documents")).where("is_residue").select("doc_id")


def p10_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without those that are residue."""
    return residue.without_residue(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p6_found, p8_ids, p9_containers, p9_load, p10_found, p10_corpus)}
ORACLE: dict[str, str] = {
    "p9_load": "SELECT count(*) AS documents, 0 AS broken, 0 AS overfull, true AS well_filled FROM documents",
    "p6_found": f"""WITH {NEWS_TIMES}, {USABLE}
SELECT news_id, tick_id FROM news_times AS n JOIN usable AS u ON u.sym = n.sym AND u.et BETWEEN n.ms - 300000 AND n.ms + 300000
QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY abs(et - ms), et, tick_id) = 1""",
}
