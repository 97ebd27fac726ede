"""The registered queries of this package and the SQL that they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.llm.block_search import nearest
from massloom.llm.common import table
from massloom.llm.context_mix import lm_scores
from massloom.llm.decontaminate import find_leaks
from massloom.llm.fill_middle import middle_digest
from massloom.llm.license_scan import license_scan
from massloom.llm.ngram_join import near_duplicates
from massloom.llm.oracles import SQL
from massloom.llm.plane_clusters import clusters
from massloom.llm.quality import classify
from massloom.llm.secret_scan import secret_digest
from massloom.llm.slice_search import top_products
from massloom.llm.source_mix import mix_digest
from massloom.llm.url_filter import filter_urls
from massloom.llm.warc import archive_round_trip


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A document's place is source/language/hundred of its id; one that opens with a notice grants it
    to its directory."""
    hundred = F.floor(F.col("doc_id") / 100).cast("string")
    path = F.concat_ws("/", "source", "lang", hundred, F.col("doc_id").cast("string"))
    return license_scan(table(spark, folder, "documents"), path, opening_counts=True)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A source stands for the owner; its documents in one language for a repository."""
    repo = F.concat_ws("/", "source", "lang")
    return secret_digest(table(spark, folder, "documents"), repo=repo, owner=F.col("source"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages"))


def op4_block_search(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_context_mix(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages")).drop("url")


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=4, num=85, den=100)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_digest(table(spark, folder, "documents"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle_digest(table(spark, folder, "documents"))


def op12_slice_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_plane_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters(table(spark, folder, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_secret_scan, op3_url_filter, op4_block_search, op5_context_mix, op6_warc, op7_ngram_join, op8_decontaminate,
    op9_quality, op10_source_mix, op11_fill_middle, op12_slice_search, op13_plane_clusters)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
