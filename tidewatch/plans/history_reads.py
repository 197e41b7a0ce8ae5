"""Reads of the historical tables, as the history page asks for them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordering import descending, top_k

# Rows shown.
LANGUAGES_SHOWN = 20
SERVERS_SHOWN = 15
CONTRIBUTORS_SHOWN = 50


def read_trends(hourly_trends: DataFrame) -> DataFrame:
    return hourly_trends.orderBy("hour_bucket")


def read_patterns(hourly_patterns: DataFrame) -> DataFrame:
    return hourly_patterns.orderBy("hour_bucket")


def read_languages(languages: DataFrame, shown: int = LANGUAGES_SHOWN) -> DataFrame:
    return languages.orderBy(*descending("edit_count", ["language", "project"])).limit(shown)


def read_servers(rankings: DataFrame, shown: int = SERVERS_SHOWN) -> DataFrame:
    return rankings.orderBy(F.col("rank")).limit(shown)


def read_contributors(contributors: DataFrame, shown: int = CONTRIBUTORS_SHOWN) -> DataFrame:
    return top_k(contributors, "edit_count", ["user", "is_bot"], shown)
