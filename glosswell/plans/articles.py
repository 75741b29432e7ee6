"""Most commented articles per tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.functions.text import ranking_lines
from glosswell.functions.times import hours
from glosswell.operators.counts import start_rows, window_count
from glosswell.operators.ranking import top_k

TOP_ARTICLES = 3
WINDOW_HOURS = (1, 24, 168)


def article_counts(comments: DataFrame, window_hours: int) -> DataFrame:
    """Comments of every depth per article and window: ``window, article_id, n``."""
    return window_count(comments, "create_date", hours(window_hours), "article_id")


def rank_articles(counts: DataFrame) -> DataFrame:
    """The three articles with most comments: ``window_start, rank, article_id, n``."""
    ranked = top_k(start_rows(counts), TOP_ARTICLES, F.desc("n"), F.asc("article_id"))
    return ranked.select("window_start", "rank", "article_id", "n")


def article_top3(comments: DataFrame, window_hours: int) -> DataFrame:
    return rank_articles(article_counts(comments, window_hours))


def count_lines(counts: DataFrame) -> DataFrame:
    """Result lines out of the counts."""
    return ranking_lines(rank_articles(counts), F.col("article_id"), F.col("n"))


def article_top3_lines(comments: DataFrame, window_hours: int) -> DataFrame:
    return count_lines(article_counts(comments, window_hours))
