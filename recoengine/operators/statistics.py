"""Batch statistics over ratings: popularity, monthly popularity,
average score and per-genre top-N (A2-A5, J2, J3, F1, T1-T3, C5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.functions.scalar import year_month
from recoengine.operators.topn import nest, top_n_per_group

# The genre list of the statistics job, verbatim and in its
# original order, including the misspelt "Ccrime" (so crime never matches)
# and the short forms that match by substring ("Music", "Science", "Tv").
GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Ccrime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]

# Fixed value: list length per genre.
TOP_N_GENRE = 10

def rate_more(ratings: DataFrame, sort: bool = True) -> DataFrame:
    """(mid, count): ratings per movie, most rated first (ties: mid)."""
    out = ratings.groupBy("mid").agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), F.asc("mid")) if sort else out


def rate_more_recently(ratings: DataFrame, sort: bool = True) -> DataFrame:
    """(mid, count, yearmonth): ratings per movie and calendar month (UTC),
    newest month first, then most rated."""
    ym = ratings.select("mid", year_month("timestamp").alias("yearmonth"))
    out = ym.groupBy("mid", "yearmonth").agg(F.count(F.lit(1)).alias("count")) \
        .select("mid", "count", "yearmonth")
    return out.orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("mid")) if sort else out


def average_scores(ratings: DataFrame) -> DataFrame:
    """(mid, avg): mean score per rated movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def monthly_totals(ratings: DataFrame) -> DataFrame:
    """(mid, yearmonth, count, total): what all rating statistics sum up."""
    return ratings.groupBy("mid", year_month("timestamp").alias("yearmonth")).agg(
        F.count(F.lit(1)).alias("count"), F.count("score").alias("scored"), F.sum("score").alias("total"))


def rate_more_from_totals(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("mid").agg(F.sum("count").alias("count"))


def average_from_totals(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("mid").agg((F.sum("total") / F.sum("scored")).alias("avg"))


def genre_top_n_flat(movies: DataFrame, avg_scores: DataFrame, genres: Sequence[str] = GENRES,
                     n: int = TOP_N_GENRE) -> DataFrame:
    """(genres, rank, mid, avg): best-rated movies per genre.

    A movie belongs to a genre when its lower-cased genre string contains
    the lower-cased genre name; unrated movies and null genres drop out. The
    genre list is a literal that each movie row filters and explodes: no join.
    """
    names = F.array(*[F.lit(g) for g in genres]) if genres else F.array().cast("array<string>")
    mine = F.filter(names, lambda g: F.contains(F.lower("genres"), F.lower(g)))
    matched = movies.select("mid", F.explode(mine).alias("genre")) \
        .join(avg_scores.select("mid", "avg"), "mid").select(F.col("genre").alias("genres"), "mid", "avg")
    return top_n_per_group(matched, ["genres"], [F.desc("avg"), F.asc("mid")], n) \
        .select("genres", "rank", "mid", "avg")


def genre_top_n(movies: DataFrame, avg_scores: DataFrame, genres: Sequence[str] = GENRES,
                n: int = TOP_N_GENRE) -> DataFrame:
    """(genres, recs array<struct<mid, r>>) as stored by the statistics job."""
    flat = genre_top_n_flat(movies, avg_scores, genres, n)
    return nest(flat, ["genres"], "rank", "mid", "avg")


# ------------------------------------------------------------ SQL text ---
# The statistics as SQL statements over the ratings frame. ``{ratings}`` is
# bound to the DataFrame by ``spark.sql``, so no temp view of the user's is
# touched; months come from the SQL function ``changeDate``.

POPULAR_SQL = """
SELECT mid, count(*) AS count
FROM {ratings}
GROUP BY mid
ORDER BY count DESC, mid"""

MONTHLY_SQL = """
SELECT mid, count(*) AS count, changeDate(timestamp) AS yearmonth
FROM {ratings}
GROUP BY mid, yearmonth
ORDER BY yearmonth DESC, count DESC, mid"""

MEAN_SQL = """
SELECT mid, avg(score) AS avg
FROM {ratings}
GROUP BY mid"""

MONTH_SQL = "SELECT mid, uid, score, changeDate(timestamp) AS yearmonth FROM {ratings}"


def run_sql(statement: str, ratings: DataFrame) -> DataFrame:
    from recoengine.functions.scalar import register_sql_functions
    register_sql_functions(ratings.sparkSession)
    return ratings.sparkSession.sql(statement, ratings=ratings)


def rate_more_sql(ratings: DataFrame) -> DataFrame:
    return run_sql(POPULAR_SQL, ratings)


def rate_more_recently_sql(ratings: DataFrame) -> DataFrame:
    return run_sql(MONTHLY_SQL, ratings)


def average_scores_sql(ratings: DataFrame) -> DataFrame:
    return run_sql(MEAN_SQL, ratings)
