"""Views over the driver's generated tables (see FIXTURES.md section 2).

These are the inputs every registered query builds on: ratings from
lineitem x orders, movies from part, tags and rating events from events,
factor tables from embeddings. Only column expressions and one equi-join;
scans are pruned to the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.functions.scalar import epoch_seconds

# The 22 genre labels assigned to fixture movies, in order
# (1-based position = p_partkey % 22 + 1 and p_size % 22 + 1).
FIXTURE_GENRE_LABELS = [
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Family", "Fantasy", "Foreign", "History",
    "Horror", "Musical", "Mystery", "Romance", "Science Fiction", "TV Movie",
    "Thriller", "War", "Western", "Film-Noir",
]

# Halves of an embedding (1-based, inclusive) that stand for item and user
# factors in products; similarity takes whole embeddings, whose cosines are
# lower than those of trained factors, hence the lower threshold.
ITEM_DIMS = (1, 32)
USER_DIMS = (33, 64)
SIMILAR_ABOVE = 0.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, mid, score (0.5..5.0 step 0.5), timestamp (epoch seconds)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ship_t = li.schema["l_shipdate"].dataType
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .select(
            F.col("o_custkey").cast("int").alias("uid"),
            F.col("l_partkey").cast("int").alias("mid"),
            (((F.col("l_quantity").cast("int") + F.col("l_linenumber")) % 10 + 1) / F.lit(2.0))
            .cast("double").alias("score"),
            epoch_seconds("l_shipdate", ship_t).cast("long").alias("timestamp"),
        )
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.array(*[F.lit(x) for x in FIXTURE_GENRE_LABELS])
    n = len(FIXTURE_GENRE_LABELS)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand", "p_type")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.lit("").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.lit("").alias("issue"),
        F.lit("1995").alias("shoot"),
        F.lit("English").alias("language"),
        F.concat(
            F.element_at(g, (F.col("p_partkey") % n + 1).cast("int")),
            F.lit("|"),
            F.element_at(g, (F.col("p_size") % n + 1).cast("int")),
        ).alias("genres"),
        F.col("p_brand").alias("actors"),
        F.col("p_type").alias("directors"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select("user_id", "props", "event_type", "ts")
    ts_t = ev.schema["ts"].dataType
    return ev.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts", ts_t).cast("long").alias("timestamp"),
    )


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, uid, mid, score, ts, epoch, event_type - one row per event."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "props", "value", "ts", "event_type")
    ts_t = ev.schema["ts"].dataType
    return ev.select(
        "event_id",
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        ((F.floor("value").cast("int") % 10 + 1) / F.lit(2.0)).cast("double").alias("score"),
        "ts",
        epoch_seconds("ts", ts_t).cast("long").alias("timestamp"),
        "event_type",
    )


def _factor_slice(spark: SparkSession, sf_dir: str, dims: tuple[int, int]) -> DataFrame:
    lo, hi = dims
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"),
        F.slice("embedding", lo, hi - lo + 1).alias("features"),
    )


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_slice(spark, sf_dir, ITEM_DIMS)


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_slice(spark, sf_dir, USER_DIMS)


def similarity_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items a user already rated, as seen by the stream: 'view' events."""
    return rating_events(spark, sf_dir).where(F.col("event_type") == "view").select("uid", "mid")


def recent_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating log the recent lists are drawn from: 'click' events."""
    return rating_events(spark, sf_dir).where(F.col("event_type") == "click")


def stream_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming ratings: 'purchase' events."""
    return rating_events(spark, sf_dir).where(F.col("event_type") == "purchase")
