"""Loader-side transforms: tag lists per movie and search documents
(A1, J1, P1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine import schemas

SEARCH_DOC_COLUMNS = schemas.MOVIE_FIELDS + ["tags"]


def tags_by_movie(tags: DataFrame) -> DataFrame:
    """(mid, tags): distinct tags of a movie, sorted, joined by '|'.
    Duplicates go first, by (mid, tag) and so across tasks: a movie with a
    huge number of tag rows only brings its distinct tags to one task."""
    return tags.select("mid", "tag").dropDuplicates().groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_list("tag"))).alias("tags"))


def search_documents(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movies left-joined with their tag list; untagged movies keep
    ``tags = null``."""
    return movies.join(tags_by_movie(tags), "mid", "left").select(*SEARCH_DOC_COLUMNS)
