"""Explicit schemas and readers for the MovieLens 100k files.

The data licence forbids redistribution, so nothing here embeds rows; the
readers take a folder path supplied by the user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import read_delimited

# The 19 genre flags of the movie table, in file order.
GENRES = ["unknown", "Action", "Adventure", "Animation", "Children_s", "Comedy", "Crime",
          "Documentary", "Drama", "Fantasy", "Film_Noir", "Horror", "Musical", "Mystery",
          "Romance", "Sci_Fi", "Thriller", "War", "Western"]

USER_SCHEMA = T.StructType([
    T.StructField("UserID", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("Zip", T.StringType()),  # 18 of 943 zips are not numbers: keep text
])

MOVIE_SCHEMA = T.StructType(
    [T.StructField("movie_id", T.IntegerType()),
     T.StructField("movie_title", T.StringType()),
     T.StructField("release_date", T.StringType()),
     T.StructField("video_release_date", T.StringType()),
     T.StructField("IMDb_URL", T.StringType())]
    + [T.StructField(g, T.IntegerType()) for g in GENRES])

RATING_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])

GENRE_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.IntegerType())])
OCCUPATION_SCHEMA = T.StructType([T.StructField("name", T.StringType())])


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, USER_SCHEMA, sep="|", name="user")


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    # empty release dates stay "" so the year rule maps them to 1900, as in R
    return read_delimited(spark, path, MOVIE_SCHEMA, sep="|", quote="", name="movies", keep_empty=True)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings files are tab separated: user, item, rating, unix seconds."""
    return read_delimited(spark, path, RATING_SCHEMA, sep="\t", name="ratings")


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    # the file ends with a blank line, which PERMISSIVE mode turns into an all-NULL row
    return read_delimited(spark, path, GENRE_SCHEMA, sep="|").dropna(how="all")


def read_occupations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OCCUPATION_SCHEMA).text(path).toDF("name").filter("name <> ''")
