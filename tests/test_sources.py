import os
import tempfile

import pytest
from pyspark.sql import types as T

from sparkdeck.sources import (clean_names, count_lines, create_table, list_tables, read_csv,
                               read_delimited, write_csv)


def test_create_table_requires_overwrite(spark):
    create_table(spark, [(1, "a")], "t_once", schema="k int, v string", overwrite=True)
    with pytest.raises(Exception):
        create_table(spark, [(2, "b")], "t_once", schema="k int, v string")
    assert "t_once" in list_tables(spark)


def test_clean_names_unique(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Sepal.Length", "Sepal Length", "Children's"])
    assert clean_names(df).columns == ["Sepal_Length", "Sepal_Length_1", "Children_s"]


def test_csv_roundtrip_and_quote_off(spark):
    d = tempfile.mkdtemp(prefix="sparkdeck-test-")
    df = spark.createDataFrame([(1, 'say "hi"', None), (2, "it's", 2.5)], "k int, t string, x double")
    write_csv(df.coalesce(1), f"{d}/out")
    assert count_lines(spark, f"{d}/out") == 3
    assert read_csv(spark, f"{d}/out").count() == 2
    p = os.path.join(d, "pipe.txt")
    with open(p, "w") as f:
        f.write('1|Toy "Story"|x\n2|It\'s|y\n')
    sch = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                        T.StructField("c", T.StringType())])
    rows = read_delimited(spark, p, sch, sep="|", quote="").collect()
    assert rows[0].b == 'Toy "Story"' and rows[1].b == "It's"


def test_movies_reader_and_year_rule(spark, tmp_path):
    """Synthetic movie rows: quotes in titles, empty release dates, genre flags."""
    from pyspark.sql import functions as F

    from sparkdeck.functions.scalars import year_from_text
    from sparkdeck.sources.movielens import GENRES, read_movies
    flags = lambda *on: "|".join("1" if g in on else "0" for g in GENRES)
    rows = [
        f"1|Toy Story (1995)|01-Jan-1995||http://x|{flags('Animation', 'Comedy')}",
        f"2|Don't Look \"Now\" (1973)|16-Oct-1973||http://y|{flags('Thriller')}",
        f"3|Unknown (????)|||http://z|{flags('unknown')}",
    ]
    p = tmp_path / "u.item"
    p.write_text("\n".join(rows) + "\n", encoding="latin-1")
    m = read_movies(spark, str(p))
    assert m.count() == 3 and len(m.columns) == 24
    titles = [r.movie_title for r in m.orderBy("movie_id").collect()]
    assert titles[1] == 'Don\'t Look "Now" (1973)'
    assert [r.release_date for r in m.orderBy("movie_id").collect()][2] == ""
    y = m.withColumn("year", year_from_text("release_date"))
    got = {r.movie_id: r.year for r in y.collect()}
    assert got == {1: 1995, 2: 1973, 3: 1900}
    ages = sorted(r.age for r in y.filter(F.col("year") != 1900).select((F.lit(1998) - F.col("year")).alias("age"))
                  .collect())
    assert ages == [3, 25]
    assert m.agg(F.sum("Comedy"), F.sum("Thriller")).first() == (1, 1)


def test_rowwise_verbs_apply_to_a_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    from sparkdeck.functions.scalars import indicator, safe_divide
    path = "/root/testdata/sf0.001"
    schema = spark.read.parquet(f"{path}/events.parquet").schema

    def verbs(df):
        return (df.filter(F.col("value").isNotNull() & (F.col("event_type") != "error"))
                .select("event_id", indicator("event_type", "click").alias("is_click"),
                        safe_divide("value", F.lit(0.0)).alias("ratio")))

    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(path)
    q = (verbs(stream).writeStream.format("memory").queryName("events_stream_out")
         .option("checkpointLocation", str(tmp_path / "ckpt")).outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(map(tuple, spark.table("events_stream_out").collect()))
    exp = sorted(map(tuple, verbs(spark.read.parquet(f"{path}/events.parquet")).collect()))
    assert got == exp and len(got) > 0
