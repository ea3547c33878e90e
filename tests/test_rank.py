from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.rank import sliced_rank, top_ranked
from tests.helpers import plan, rows


def data(spark):
    """One group holds a third of all rows, NULL is a group too."""
    return spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).when(F.col("id") < 1010, F.lit(None)).otherwise(
            F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))
        ).alias("k"),
        F.hash("id").alias("s"), "id",
    )


def plain(df):
    return df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("s", "id")).cast("bigint"))


ORDER = ["s", "id"]


def test_sliced_rank_equals_a_window(spark):
    assert rows(sliced_rank(data(spark), ["k"], ORDER, "n")) == rows(plain(data(spark)))


def test_whole_table_rank_uses_many_slices(spark):
    got = sliced_rank(data(spark), [], ORDER, "n")
    assert sorted(r.n for r in got.collect()) == list(range(1, 3001))
    ordered = [r.id for r in got.orderBy("n").collect()]
    assert ordered == [r.id for r in data(spark).orderBy("s", "id").collect()]


def test_top_ranked_cuts_before_the_shuffle(spark):
    df = top_ranked(data(spark), ["k"], ORDER, "n", 4)
    assert plan(df).count("WindowGroupLimit") == 2
    assert df.filter("k = 'hot'").count() == 4
