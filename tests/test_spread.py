"""Wide tables that come from small files are dealt over the cores."""

from pyspark.sql import functions as F

from creditloom.operators import models
from creditloom.session import materialize, spread


def _one_file(spark, rows):
    columns = [F.expr(f"double(hash(id, {c})) AS c{c}").alias(f"c{c}") for c in range(30)]
    df = spark.range(0, rows, 1, 1).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), (F.col("id") % 3).cast("int").alias("fold"), *columns)
    return materialize(df, "one-file")


def _shares(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_encoded_rows_of_one_file_are_read_by_several_tasks(spark):
    df = _one_file(spark, 20_000)
    assert _shares(df) == 1
    cores = spark.sparkContext.defaultParallelism
    most = 1 if cores == 1 else 2.1 / min(cores, 9)
    encoded = models._encoded_folds(df, [None], "y", "k", 3, "fold", ["fold", "k", "y"])
    for i in range(3):
        _, rows, held = encoded[None, i]
        assert _shares(rows) <= most
        assert (rows.count(), held.count()) == (df.where(f"fold <> {i}").count(), df.where(f"fold = {i}").count())
    _, rows = models.fit_encoder(df, None, "y", "k", ["fold"])
    assert _shares(rows) <= most and rows.count() == 20_000


def test_dealing_keeps_every_row_and_leaves_even_tables_alone(spark):
    df = _one_file(spark, 6_000).select("y", "c0")
    twice = df.unionByName(df).coalesce(1)
    dealt = spread(twice, 200)
    assert dealt.exceptAll(twice).isEmpty() and twice.exceptAll(dealt).isEmpty()
    assert spread(dealt, 200) is dealt
    assert spread(df.where("false"), 200).count() == 0
