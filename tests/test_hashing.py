import hashlib

from pyspark.sql import functions as F

from ledgertalk.functions.hashing import sample, train_or_eval


def test_sample_does_not_depend_on_partitions(spark, partitions):
    def draw(n):
        df = spark.range(500).repartition(n).select(F.col("id").cast("string").alias("k"))
        return sorted(r.k for r in sample(df, ["k"], 50, 42).collect())

    draws = [draw(n) for n in (1, 3, 7)]
    assert draws[0] == draws[1] == draws[2] and len(draws[0]) == 50
    other = sample(spark.range(500).select(F.col("id").cast("string").alias("k")), ["k"], 50, 43)
    assert sorted(r.k for r in other.collect()) != draws[0]


def test_split_is_a_property_of_the_text(spark):
    texts = spark.range(5000).select(F.concat(F.lit("text "), F.col("id")).alias("t"))
    labelled = texts.withColumn("split", train_or_eval(F.col("t"), 0.9, 42))
    whole = {r.t: r.split for r in labelled.collect()}
    part = {r.t: r.split for r in labelled.filter("t LIKE '%7%'").collect()}
    assert all(whole[t] == split for t, split in part.items())
    share = sum(split == "train" for split in whole.values()) / len(whole)
    assert 0.88 < share < 0.92
    every = texts.select(train_or_eval(F.col("t"), 1.0, 42).alias("s")).distinct().collect()
    assert [r.s for r in every] == ["train"]


def test_sample_equals_sorting_everything(spark):
    for size, n in ((30000, 6000), (4000, 6000), (6000, 6000), (0, 6000), (9000, 1), (900, 0)):
        df = spark.range(size).select(F.col("id").cast("string").alias("k"))
        chosen = {r.k for r in sample(df, ["k"], n, 7).collect()}
        digests = sorted((hashlib.md5(f"{k}#7".encode()).hexdigest(), str(k)) for k in range(size))
        assert chosen == {k for _, k in digests[:n]}


def test_every_sample_is_cut_before_the_final_merge(spark):
    df = spark.range(30000).select(F.col("id").cast("string").alias("k"))
    for n in (50, 6000):
        plan = sample(df, ["k"], n, 7)._jdf.queryExecution().optimizedPlan().toString()
        assert "scalar-subquery" in plan
