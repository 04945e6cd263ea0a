from pyspark.sql import functions as F
from tidemark.llm.sampling import drawn


def test_shares_of_any_size(spark):
    rows = spark.range(200_000).withColumn("text", F.col("id").cast("string"))
    assert rows.where(drawn(1.0, "id", "text")).count() == rows.where(drawn(7.5, "id")).count() == 200_000
    assert 95_000 < rows.where(drawn(0.5, "id", "text")).count() < 105_000
    assert 10 < rows.where(drawn(2e-4, "id", "text")).count() < 90
    smaller = rows.where(drawn(1e-3, "id")).select("id")
    assert smaller.exceptAll(rows.where(drawn(1e-2, "id")).select("id")).isEmpty()


def test_share_of_a_hundred_billion_rows_is_not_none(spark):
    low = F.shiftrightunsigned(F.xxhash64("id"), 1)
    least = spark.range(4_000_000).orderBy(low).limit(1)
    share = least.select(low).first()[0] / 2**63
    # a bounded sample of 20,000 out of 1e11 rows is a share of 2e-7, which parts in a million would round to none
    assert share < 1e-5 and least.where(drawn(share * 1.01 + 2e-7, "id")).count() == 1
    assert spark.range(10).where(drawn(1e-30, "id")).count() == 0
