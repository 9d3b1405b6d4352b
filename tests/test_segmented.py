from pyspark.sql import functions as F

from shroud.sources.segmented import read_segmented


def test_segments_read_in_parallel_without_loss(spark):
    df = read_segmented(spark, "tests.kvstore_stub:scan_segment", 7, n=500)
    assert df.rdd.getNumPartitions() == 7
    rows = df.collect()
    assert len(rows) == 500 and len({r["sourceSystemId"] for r in rows}) == 500
    per = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per) == 7 and sum(r["count"] for r in per) == 500
