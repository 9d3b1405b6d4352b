"""Jobs give exact results when tasks fail and are retried.

A Python UDF in the input raises on the first attempt of one task; Spark
re-runs it.  Outputs and the counts that gate verification must be the
same as in an undisturbed run (failed attempts' metrics are discarded).
"""

from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shroud import fixtures as fx
from shroud import schemas
from shroud.plans import jobs as J

SF = "/root/testdata/sf0.001"


def test_deidentify_job_survives_task_retries(spark, scratch):
    import os

    base = scratch("retry")
    marker_dir = base.replace("file:", "") + "-markers"
    os.makedirs(marker_dir, exist_ok=True)

    # defined here so that it is shipped to the workers by value
    def _fail_first_attempt(value):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            with open(os.path.join(marker_dir, f"stage{ctx.stageId()}"), "a") as fh:
                fh.write("failed\n")
            raise RuntimeError("injected task failure")
        return value

    cust = fx.customers(spark, SF).repartition(3)
    flaky = cust.withColumn("id", F.udf(_fail_first_attempt, StringType())("id"))
    idsvc = fx.identity_service(spark, SF)
    calm = J.deidentify_job(spark, cust, idsvc, public_root=f"{base}/a/pub",
                            secured_root=f"{base}/a/sec", audit_root=f"{base}/a/audit",
                            fmt="orc", dataset="c", source="app", as_of="2024-01-01")
    rough = J.deidentify_job(spark, flaky, idsvc, public_root=f"{base}/b/pub",
                             secured_root=f"{base}/b/sec", audit_root=f"{base}/b/audit",
                             fmt="orc", dataset="c", source="app", as_of="2024-01-01")
    assert os.listdir(marker_dir), "the injected failure never happened"
    for k in ("public_rows", "secured_rows", "missing_identities"):
        assert rough.values[k] == calm.values[k]

    def rows(path, schema):
        return sorted(map(tuple, spark.read.schema(schema).orc(path).collect()), key=str)

    assert rows(rough.outputs["public"], schemas.DEIDENTIFIED) == \
        rows(calm.outputs["public"], schemas.DEIDENTIFIED)
    assert rows(rough.outputs["secured"], schemas.SECURED) == \
        rows(calm.outputs["secured"], schemas.SECURED)


def test_written_count_exact_under_retry(spark, scratch):
    import os

    from pyspark.sql import Observation

    from shroud.sinks import objects as KO
    from shroud.sources import objects as SO

    base = scratch("retry-objects")
    marker_dir = base.replace("file:", "") + "-markers"
    os.makedirs(marker_dir, exist_ok=True)

    def _fail_first_attempt(value):
        ctx = TaskContext.get()
        if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() == 1:
            with open(os.path.join(marker_dir, f"stage{ctx.stageId()}"), "a") as fh:
                fh.write("failed\\n")
            raise RuntimeError("injected task failure")
        return value

    n = 300
    docs = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("object_key"),
                                 F.lit('{"a":1}').alias("payload"))
    # the failing UDF runs after a shuffle, next to the write; the count taken
    # in the writing stage must still be exact
    flaky = docs.repartition(4, "object_key").withColumn(
        "payload", F.udf(_fail_first_attempt, StringType())("payload"))
    obs = Observation("written")
    KO.write_objects(flaky, f"{base}/out", written=obs, num_partitions=4)
    assert os.listdir(marker_dir), "the injected failure never happened"
    assert obs.get["rows"] == n
    assert SO.list_objects(spark, f"{base}/out", "keyed").count() == n
