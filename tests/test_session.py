import pytest

from areatab import session


class _Context:
    def __init__(self, master, configured=None):
        self.master, self.made, self.configured = master, None, configured

    def getCheckpointDir(self):
        return self.made

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.configured

    def setCheckpointDir(self, path):
        self.made = path


class _Session:
    def __init__(self, context):
        self.sparkContext, self.conf = context, context


def test_a_cluster_needs_its_shared_folder():
    for master in ("yarn", "k8s://x", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(_Session(_Context(master)))
        assert session.ensure_checkpoint_dir(_Session(_Context(master, "/shared"))) == "/shared"
    for master in ("local", "local[*]", "local[4]"):
        assert session.ensure_checkpoint_dir(_Session(_Context(master)))


def test_broadcast_goes_by_bytes_and_runs_nothing(spark, tmp_dir):
    from pyspark.sql import functions as F

    from areatab.operators.broadcast import fits

    spark.range(200_000).withColumn("t", F.repeat(F.sha2(F.col("id").cast("string"), 256), 4)).write.parquet(f"{tmp_dir}/wide")
    wide = spark.read.parquet(f"{tmp_dir}/wide")
    small = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    spark.sparkContext.setJobGroup("sizes", "sizes")
    assert fits(small) and fits(small.where("n_nationkey > 3").select("n_name")) and not fits(wide, 1 << 20)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("sizes")
    spark.sparkContext._jsc.sc().clearJobGroup()
