from soukline.session import cluster_conf, shared_dir


def test_cluster_conf_sizes_partitions():
    tb = 1 << 40
    big = cluster_conf(100 * tb, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "65536"          # capped
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(10 << 30, total_cores=64)
    assert small["spark.sql.shuffle.partitions"] == str(3 * 64)       # at least 3 waves
    assert small["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_shared_dir_is_the_sessions_checkpoint_dir(spark):
    d = shared_dir(spark)
    assert d == spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/") or \
        d == spark.conf.get("spark.checkpoint.dir", "").rstrip("/")
