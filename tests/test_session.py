"""Session helpers: cluster sizing and the checkpoint folder."""

from eventloom.session import cluster_conf, ensure_checkpoint_dir


def test_cluster_conf_sizes_partitions_from_input():
    conf = cluster_conf(100 * 1024**4)  # 100 TiB
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 << 20)
    assert conf["spark.sql.session.timeZone"] == "UTC"
    assert int(cluster_conf(1)["spark.sql.shuffle.partitions"]) == 200


def test_checkpoint_dir_comes_from_the_session(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first  # set once, then reused
