from dropforge.session import MB, shuffle_partitions, split_bytes


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 1024**3, 8) == 20
    assert shuffle_partitions(100 * 1024**4) == 204_800
    assert shuffle_partitions(100 * 1024**4, most=40_000) == 40_000


def test_scan_splits_follow_the_data():
    assert split_bytes(10 * 1024**3) == 128 * MB
    assert 500 * MB < split_bytes(100 * 1024**4) < 600 * MB
    assert split_bytes(10_000 * 1024**4) == 1024 * MB


def test_adaptive_execution_is_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
