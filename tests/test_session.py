from tideline.session import MB, scale_conf


def test_scale_conf_sizes_partitions_by_shuffle_bytes():
    big = scale_conf(cores=8000, shuffle_bytes=20 * (1 << 40))
    assert int(big["spark.sql.shuffle.partitions"]) == 20 * (1 << 40) // (256 * MB)
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * MB)


def test_scale_conf_keeps_two_waves_on_small_inputs():
    assert scale_conf(cores=8, shuffle_bytes=1 * MB)["spark.sql.shuffle.partitions"] == "16"
