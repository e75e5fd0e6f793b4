from voltline.session import scale_conf


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 1024 ** 4, total_cores=8000)   # 100 TiB on 1000 x 8 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600   # 100 TiB / 256 MiB
    small = scale_conf(10 * 1024 ** 2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
