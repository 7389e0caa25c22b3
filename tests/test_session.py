from salaria.plans.session import recommended_conf


def test_recommended_conf_is_accepted_by_spark(spark):
    conf = recommended_conf(1000)
    assert conf["spark.sql.shuffle.partitions"] == "1000"
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
