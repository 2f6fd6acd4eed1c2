from tierline.session import SESSION_DEFAULTS, apply_defaults, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    # spark.checkpoint.dir is static: when the environment sets it, it is the folder used;
    # only when it is unset does the test session's own folder serve
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    assert got == (configured or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir()


def test_defaults_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    apply_defaults(spark)
    for k, v in SESSION_DEFAULTS.items():
        assert spark.conf.get(k) == v
