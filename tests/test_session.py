"""Checkpoint folder policy: the session's setting wins; a local folder only when unset."""

from playlake.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured.rstrip("/")
    assert ensure_checkpoint_dir(spark) == configured.rstrip("/")  # stable, never replaced
    assert scratch_path(spark, "t").startswith(configured.rstrip("/"))
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + configured.rstrip("/")) or \
        spark.sparkContext.getCheckpointDir().startswith(configured.rstrip("/"))


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
