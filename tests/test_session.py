"""Session settings and shared locations."""

from farelens.session import ensure_checkpoint_dir, pin_session, storage_root


def test_storage_root_follows_session_conf(spark):
    configured = spark.conf.get("spark.farelens.storage.root")
    assert storage_root(spark) == configured.rstrip("/")


def test_checkpoint_dir_is_set_once(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first


def test_session_pins_results_relevant_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    pin_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"      # ANSI stays on


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(Session())
