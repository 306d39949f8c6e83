from tripflow.session import create_session


def test_session_settings(spark):
    session = create_session({"spark.sql.session.timeZone": "UTC"})
    assert session is spark or session.sparkContext is spark.sparkContext
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
