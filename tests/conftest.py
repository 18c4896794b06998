import pytest

from revlens.runtime import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", **{"spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def prepared(spark, sf_dir):
    from revlens.plans import sample
    from revlens.runtime import materialized

    return materialized(sample.prepared(spark, sf_dir, training=True), "test-prepared")


@pytest.fixture(scope="session")
def topic_model(prepared):
    from revlens.plans.train_topics import train_topics

    return train_topics(prepared)
