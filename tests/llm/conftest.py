import pytest


@pytest.fixture
def table(spark):
    """A small table, in several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


VOCABULARY = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))
