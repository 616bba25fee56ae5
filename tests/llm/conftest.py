import pytest

CLASHING = ("_key", "_id", "n", "class", "tokens", "starts", "ends", "found", "hits", "window", "shard", "curve", "toxicity", "_row", "rep", "part")


@pytest.fixture(scope="session")
def make(spark):
    """Documents with clashing extra columns from (doc_id, text) pairs."""

    def documents(rows, partitions=3):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df.repartition(partitions)

    return documents


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
