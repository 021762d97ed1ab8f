import pytest


@pytest.fixture
def tables(spark, tmp_path):
    """Writes frames as the tables of a data folder, and gives the folder."""
    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture(scope="session")
def documents(small):
    import pyarrow.parquet as pq

    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{small}/documents.parquet").to_pylist()]
