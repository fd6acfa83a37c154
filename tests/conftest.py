import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("marquee-tests")
               .config("spark.sql.shuffle.partitions", "2")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a schema string to a DataFrame over several partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
