import random
from datetime import datetime, timezone

import pytest

from marquee.operators import store
from marquee.plans import jobs
from marquee.session import durable, shared_folder
from marquee.sources import files
from tests.conftest import tuples


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Raw CSVs and the outputs of the cleaning, split and training jobs."""
    root = tmp_path_factory.mktemp("movies")
    pick = random.Random(4)
    lines = ["userId,movieId,rating,timestamp"]
    for u in range(10, 40):
        for m in sorted(pick.sample(range(100, 130), 14)):
            lines.append(f"{u},{m},{pick.randrange(1, 11) / 2},{978307200 + pick.randrange(10**7)}")
    lines.append("99,100,3.0,978307200")
    (root / "ratings.csv").write_text("\n".join(lines) + "\n")
    films = ["movieId,title,genres"] + [f'{m},"Film, {m}",Drama|{"Action" if m % 2 else "Comedy"}' for m in range(100, 132)]
    (root / "movies.csv").write_text("\n".join(films) + "\n")
    jobs.clean_job(spark, f"{root}/ratings.csv", f"{root}/movies.csv", f"{root}/out")
    jobs.split_job(spark, f"{root}/out")
    return str(root)


def test_cleaned_tables(spark, folder):
    ratings = files.read_parquet(spark, f"{folder}/out/ratings_clean")
    assert ratings.columns == ["userId", "movieId", "rating", "timestamp", "user_idx", "movie_idx"]
    assert ratings.where("userId = 99").count() == 0
    users = files.read_parquet(spark, f"{folder}/out/user_id_map")
    assert tuples(users) == [(u, u - 10) for u in range(10, 40)]
    movies = files.read_parquet(spark, f"{folder}/out/movies_clean")
    assert movies.count() == ratings.select("movie_idx").distinct().count()


def test_split_tables(spark, folder):
    train, test = (files.read_parquet(spark, f"{folder}/out/{p}") for p in ("train", "test"))
    total = files.read_parquet(spark, f"{folder}/out/ratings_clean").count()
    assert train.count() == int(total * 0.8) and train.count() + test.count() == total
    assert train.agg({"timestamp": "max"}).first()[0] <= test.agg({"timestamp": "min"}).first()[0]


def test_train_and_serve(spark, folder):
    metrics = {r["part"]: r for r in jobs.train_job(spark, f"{folder}/out", rank=4, maxIter=3).collect()}
    assert metrics.keys() == {"train", "test"} and metrics["train"]["auc"] > 0.5
    requests = spark.createDataFrame(
        [(1, 3, 5, True, True), (2, 3, 0, True, True)],
        "request_id long, user_idx long, n_recommendations int, exclude_rated boolean, use_features boolean")
    found, rejected = jobs.serve_job(spark, f"{folder}/out", requests)
    rows = found.orderBy("rank").collect()
    seen = {r["movie_idx"] for r in files.read_parquet(spark, f"{folder}/out/train_interactions").where("user_idx = 3").collect()}
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5] and not seen & {r["movie_idx"] for r in rows}
    assert rejected.first()["error"] == "invalid_input"


def test_features_to_online_tables(spark, folder, tmp_path):
    ratings = files.read_parquet(spark, f"{folder}/out/train")
    movies = files.read_parquet(spark, f"{folder}/out/movies_clean")
    as_of = datetime(2001, 6, 1, tzinfo=timezone.utc)
    for _ in range(2):  # a second run of the day replaces the first
        paths = jobs.feature_job(spark, ratings, movies, str(tmp_path / "data"), as_of)
    assert set(paths) == {"user_features", "movie_features", "user_movie_features"}
    view = store.read_view(spark, store.USER_BATCH, str(tmp_path / "data"))
    assert view.count() == ratings.select("user_idx").distinct().count()
    jobs.materialize_job(spark, str(tmp_path / "data"), str(tmp_path / "online"), as_of)
    online = files.read_parquet(spark, str(tmp_path / "online/movie_batch_features"))
    assert online.columns == ["movie_idx", *store.MOVIE_BATCH.features, "event_timestamp"]
    assert not files.write_stream_features(view.limit(0), str(tmp_path / "none"), as_of)


def test_validation_job(spark, folder, tmp_path):
    row = jobs.validate_job(spark, f"{folder}/ratings.csv", "ratings", str(tmp_path / "h"), datetime(2024, 1, 1)).first()
    assert not row["valid"]
    assert files.read_parquet(spark, str(tmp_path / "h")).first()["dataset"] == "ratings"


def test_missing_and_malformed_inputs(spark, tmp_path):
    with pytest.raises(files.MissingTable):
        files.read_ratings(spark, str(tmp_path / "no.csv"))
    with pytest.raises(files.MissingTable):
        files.read_parquet(spark, str(tmp_path / "no"))
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,2,NaN,5\n1,3,,6\n")
    assert [r["rating"] for r in files.read_ratings(spark, str(tmp_path / "r.csv")).collect()] == [None, None]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3.5, 4)], "userId long, movieId long, rating double, timestamp long")
    files.write_csv(df, str(tmp_path / "csv"))
    assert tuples(files.read_ratings(spark, str(tmp_path / "csv"))) == [(1, 2, 3.5, 4)]


def test_durable_tables_lie_in_the_named_folder(spark):
    table = durable(spark.range(3).toDF("n"))
    assert all(f.startswith(f"file://{shared_folder(spark)}/marquee/") for f in table.inputFiles())
    assert tuples(table) == [(0,), (1,), (2,)]
