"""Whole jobs over folders: clean, split, featurise, train, evaluate, serve."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from marquee.operators import clean, evaluate, features, recommend, split, store, validate
from marquee.session import durable
from marquee.sources import files


def clean_job(spark: SparkSession, ratings_csv: str, movies_csv: str, out: str,
              min_user: int = 5, min_item: int = 5) -> None:
    """Raw CSVs to cleaned ratings, movies and id maps."""
    kept = durable(clean.filter_min_interactions(
        files.read_ratings(spark, ratings_csv), min_user, min_item), "kept")
    users = clean.dense_ids(kept, "userId", "user_idx")
    items = clean.dense_ids(kept, "movieId", "movie_idx")
    files.write_parquet(clean.id_map(users, "userId", "user_idx"), f"{out}/user_id_map")
    files.write_parquet(clean.id_map(items, "movieId", "movie_idx"), f"{out}/movie_id_map")
    files.write_parquet(clean.apply_id_maps(kept, users, items), f"{out}/ratings_clean")
    files.write_parquet(clean.clean_movies(files.read_movies(spark, movies_csv), items),
                        f"{out}/movies_clean")


def split_job(spark: SparkSession, folder: str, fraction: float = 0.8) -> None:
    """Cleaned ratings to train, test and their interactions."""
    ratings = files.read_parquet(spark, f"{folder}/ratings_clean")
    train, test = split.chronological_split(ratings, fraction)
    files.write_parquet(train, f"{folder}/train")
    files.write_parquet(test, f"{folder}/test")
    train = files.read_parquet(spark, f"{folder}/train")
    test = split.restrict_to_known(files.read_parquet(spark, f"{folder}/test"), train)
    files.write_parquet(split.interactions(train), f"{folder}/train_interactions")
    files.write_parquet(split.interactions(test), f"{folder}/test_interactions")


def train_job(spark: SparkSession, folder: str, **settings) -> DataFrame:
    """Fit and store the model; returns its metrics on both parts."""
    train = files.read_parquet(spark, f"{folder}/train_interactions")
    test = files.read_parquet(spark, f"{folder}/test_interactions")
    model = recommend.train(train, **settings)
    files.save_model(model, f"{folder}/model")
    return evaluate.evaluate_model(
        recommend.user_factors(model), recommend.item_factors(model), train, test)


def feature_job(spark: SparkSession, ratings: DataFrame, movies: DataFrame, out: str,
                as_of: datetime) -> dict[str, str]:
    """Batch features as known at ``as_of``, stored per day; returns their paths.

    The stored user table carries the favourite genre its view declares.
    """
    cutoff = int(as_of.timestamp())
    made = features.batch_features(ratings, movies, cutoff)
    made["user_features"] = made["user_features"].join(made["user_movie_features"], "user_idx", "left")
    paths = {}
    for name, table in made.items():
        paths[name] = f"{out}/{name}.parquet"
        files.write_features(table, paths[name], as_of)
    return paths


def materialize_job(spark: SparkSession, folder: str, out: str, end: datetime,
                    names: list[str] | None = None) -> None:
    """Latest feature rows of the named views to the online tables."""
    for name in names or [store.USER_BATCH.name, store.MOVIE_BATCH.name]:
        view = store.VIEWS[name]
        latest = store.materialize(view, store.read_view(spark, view, folder), end)
        files.write_parquet(latest, f"{out}/{name}", "overwrite")


def validate_job(spark: SparkSession, path: str, data_type: str, history: str,
                 run_time: datetime) -> DataFrame:
    """Check one CSV and append the result to the history."""
    suite = validate.suite_for(data_type)
    summary = validate.summarise(validate.run_suite(files.read_for_validation(spark, path), suite))
    summary = durable(summary, "validation")
    validate.record_run(summary, data_type, run_time, history)
    return summary


def serve_job(spark: SparkSession, folder: str, requests: DataFrame,
              activity: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Answer requests with the stored model: (recommendations, rejected)."""
    model = files.load_model(f"{folder}/model")
    return recommend.recommend(
        recommend.user_factors(model), recommend.item_factors(model), requests,
        files.read_parquet(spark, f"{folder}/train_interactions"),
        files.read_parquet(spark, f"{folder}/movies_clean"), activity)
