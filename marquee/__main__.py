"""Command line: clean raw files, train, publish, and ask the published tables.

    python -m marquee clean RAW_DIR CLEAN_DIR
    python -m marquee train CLEAN_DIR MODEL_DIR
    python -m marquee publish CLEAN_DIR MODEL_DIR TABLES_DIR
    python -m marquee ask TABLES_DIR recommendations --user 7
    python -m marquee ask TABLES_DIR recommendations --out ALL_ROWS
    python -m marquee latency MEASURES summary OUT
    python -m marquee clean-up TABLES_DIR
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from marquee.plans import reports
from marquee.plans.cleaning_run import run_cleaning
from marquee.plans.training import AlsSettings, run_training
from marquee.serving import Serving
from marquee.session import build_session, forget_stored
from marquee.sources.files import read_factors
from marquee.sources.sinks import Store, serving_factors, serving_movies, serving_ratings, write_report

# Rows printed when no file is asked for.
PREVIEW_ROWS = 20


def _limit(args: argparse.Namespace, name: str) -> dict[str, int]:
    """The limit under the operator's own name for it; without --limit the operator's default holds."""
    return {} if args.limit is None else {name: args.limit}


# What each question takes of --user, --movie, --text, --genre and --limit.
QUESTIONS = {
    "recommendations": lambda s, a: s.recommendations(a.user, **_limit(a, "top_n")),
    "cards": lambda s, a: s.cards(a.user, **_limit(a, "top_n")),
    "history": lambda s, a: s.user_history(a.user, **_limit(a, "limit")),
    "history-pages": lambda s, a: s.history_pages(a.user, **_limit(a, "limit")),
    "stats": lambda s, a: s.user_stats(a.user),
    "rating-count": lambda s, a: s.rating_count(a.user),
    "genres-of-user": lambda s, a: s.genre_distribution(a.user),
    "taste-shares": lambda s, a: s.taste_shares(a.user),
    "rating": lambda s, a: s.user_rating_for_movie(a.user, a.movie),
    "explanation": lambda s, a: s.explanation(a.user, a.movie, **_limit(a, "top_n")),
    "trending": lambda s, a: s.trending_movies(min_ratings=a.min_ratings, **_limit(a, "limit")),
    "search": lambda s, a: s.search_movies(a.text, genre=a.genre, **_limit(a, "limit")),
    "movie-cards": lambda s, a: s.movie_cards(a.text, genre=a.genre, **_limit(a, "limit")),
    "movie": lambda s, a: s.movie_details(a.movie),
    "genres": lambda s, a: s.all_genres(),
    "users": lambda s, a: s.all_users(**_limit(a, "limit")),
    "user-picker": lambda s, a: s.user_picker(**_limit(a, "limit")),
    "health": lambda s, a: s.system_health(),
    "health-cards": lambda s, a: s.health_cards(),
}
# Questions about one user and one movie.
NEEDED = {"rating": ("user", "movie"), "explanation": ("user", "movie")}
REPORTS = {"summary": reports.latency_summary, "report": reports.latency_report}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marquee", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean", help="raw CSV files to clean tables")
    clean.add_argument("raw")
    clean.add_argument("clean")
    clean.add_argument("--min-ratings", type=int, default=10)
    train = commands.add_parser("train", help="clean tables to a model's vectors and its metrics")
    train.add_argument("clean")
    train.add_argument("model")
    train.add_argument("--rank", type=int, default=AlsSettings.rank)
    train.add_argument("--iterations", type=int, default=AlsSettings.max_iter)
    publish = commands.add_parser("publish", help="clean tables and vectors to published tables")
    publish.add_argument("clean")
    publish.add_argument("model")
    publish.add_argument("tables")
    publish.add_argument("--rank", type=int, default=AlsSettings.rank)
    publish.add_argument("--replace", action="store_true", help="put the load in place of what is published")
    publish.add_argument("--set-aside", action="store_true", help="store refused ratings apart instead of failing")
    ask = commands.add_parser("ask", help="one question to the published tables")
    ask.add_argument("tables")
    ask.add_argument("question", choices=sorted(QUESTIONS))
    ask.add_argument("--user", type=int)
    ask.add_argument("--movie", type=int)
    ask.add_argument("--text")
    ask.add_argument("--genre")
    ask.add_argument("--limit", type=int, help="rows per answer or per user; each question has its own default")
    ask.add_argument("--min-ratings", type=int, default=100)
    ask.add_argument("--out", help="folder for all rows as JSON lines; without it a preview is printed")
    latency = commands.add_parser("latency", help="percentiles of measures (user_id, ms) as JSON lines")
    latency.add_argument("measures")
    latency.add_argument("kind", choices=sorted(REPORTS))
    latency.add_argument("out")
    clean_up = commands.add_parser("clean-up", help="remove versions that are not published, and staged loads")
    clean_up.add_argument("tables")
    for command in (clean, train, publish):
        command.add_argument("--shuffled-bytes", type=int, help="size of the largest table that is shuffled")
    return top


def preview(answer: DataFrame) -> None:
    """Print the first rows, and say so if there are more."""
    rows = answer.take(PREVIEW_ROWS + 1)
    answer.sparkSession.createDataFrame(rows[:PREVIEW_ROWS], answer.schema).show(PREVIEW_ROWS, truncate=False)
    if len(rows) > PREVIEW_ROWS:
        print(f"a preview of {PREVIEW_ROWS} rows; --out stores all of them")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "clean":
        *paths, counts = run_cleaning(spark, args.raw, args.clean, args.min_ratings)
        counts.orderBy("table", "outcome").show(truncate=False)
        print(*paths, sep="\n")
    elif args.command == "train":
        ratings = spark.read.parquet(f"{args.clean}/ratings_clean.parquet")
        result = run_training(ratings, args.model, AlsSettings(rank=args.rank, max_iter=args.iterations))
        for name, value in result.items():
            if name != "model":
                print(f"{name}: {value}")
    elif args.command == "publish":
        users = read_factors(spark, f"{args.model}/user_factors.parquet", "user_factors", args.rank)
        movies = read_factors(spark, f"{args.model}/movie_factors.parquet", "movie_factors", args.rank)
        version = Store(spark, args.tables).publish(
            serving_movies(spark.read.parquet(f"{args.clean}/movies_clean.parquet")),
            serving_ratings(spark.read.parquet(f"{args.clean}/ratings_clean.parquet")),
            serving_factors(users, "user_id"),
            serving_factors(movies, "movie_id"),
            dim=args.rank,
            replace=args.replace,
            strict=not args.set_aside,
        )
        print(version)
    elif args.command == "latency":
        write_report(REPORTS[args.kind](spark.read.parquet(args.measures)), args.out)
    elif args.command == "clean-up":
        print(*Store(spark, args.tables).clean_up(), sep="\n")
    else:
        answer = QUESTIONS[args.question](Serving(Store(spark, args.tables).tables()), args)
        write_report(answer, args.out) if args.out else preview(answer)


def parsed(arguments: list[str] | None = None) -> argparse.Namespace:
    top = parser()
    args = top.parse_args(arguments)
    missing = [f"--{name}" for name in NEEDED.get(getattr(args, "question", ""), ()) if getattr(args, name) is None]
    if missing:
        top.error(f"{args.question} needs {' and '.join(missing)}")
    return args


def main(arguments: list[str] | None = None) -> None:
    args = parsed(arguments)
    # On a cluster the submit command names the master.
    spark = build_session("marquee", os.environ.get("SPARK_MASTER"), getattr(args, "shuffled_bytes", None))
    try:
        run(spark, args)
    finally:
        forget_stored(spark)


if __name__ == "__main__":
    main()
