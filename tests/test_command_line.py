import pytest

from marquee.__main__ import QUESTIONS, parsed, parser, run


def test_from_raw_files_to_answers(spark, tmp_path, capsys):
    raw, clean, model, tables = (str(tmp_path / name) for name in ("raw", "clean", "model", "tables"))
    (tmp_path / "raw").mkdir()
    movies = "\n".join(f"{m},Film {m} ({1950 + m}),G{m % 2}|H{m % 3}" for m in range(1, 21))
    ratings = "\n".join(f"{u},{m},{5.0 if (u + m) % 2 == 0 else 1.5},{u * 100 + m}" for u in range(1, 31) for m in range(1, 21) if (u * m) % 7)
    (tmp_path / "raw" / "movies.csv").write_text("movieId,title,genres\n" + movies + "\n")
    (tmp_path / "raw" / "ratings.csv").write_text("userId,movieId,rating,timestamp\n" + ratings + "\n")

    def call(*words):
        run(spark, parser().parse_args(list(words)))
        return capsys.readouterr().out

    assert "stored" in call("clean", raw, clean, "--min-ratings", "3")
    assert "ndcg_at_10" in call("train", clean, model, "--rank", "4", "--iterations", "3")
    assert len(call("publish", clean, model, tables, "--rank", "4").split()[-1]) == 32
    call("publish", clean, model, tables, "--rank", "4", "--set-aside")
    wanted = {
        "recommendations": "similarity",
        "cards": "match_percent",
        "history": "rated_at",
        "history-pages": "rating_text",
        "stats": "top_affinity",
        "rating-count": "cold_start",
        "genres-of-user": "percentage",
        "taste-shares": "end_degree",
        "rating": "rating",
        "explanation": "shared_genres",
        "trending": "avg_rating",
        "search": "Film",
        "movie-cards": "Film",
        "movie": "Film 2 (1952)",
        "genres": "H1",
        "users": "rating_count",
        "user-picker": "ratings",
        "health": "present",
        "health-cards": "present",
    }
    assert wanted.keys() == QUESTIONS.keys()
    for question, text in wanted.items():
        out = call("ask", tables, question, "--user", "3", "--movie", "2", "--text", "film", "--min-ratings", "2")
        assert text in out, question
    with pytest.raises(SystemExit):
        parser().parse_args(["ask", tables, "nonsense"])

    # Without a user the answer is for everyone: a preview says so, a file holds all of it.
    assert "a preview of 20 rows" in call("ask", tables, "recommendations")
    call("ask", tables, "recommendations", "--out", str(tmp_path / "all"))
    # Every seventh user has rated nothing.
    assert spark.read.json(str(tmp_path / "all")).count() == 26 * 10
    call("ask", tables, "history", "--limit", "2", "--out", str(tmp_path / "two"))
    assert spark.read.json(str(tmp_path / "two")).count() == 26 * 2
    call("ask", tables, "search", "--text", "film", "--out", str(tmp_path / "found"))
    assert spark.read.json(str(tmp_path / "found")).count() == 20
    assert "incoming" in call("clean-up", tables)
    for question in ("rating", "explanation"):
        with pytest.raises(SystemExit):
            parsed(["ask", tables, question, "--user", "3"])


def test_latency_reports_are_stored_as_json(spark, tmp_path):
    spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 9.0)], "user_id int, ms double").write.parquet(str(tmp_path / "ms"))
    for kind, rows in (("summary", 2), ("report", 1)):
        run(spark, parser().parse_args(["latency", str(tmp_path / "ms"), kind, str(tmp_path / kind)]))
        assert spark.read.json(str(tmp_path / kind)).count() == rows
