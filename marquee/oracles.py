"""The registered queries in ANSI SQL for DuckDB, over the same tables.

Written apart from the Spark code: only the texts that make up the input views are shared.
"""

from __future__ import annotations

import re

from marquee.sources.proxies import (
    CLUSTERS,
    DAMAGED_ID,
    DIRTY_MOVIE,
    DIRTY_RATING,
    EVAL_RATING,
    MOVIE,
    RAW_RATING,
    SUSPECT_MOVIE,
    SUSPECT_RATING,
    columns,
)
from marquee.sources.synthetic import PRIME, ROUNDS


def _select(named: dict[str, str]) -> str:
    return "SELECT " + ", ".join(columns(named))


_LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_EVAL = {name: text.format(vectors="(SELECT MAX(vec_id) + 1 FROM embeddings)") for name, text in EVAL_RATING.items()}
_IN_TRAIN = "(CAST(user_id AS BIGINT) * 7919 + CAST(movie_id AS BIGINT) * 104729) % 100 < 80"

def _made_vector(key: str, seed: int) -> str:
    start = f"({key} * 7919 + j * 104729 + {seed * 15485863}) % 2147483647"
    step = f"(({start}) * 48271 % 2147483647) * 69621 % 2147483647"
    value = f"CAST({step} AS DOUBLE) * CAST(2 AS DOUBLE) / CAST(2147483647 AS DOUBLE) - CAST(1 AS DOUBLE)"
    return f"list_transform(range(1, 51), lambda j: CAST(CAST({value} AS FLOAT) AS DOUBLE))"


def _ranking_views(prefix: str, ratings: str, users: str, items: str) -> dict[str, str]:
    """The steps of an evaluation of one set of vectors on one set of ratings."""
    train, test, relevant, unseen = (f"{prefix}{name}" for name in ("train", "test", "relevant", "unseen_top"))

    def best(score: str, condition: str = "") -> str:
        return f"""SELECT user_id, movie_id, score, rank FROM (
            SELECT user_id, movie_id, score, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank
            FROM (SELECT u.user_id, m.movie_id, {score}(u.features, m.features) AS score
                  FROM {users} u CROSS JOIN {items} m {condition}) AS pairs) AS ranked WHERE rank <= 10"""

    return {
        train: f"SELECT * FROM {ratings} WHERE {_IN_TRAIN}",
        test: f"SELECT * FROM {ratings} WHERE NOT ({_IN_TRAIN})",
        relevant: f"""SELECT DISTINCT user_id, movie_id FROM {test}
            WHERE rating >= 4.0 AND movie_id IN (SELECT movie_id FROM {items})""",
        f"{prefix}cosine_top": best("list_cosine_similarity"),
        unseen: best(
            "list_dot_product",
            f"""WHERE u.user_id IN (SELECT user_id FROM {relevant})
            AND NOT EXISTS (SELECT 1 FROM {train} t WHERE t.user_id = u.user_id AND t.movie_id = m.movie_id)""",
        ),
        f"{prefix}per_user": f"""SELECT r.user_id, r.relevant, COALESCE(h.hits, 0) AS hits,
            COALESCE(h.hits, 0) / CAST(10 AS DOUBLE) AS precision,
            CASE WHEN COALESCE(h.hits, 0) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hit,
            COALESCE(h.hits, 0) / CAST(r.relevant AS DOUBLE) AS recall,
            COALESCE(h.gain, 0) / list_sum(list_transform(range(1, LEAST(10, r.relevant) + 1), lambda i: 1 / log2(i + 1))) AS ndcg
            FROM (SELECT user_id, COUNT(*) AS relevant FROM {relevant} GROUP BY user_id) AS r
            JOIN {users} u ON u.user_id = r.user_id
            LEFT JOIN (SELECT t.user_id, COUNT(*) AS hits, SUM(1 / log2(t.rank + 1)) AS gain FROM {unseen} t
                       JOIN {relevant} e ON e.user_id = t.user_id AND e.movie_id = t.movie_id GROUP BY t.user_id) AS h
            ON h.user_id = r.user_id""",
        f"{prefix}predicted": f"""SELECT t.user_id, t.movie_id, t.rating, list_dot_product(u.features, m.features) AS prediction
            FROM {test} t JOIN {users} u ON u.user_id = t.user_id JOIN {items} m ON m.movie_id = t.movie_id""",
    }


def _synthetic_vector(key: str, dim: int, seed: int) -> str:
    drawn = f"list_transform(range(1, {dim + 1}), lambda j: (CAST({key} AS BIGINT) * 7919 + j * 104729 + {seed * 15485863}) % {PRIME})"
    for constant in ROUNDS:
        drawn = f"list_transform({drawn}, lambda x: x * ((x + {constant}) % {PRIME}) % {PRIME})"
    return f"list_transform({drawn}, lambda x: CAST(CAST(x AS DOUBLE) * 2 / CAST({PRIME} AS DOUBLE) - 1 AS FLOAT))"


def _clustered_vector(key: str, seed: int) -> str:
    centre, own = _made_vector(f"({key} % {CLUSTERS})", 44), _made_vector(key, seed)
    return f"list_transform(list_zip({centre}, {own}), lambda p: p[1] + p[2] / 8)"


def _best_pairs(score: str) -> str:
    return f"""SELECT user_id, movie_id, score, rank FROM (
        SELECT user_id, movie_id, score, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank
        FROM (SELECT u.user_id, m.movie_id, {score}(u.features, m.features) AS score
              FROM clustered_customers u CROSS JOIN clustered_parts m) AS pairs) AS ranked WHERE rank <= 10"""


# Input views, in an order in which each needs only those before it.
VIEWS = {
    "movies": f"{_select(MOVIE)} FROM part",
    "ratings_raw": f"{_select(RAW_RATING)} {_LINES}",
    "ratings": """SELECT user_id, movie_id, rating, rated_at FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, movie_id ORDER BY rated_at DESC, rating DESC) AS rn
        FROM ratings_raw) AS t WHERE rn = 1""",
    "dirty_movies": f"{_select(DIRTY_MOVIE)} FROM part",
    "dirty_ratings": f"{_select(DIRTY_RATING)} {_LINES}",
    "user_factors": """SELECT CAST(vec_id AS INT) AS user_id, CAST(embedding AS DOUBLE[]) AS features
        FROM embeddings""",
    "movie_factors": """SELECT CAST(vec_id AS INT) AS movie_id, CAST(embedding AS DOUBLE[]) AS features
        FROM embeddings""",
    "ratings_eval": f"""SELECT user_id, movie_id, MAX(rating) AS rating
        FROM ({_select(_EVAL)} {_LINES}) AS t GROUP BY user_id, movie_id""",
    "cleaned_ratings": """SELECT TRY_CAST(trim(userId) AS INTEGER) AS userId, TRY_CAST(trim(movieId) AS INTEGER) AS movieId,
        TRY_CAST(trim(rating) AS FLOAT) AS rating,
        CASE WHEN regexp_matches(trim(timestamp), '^[0-9]+$') THEN TRY_CAST(trim(timestamp) AS BIGINT) END AS timestamp
        FROM dirty_ratings WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL
        AND regexp_matches(trim(userId), '^[0-9]+$') AND regexp_matches(trim(movieId), '^[0-9]+$')
        AND regexp_matches(trim(rating), '^[0-9]+([.][0-9]+)?$')
        AND TRY_CAST(trim(userId) AS INTEGER) IS NOT NULL AND TRY_CAST(trim(movieId) AS INTEGER) IS NOT NULL""",
    "customer_vectors": f"""SELECT CAST(c_custkey AS INT) AS user_id, {_made_vector('c_custkey', 42)} AS features
        FROM customer""",
    "part_vectors": f"SELECT CAST(p_partkey AS INT) AS movie_id, {_made_vector('p_partkey', 43)} AS features FROM part",
    "clustered_customers": f"SELECT CAST(c_custkey AS INT) AS user_id, {_clustered_vector('c_custkey', 45)} AS features FROM customer",
    "clustered_parts": f"SELECT CAST(p_partkey AS INT) AS movie_id, {_clustered_vector('p_partkey', 46)} AS features FROM part",
    "clustered_top": _best_pairs("list_cosine_similarity"),
    "clustered_top_dot": _best_pairs("list_dot_product"),
    **_ranking_views("", "ratings_eval", "user_factors", "movie_factors"),
    **_ranking_views("customer_", "ratings", "customer_vectors", "part_vectors"),
    "suspect": f"{_select(SUSPECT_RATING)} FROM ratings_raw",
    "suspect_movies": f"{_select(SUSPECT_MOVIE)} FROM movies",
    "suspect_users": """SELECT CASE WHEN user_id % 41 = 0 THEN NULL WHEN user_id % 41 = 1 THEN 1 ELSE user_id END AS user_id,
        CASE WHEN user_id % 41 = 2 THEN NULL ELSE features END AS features FROM user_factors""",
    "suspect_items": """SELECT CASE WHEN movie_id % 41 = 0 THEN NULL WHEN movie_id % 41 = 1 THEN 1 ELSE movie_id END AS movie_id,
        CASE WHEN movie_id % 41 = 2 THEN NULL ELSE features END AS features FROM movie_factors""",
    "no_movies": "SELECT * FROM suspect_movies WHERE title = genres",
    "damaged": f"""SELECT {DAMAGED_ID} AS id, id % 23 = 0 AS lost, id % 23 <> 0 AND id % 17 = 0 AS short,
        id % 23 <> 0 AND id % 17 <> 0 AND id % 19 = 0 AS shifted
        FROM (SELECT p_partkey + 1 AS id FROM part) AS p WHERE id % 31 <> 0""",
    "history": """SELECT * FROM (SELECT r.user_id, r.movie_id, m.title, m.genres, r.rating, r.rated_at,
        CAST(ROW_NUMBER() OVER (PARTITION BY r.user_id ORDER BY r.rated_at DESC NULLS LAST, r.movie_id) AS INT) AS position
        FROM ratings r JOIN movies m ON m.movie_id = r.movie_id) AS t WHERE position <= 50""",
    "user_genres": """SELECT user_id, genre, COUNT(*) AS genre_count FROM (
        SELECT r.user_id, unnest(string_split(m.genres, '|')) AS genre
        FROM ratings r JOIN movies m ON m.movie_id = r.movie_id) AS t WHERE genre <> '' GROUP BY user_id, genre""",
    "distribution": """SELECT g.user_id, g.genre, g.genre_count,
        (200 * g.genre_count + t.total) // (2 * t.total) AS percentage, g.rank
        FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY genre_count DESC, genre) AS INT) AS rank
              FROM user_genres) AS g
        JOIN (SELECT r.user_id, COUNT(*) AS total FROM ratings r JOIN movies m ON m.movie_id = r.movie_id
              GROUP BY r.user_id) AS t ON t.user_id = g.user_id WHERE g.rank <= 5""",
    "liked": """SELECT r.user_id, r.movie_id, m.title, m.genres, r.rating, r.rated_at
        FROM ratings r JOIN movies m ON m.movie_id = r.movie_id WHERE r.rating >= 4.0""",
    "latencies": "SELECT CAST(user_id AS INT) AS user_id, value AS ms FROM events",
    "sampled": """SELECT user_id FROM (SELECT DISTINCT user_id FROM latencies) AS t
        ORDER BY (CAST(user_id AS BIGINT) * 7919 + 42) % 10007, user_id LIMIT 20""",
}

def _needs(name: str) -> list[str]:
    """The other views that a view reads."""
    words = set(re.findall(r"\w+", VIEWS[name]))
    return [other for other in VIEWS if other != name and other in words]


def _with(names: str, body: str) -> str:
    """``body`` behind the views it needs, given by name."""
    wanted: set[str] = set()
    queue = names.split()
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += _needs(name)
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in wanted) + "\n" + body


_TITLE_YEAR = r"^(.*)\s+\((\d{4})\)$"
_TITLE = f"""CASE WHEN regexp_matches(title, '{_TITLE_YEAR}') THEN regexp_extract(title, '{_TITLE_YEAR}', 1)
    WHEN title IS NULL OR title = '' THEN 'Untitled' ELSE title END"""
_YEAR = f"COALESCE(regexp_extract(title, '{_TITLE_YEAR}', 2), '')"


def _genre_text(most: int) -> str:
    kept = f"list_filter(string_split(genres, '|'), lambda g: g <> '' AND g <> '(no genres listed)')[1:{most}]"
    return f"COALESCE(NULLIF(array_to_string({kept}, ', '), ''), 'Genres unavailable')"


def _meta(most: int) -> str:
    return f"concat_ws(' • ', NULLIF({_YEAR}, ''), {_genre_text(most)})"


def _rejection(fields: list[tuple[str, str, str]]) -> str:
    whens = [f"WHEN {' OR '.join(f'{name} IS NULL' for name, _, _ in fields)} THEN 'null'"]
    whens += [f"WHEN NOT regexp_matches(trim({n}), '{pattern}') THEN 'malformed {n}'" for n, pattern, _ in fields]
    whens += [f"WHEN TRY_CAST(trim({n}) AS {kind}) IS NULL THEN 'out of range {n}'" for n, _, kind in fields]
    return f"CASE {' '.join(whens)} ELSE 'kept' END"


_WHOLE = "^[0-9]+$"
_MOVIE_REJECTION = _rejection([("movieId", _WHOLE, "INTEGER")])
_RATING_REJECTION = _rejection(
    [("userId", _WHOLE, "INTEGER"), ("movieId", _WHOLE, "INTEGER"), ("rating", "^[0-9]+([.][0-9]+)?$", "FLOAT")]
)


def _upserted_factors(view: str, key: str) -> str:
    return _with(
        view,
        f"""SELECT {key}, CAST(len(features) AS INT) AS length, round(list_sum(features), 6) AS total, loaded_at FROM (
        SELECT COALESCE(n.{key}, o.{key}) AS {key}, COALESCE(n.features, o.features) AS features,
               CASE WHEN o.{key} IS NULL THEN 2 ELSE 1 END AS loaded_at
        FROM {view} AS o
        FULL OUTER JOIN (SELECT {key} + 100 AS {key}, list_transform(features, lambda x: x * 2) AS features FROM {view}) AS n
        ON n.{key} = o.{key}) AS t""",
    )


def _violations(table: str, source: str, **checks: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{name.replace('__', ' ')}' AS "check", CAST({amount} AS BIGINT) AS violations {source}"""
        for name, amount in checks.items()
    )


def _repeated(table: str, view: str, key: str) -> str:
    copies = f"(SELECT COUNT(*) AS c FROM {view} GROUP BY {key}) AS t"
    return _violations(table, f"FROM {copies}", repeated__key="COUNT(*) FILTER (WHERE c > 1)")


def _factor_violations(table: str, view: str, key: str, dim: int) -> str:
    rows = _violations(
        table,
        f"FROM {view}",
        empty="CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
        **{f"null__key__{key}": f"COUNT(*) FILTER (WHERE {key} IS NULL)"},
        null__features="COUNT(*) FILTER (WHERE features IS NULL)",
        vector__length__features=f"COUNT(*) FILTER (WHERE len(features) <> {dim})",
    )
    return rows + " UNION ALL " + _repeated(table, view, key)


_RATING_VIOLATIONS = " UNION ALL ".join(
    [
        _violations(
            "ratings",
            "FROM suspect",
            empty="CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
            null__key__user_id="COUNT(*) FILTER (WHERE user_id IS NULL)",
            null__key__movie_id="COUNT(*) FILTER (WHERE movie_id IS NULL)",
            null__rating="COUNT(*) FILTER (WHERE rating IS NULL)",
            out__of__range__rating="COUNT(*) FILTER (WHERE rating < 0.5 OR rating > 5)",
            orphan__movie_id="COUNT(*) FILTER (WHERE movie_id NOT IN (SELECT movie_id FROM movies))",
        ),
        _repeated("ratings", "suspect", "user_id, movie_id"),
    ]
)
_MOVIE_VIOLATIONS = " UNION ALL ".join(
    [
        _violations(
            "movies",
            "FROM suspect_movies",
            empty="CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
            null__key__movie_id="COUNT(*) FILTER (WHERE movie_id IS NULL)",
            null__title="COUNT(*) FILTER (WHERE title IS NULL)",
        ),
        _repeated("movies", "suspect_movies", "movie_id"),
        _violations(
            "no_movies",
            "FROM no_movies",
            empty="CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END",
            null__key__movie_id="COUNT(*) FILTER (WHERE movie_id IS NULL)",
        ),
        _repeated("no_movies", "no_movies", "movie_id"),
    ]
)


def _sets(view: str) -> str:
    return f"""SELECT user_id, CAST(movie_id // 65536 AS BIGINT) AS chunk, CAST(COUNT(DISTINCT movie_id) AS INT) AS size,
        array_to_string(list_sort(list(DISTINCT movie_id)), ',') AS items FROM {view} GROUP BY 1, 2"""


_SHARED = """COALESCE(array_to_string(list_sort(list_intersect(string_split(b.genres, '|'), string_split(m.genres, '|'))), ', '), '')"""


def _reasons(best: str) -> str:
    return f"""SELECT c.user_id, c.movie_id AS target_id, CAST(b.position AS INT) AS position, b.movie_id, b.title, b.rating, {_SHARED} AS shared_genres
        FROM customer_cosine_top c LEFT JOIN movies m ON m.movie_id = c.movie_id JOIN ({best}) AS b ON b.user_id = c.user_id"""


_BEST_ORDER = "rating DESC, rated_at DESC NULLS LAST, movie_id"
_TOP_LIKED = f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {_BEST_ORDER}) AS position
    FROM liked) AS l WHERE position <= 3"""


def _rank_value(p: float, rank: str) -> str:
    return f"MAX(CASE WHEN rn = {rank.format(p=f'CAST({p} AS DOUBLE)')} THEN ms END)"


_FLOOR = "LEAST(n, CAST(floor(n * {p}) AS BIGINT) + 1)"
_NEAREST = "GREATEST(1, CAST(ceil({p} * n) AS BIGINT))"


def _overall(source: str) -> str:
    return f"""SELECT COUNT(DISTINCT user_id) AS users_sampled, COUNT(*) AS total_runs,
        {_rank_value(0.5, _NEAREST)} AS p50_ms, {_rank_value(0.95, _NEAREST)} AS p95_ms,
        {_rank_value(0.99, _NEAREST)} AS p99_ms, round(AVG(ms), 6) AS avg_ms
        FROM (SELECT user_id, ms, ROW_NUMBER() OVER (ORDER BY ms) AS rn, COUNT(*) OVER () AS n
              FROM {source} WHERE ms IS NOT NULL) AS t"""


# An exact average in hundredths, halves to even.
_AVG_MS = """(SUM(CAST(round(ms * 100) AS BIGINT)) // COUNT(*)
    + CASE WHEN 2 * (SUM(CAST(round(ms * 100) AS BIGINT)) % COUNT(*)) > COUNT(*) THEN 1
           WHEN 2 * (SUM(CAST(round(ms * 100) AS BIGINT)) % COUNT(*)) = COUNT(*)
                AND (SUM(CAST(round(ms * 100) AS BIGINT)) // COUNT(*)) % 2 = 1 THEN 1 ELSE 0 END) / CAST(100 AS DOUBLE)"""

_COUNTED_USERS = """SELECT u.user_id, COUNT(r.user_id) AS rating_count
    FROM user_factors u LEFT JOIN {ratings} r ON r.user_id = u.user_id GROUP BY u.user_id"""

ORACLE: dict[str, str] = {
    "clean_movies": _with(
        "dirty_movies",
        """SELECT TRY_CAST(trim(movieId) AS INTEGER) AS movieId, COALESCE(title, 'Unknown') AS title,
        COALESCE(genres, 'Unknown') AS genres FROM dirty_movies
        WHERE regexp_matches(trim(movieId), '^[0-9]+$') AND TRY_CAST(trim(movieId) AS INTEGER) IS NOT NULL""",
    ),
    "clean_ratings": _with("cleaned_ratings", "SELECT * FROM cleaned_ratings"),
    "cleaning_counts": _with(
        "dirty_movies dirty_ratings",
        f"""SELECT 'movies' AS "table", {_MOVIE_REJECTION} AS outcome, COUNT(*) AS rows FROM dirty_movies GROUP BY 2
        UNION ALL SELECT 'ratings', {_RATING_REJECTION}, COUNT(*) FROM dirty_ratings GROUP BY 2""",
    ),
    "null_counts": _with(
        "cleaned_ratings",
        " UNION ALL ".join(
            f"""SELECT 'ratings' AS "table", '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM cleaned_ratings"""
            for c in ("userId", "movieId", "rating", "timestamp")
        ),
    ),
    "item_support": _with("ratings_raw", "SELECT movie_id, COUNT(*) AS support FROM ratings_raw GROUP BY movie_id"),
    "min_support": _with(
        "ratings_raw",
        """SELECT * FROM ratings_raw WHERE movie_id IN
        (SELECT movie_id FROM ratings_raw GROUP BY movie_id HAVING COUNT(*) >= 30)""",
    ),
    "epoch_to_time": _with(
        "cleaned_ratings", "SELECT userId, movieId, timestamp, make_timestamp(timestamp * 1000000) AS rated_at FROM cleaned_ratings"
    ),
    "last_write_wins": _with("ratings", "SELECT * FROM ratings"),
    "upsert_movies": _with(
        "movies",
        """SELECT movie_id + 100 AS movie_id, CONCAT('New ', title) AS title, CAST(NULL AS VARCHAR) AS genres FROM movies
        UNION ALL SELECT movie_id, title, genres FROM movies WHERE movie_id NOT IN (SELECT movie_id + 100 FROM movies)""",
    ),
    "upsert_ratings": _with(
        "ratings_raw",
        """SELECT user_id, movie_id, rating, rated_at FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, movie_id
                                     ORDER BY o_orderstatus <> 'F' DESC, rated_at DESC, rating DESC) AS rn
        FROM (SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS movie_id,
              CEIL(l_quantity / 5) / 2 AS rating, {rated_at} AS rated_at, o_orderstatus
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS r) AS t WHERE rn = 1""".format(**RAW_RATING),
    ),
    "upsert_user_factors": _upserted_factors("user_factors", "user_id"),
    "upsert_movie_factors": _upserted_factors("movie_factors", "movie_id"),
    "contract_report": _with(
        "suspect movies suspect_movies no_movies suspect_users suspect_items",
        " UNION ALL ".join(
            [
                _RATING_VIOLATIONS,
                _MOVIE_VIOLATIONS,
                _factor_violations("user_factors", "suspect_users", "user_id", 64),
                _factor_violations("movie_factors", "suspect_items", "movie_id", 63),
            ]
        ),
    ),
    "orphan_ratings": _with(
        "suspect movies",
        """SELECT movie_id, COUNT(*) AS rows FROM suspect
        WHERE movie_id NOT IN (SELECT movie_id FROM movies) GROUP BY movie_id""",
    ),
    "refused_ratings": _with(
        "suspect",
        """SELECT *, CASE WHEN user_id IS NULL THEN 'null key user_id' WHEN rating IS NULL THEN 'null rating'
        ELSE 'out of range rating' END AS broken_rule
        FROM suspect WHERE user_id IS NULL OR rating IS NULL OR rating < 0.5 OR rating > 5""",
    ),
    "checked_scan": "SELECT p_partkey, p_name, p_type FROM part",
    "factor_scan": """SELECT vec_id AS id, CAST(len(embedding) AS INT) AS length,
        round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
    "vector_lengths": _with(
        "movie_factors", "SELECT CAST(len(features) AS INT) AS length, COUNT(*) AS vectors FROM movie_factors GROUP BY 1"
    ),
    "vector_texts": _with(
        "movie_factors",
        "SELECT movie_id, CAST(len(features) AS INT) AS length, round(list_sum(features), 6) AS total FROM movie_factors",
    ),
    "synthetic_check": _with(
        "damaged",
        " UNION ALL ".join(
            [
                _violations(
                    "movie_factors",
                    "FROM damaged",
                    record__count="ABS(COUNT(*) - (SELECT COUNT(*) FROM part))",
                    null__id="COUNT(*) FILTER (WHERE id IS NULL)",
                    id__not__in__1__n="COUNT(*) FILTER (WHERE id < 1 OR id > (SELECT COUNT(*) FROM part))",
                    null__features="COUNT(*) FILTER (WHERE lost)",
                    vector__length__features="COUNT(*) FILTER (WHERE short)",
                    out__of__range__features="COUNT(*) FILTER (WHERE shifted)",
                ).replace("'id not in 1 n'", "'id not in 1..n'"),
                _repeated("movie_factors", "damaged", "id").replace("'repeated key'", "'repeated id'"),
            ]
        ),
    ),
    "split_arithmetic": _with(
        "ratings_raw", f"SELECT *, CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS part FROM ratings_raw"
    ),
    # Whatever a seed draws: no row is lost, no key is divided, and the parts have their shares.
    **{
        name: _with(
            view,
            f"""SELECT CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS keys, CAST(0 AS BIGINT) AS divided_keys, TRUE AS share_sound
            FROM (SELECT user_id, movie_id, COUNT(*) AS n FROM {view} GROUP BY user_id, movie_id) AS t""",
        )
        for name, view in (("split_hash", "ratings_raw"), ("split_random", "ratings_eval"))
    },
    # The model predicts for every test rating whose user and movie it was trained on, and the exported vectors say the same.
    "als_predictions": _with(
        "customer_train customer_test",
        """SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS off FROM customer_test
        WHERE user_id IN (SELECT user_id FROM customer_train) AND movie_id IN (SELECT movie_id FROM customer_train)""",
    ),
    "cleaning_pipeline": _with(
        "cleaned_ratings",
        """SELECT * FROM cleaned_ratings
        WHERE movieId IN (SELECT movieId FROM cleaned_ratings GROUP BY movieId HAVING COUNT(*) >= 5)""",
    ),
    "prepared_ratings": _with(
        "cleaned_ratings",
        """SELECT r.* FROM cleaned_ratings r JOIN (SELECT movieId, COUNT(*) AS n FROM cleaned_ratings GROUP BY movieId) AS s
        ON s.movieId = r.movieId WHERE s.n >= 5""",
    ),
    "training_pipeline": _with(
        "customer_train customer_test",
        """SELECT (SELECT COUNT(DISTINCT user_id) FROM customer_train) AS user_vectors,
        (SELECT COUNT(DISTINCT movie_id) FROM customer_train) AS movie_vectors,
        (SELECT COUNT(DISTINCT user_id) FROM customer_test WHERE rating >= 4.0
         AND user_id IN (SELECT user_id FROM customer_train)
         AND movie_id IN (SELECT movie_id FROM customer_train)) AS judged_users""",
    ),
    # The rows of the exact search are counted; the rest is what the indexed one promises.
    "lsh_recall": _with(
        "cosine_top",
        """SELECT COUNT(DISTINCT user_id) AS users, COUNT(*) AS exact_rows, TRUE AS recall_sound,
        CAST(0 AS BIGINT) AS other_scores, TRUE AS fewer_pairs FROM cosine_top""",
    ),
    **{
        name: _with(view, f"SELECT user_id, movie_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM {view}")
        for name, view in (("pruned_topk", "clustered_top"), ("pruned_topk_dot", "clustered_top_dot"))
    },
    "pruned_share": """SELECT (SELECT COUNT(*) FROM customer) AS users, (SELECT COUNT(*) FROM part) AS items, TRUE AS pruned""",
    # Every user that was trained on solves its equations, and folding in gives the same vector.
    "als_residuals": _with(
        "customer_train",
        """SELECT COUNT(DISTINCT user_id) AS users, COUNT(*) AS ratings, CAST(0 AS BIGINT) AS unsolved, CAST(0 AS BIGINT) AS apart
        FROM customer_train""",
    ),
    "relevant_items": _with("relevant", _sets("relevant")),
    "train_items": _with("train", _sets("train")),
    "topk_dot_excluding": _with(
        "unseen_top", "SELECT user_id, movie_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM unseen_top"
    ),
    "user_metrics": _with(
        "per_user",
        """SELECT user_id, relevant, hits, round(precision, 6) AS precision, hit, round(recall, 6) AS recall,
        round(ndcg, 6) AS ndcg FROM per_user""",
    ),
    "metrics_of_lists": _with(
        "per_user",
        """SELECT user_id, round(precision, 6) AS precision, hit, round(recall, 6) AS recall, round(ndcg, 6) AS ndcg
        FROM per_user""",
    ),
    "similarity_of_pairs": _with(
        "customer_cosine_top",
        """SELECT user_id, movie_id, round(score, 6) AS similarity, round(1 - score, 6) AS distance
        FROM customer_cosine_top""",
    ),
    "precision_recall_hit": _with(
        "per_user",
        """SELECT round(AVG(precision), 6) AS precision, round(AVG(hit), 6) AS hit_rate, round(AVG(recall), 6) AS recall,
        COUNT(*) AS users FROM per_user""",
    ),
    "ndcg": _with("per_user", "SELECT round(AVG(ndcg), 6) AS ndcg, COUNT(*) AS users FROM per_user"),
    "predicted_ratings": _with(
        "predicted", "SELECT user_id, movie_id, rating, round(prediction, 6) AS prediction FROM predicted"
    ),
    "rmse_table": _with(
        "predicted",
        "SELECT round(sqrt(AVG((prediction - rating) * (prediction - rating))), 6) AS rmse, COUNT(*) AS rows FROM predicted",
    ),
    "recommended_and_liked": _with(
        "user_factors movie_factors test",
        """SELECT user_id, 'recommended' AS list, CAST(rank AS INT) AS position, movie_id FROM (
        SELECT u.user_id, m.movie_id, ROW_NUMBER() OVER (PARTITION BY u.user_id
            ORDER BY list_dot_product(u.features, m.features) DESC, m.movie_id) AS rank
        FROM user_factors u CROSS JOIN movie_factors m WHERE u.user_id IN (SELECT user_id FROM test)) AS t WHERE rank <= 10
        UNION ALL
        SELECT DISTINCT user_id, 'liked', CAST(NULL AS INT), movie_id FROM test
        WHERE rating >= 4.0 AND user_id IN (SELECT user_id FROM user_factors)""",
    ),
    "recommend_cosine": _with(
        "cosine_top movies",
        """SELECT c.user_id, CAST(c.rank AS INT) AS rank, c.movie_id, m.title, m.genres, round(c.score, 6) AS similarity
        FROM cosine_top c JOIN movies m ON m.movie_id = c.movie_id""",
    ),
    "recommendation_cards": _with(
        "cosine_top movies",
        f"""SELECT user_id, CAST(rank AS INT) AS rank, movie_id, {_TITLE} AS title, {_YEAR} AS year, {_genre_text(3)} AS genre_text,
        CAST(round_even(GREATEST(0, LEAST(1, score)) * 100, 0) AS INT) AS match_percent,
        CASE WHEN rank <= 5 THEN 'shown' ELSE 'more' END AS section
        FROM cosine_top JOIN movies USING (movie_id)""",
    ),
    "recommend_customers": _with(
        "customer_cosine_top movies",
        """SELECT c.user_id, CAST(c.rank AS INT) AS rank, c.movie_id, m.title, m.genres, round(c.score, 6) AS similarity
        FROM customer_cosine_top c JOIN movies m ON m.movie_id = c.movie_id""",
    ),
    "customer_topk_dot_excluding": _with(
        "customer_unseen_top",
        "SELECT user_id, movie_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM customer_unseen_top",
    ),
    "customer_metrics": _with(
        "customer_per_user",
        """SELECT user_id, relevant, hits, round(precision, 6) AS precision, hit, round(recall, 6) AS recall,
        round(ndcg, 6) AS ndcg FROM customer_per_user""",
    ),
    "customer_mean_metrics": _with(
        "customer_per_user",
        """SELECT round(AVG(precision), 6) AS precision, round(AVG(hit), 6) AS hit_rate, round(AVG(recall), 6) AS recall,
        round(AVG(ndcg), 6) AS ndcg, COUNT(*) AS users FROM customer_per_user""",
    ),
    "customer_predicted_ratings": _with(
        "customer_predicted", "SELECT user_id, movie_id, rating, round(prediction, 6) AS prediction FROM customer_predicted"
    ),
    "customer_rmse": _with(
        "customer_predicted",
        """SELECT round(sqrt(AVG((prediction - rating) * (prediction - rating))), 6) AS rmse, COUNT(*) AS rows
        FROM customer_predicted""",
    ),
    "customer_relevant_items": _with("customer_relevant", _sets("customer_relevant")),
    "customer_train_items": _with("customer_train", _sets("customer_train")),
    "explain_pairs": _with("customer_cosine_top liked movies", _reasons(_TOP_LIKED)),
    "explain_pairs_sharing": _with(
        "customer_cosine_top liked movies",
        f"""SELECT user_id, target_id, CAST(position AS INT) AS position, movie_id, title, rating, shared_genres FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, target_id ORDER BY {_BEST_ORDER}) AS position FROM (
        SELECT c.user_id, c.movie_id AS target_id, b.movie_id, b.title, b.rating, b.rated_at, {_SHARED} AS shared_genres
        FROM customer_cosine_top c JOIN movies m ON m.movie_id = c.movie_id JOIN liked b ON b.user_id = c.user_id) AS s
        WHERE shared_genres <> '') AS t WHERE position <= 3""",
    ),
    "user_history": _with("history", "SELECT * FROM history"),
    "history_pages": _with(
        "history",
        f"""SELECT user_id, position, CAST((position - 1) // 5 + 1 AS BIGINT) AS page,
        (COUNT(*) OVER (PARTITION BY user_id) + 4) // 5 AS pages, movie_id, {_TITLE} AS title, {_meta(2)} AS meta,
        printf('%.1f', rating) AS rating_text FROM history""",
    ),
    "user_stats": _with(
        "ratings movies",
        """, known AS (SELECT r.user_id, CAST(round(r.rating * 10) AS BIGINT) AS tenths, m.genres
                FROM ratings r JOIN movies m ON m.movie_id = r.movie_id),
        totals AS (SELECT user_id, COUNT(*) AS n, CAST(SUM(tenths) AS BIGINT) AS s FROM known GROUP BY user_id),
        genres AS (SELECT user_id, genre, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY c DESC, genre) AS place FROM (
            SELECT user_id, genre, COUNT(*) AS c FROM (SELECT user_id, unnest(string_split(genres, '|')) AS genre FROM known) AS e
            GROUP BY user_id, genre) AS g)
        SELECT e.user_id, COALESCE(t.n, 0) AS ratings_count,
        ((2 * t.s + t.n) // (2 * t.n)) / CAST(10 AS DOUBLE) AS avg_score, g.genre AS top_affinity
        FROM (SELECT CAST(c_custkey AS INT) AS user_id FROM customer
              UNION ALL SELECT CAST(c_custkey + 100000000 AS INT) FROM customer) AS e
        LEFT JOIN totals t ON t.user_id = e.user_id
        LEFT JOIN genres g ON g.user_id = e.user_id AND g.place = 1""",
    ).replace("\n, known", ",\nknown"),
    "rating_counts": _with(
        "ratings_raw",
        "SELECT user_id, COUNT(*) AS rating_count, COUNT(*) < 5 AS cold_start FROM ratings_raw GROUP BY user_id",
    ),
    "all_users": _with(
        "user_factors ratings",
        _COUNTED_USERS.format(ratings="ratings") + " ORDER BY 1 LIMIT 500",
    ),
    "user_picker": _with(
        "user_factors ratings",
        f"""SELECT user_id, CONCAT('User ', user_id, '  ·  ', rating_count, ' ratings') AS label
        FROM ({_COUNTED_USERS.format(ratings="ratings")}) AS t ORDER BY user_id LIMIT 500""",
    ),
    "genre_distribution": _with("distribution", "SELECT user_id, genre, genre_count, percentage, rank FROM distribution"),
    "taste_shares": _with(
        "distribution",
        """SELECT user_id, rank, genre, CAST(LEAST(100, percentage) AS INT) AS percent,
        round((upto - share) / whole * 360, 2) AS start_degree, round(upto / whole * 360, 2) AS end_degree
        FROM (SELECT *, CAST(percentage AS DOUBLE) AS share,
              SUM(CAST(percentage AS DOUBLE)) OVER (PARTITION BY user_id) AS whole,
              SUM(CAST(percentage AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY rank) AS upto FROM distribution) AS t""",
    ),
    "user_movie_rating": _with(
        "customer_cosine_top ratings",
        """SELECT c.user_id, c.movie_id, r.rating FROM customer_cosine_top c
        LEFT JOIN ratings r ON r.user_id = c.user_id AND r.movie_id = c.movie_id""",
    ),
    "trending": _with(
        "ratings movies",
        """SELECT movie_id, title, genres, ((2 * s + n) // (2 * n)) / CAST(10 AS DOUBLE) AS avg_rating, n AS rating_count
        FROM (SELECT m.movie_id, m.title, m.genres, CAST(SUM(CAST(round(r.rating * 10) AS BIGINT)) AS BIGINT) AS s, COUNT(r.rating) AS n
              FROM movies m JOIN ratings r ON r.movie_id = m.movie_id
              GROUP BY m.movie_id, m.title, m.genres HAVING COUNT(r.rating) >= 30) AS t
        ORDER BY avg_rating DESC, rating_count DESC, movie_id LIMIT 10""",
    ),
    "search_title": _with(
        "movies", "SELECT movie_id, title, genres FROM movies WHERE title ILIKE '%RED%' ORDER BY title, movie_id LIMIT 20"
    ),
    "search_genre": _with(
        "movies", "SELECT movie_id, title, genres FROM movies WHERE genres ILIKE '%small%' ORDER BY title, movie_id LIMIT 30"
    ),
    "search_title_genre": _with(
        "movies",
        """SELECT movie_id, title, genres FROM movies WHERE title ILIKE '%ring%' AND genres ILIKE '%economy%'
        ORDER BY title, movie_id LIMIT 20""",
    ),
    "search_files": _with(
        "movies",
        """SELECT title, genre, movies, TRUE AS few_files FROM (
        SELECT 'RED' AS title, NULL AS genre, COUNT(*) AS movies FROM movies WHERE title ILIKE '%RED%'
        UNION ALL SELECT NULL, 'small', COUNT(*) FROM movies WHERE genres ILIKE '%small%'
        UNION ALL SELECT 'ring', 'economy', COUNT(*) FROM movies WHERE title ILIKE '%ring%' AND genres ILIKE '%economy%') AS t""",
    ),
    "search_none": _with("movies", "SELECT movie_id, title, genres FROM movies ORDER BY title, movie_id LIMIT 20"),
    "movie_cards": _with(
        "movies",
        f"""SELECT movie_id, {_TITLE} AS title, {_YEAR} AS year, {_meta(3)} AS meta
        FROM (SELECT * FROM movies WHERE genres ILIKE '%promo%' ORDER BY title, movie_id LIMIT 30) AS t""",
    ),
    "all_genres": _with(
        "movies",
        """SELECT DISTINCT genre FROM (SELECT unnest(string_split(genres, '|')) AS genre FROM movies) AS g
        WHERE genre <> '' ORDER BY genre""",
    ),
    "movie_details": _with("movies", "SELECT movie_id, title, genres FROM movies"),
    "title_year": _with("movies", f"SELECT movie_id, {_TITLE} AS title, {_YEAR} AS year FROM movies"),
    "genre_text": _with("movies", f"SELECT movie_id, {_genre_text(3)} AS genre_text FROM movies"),
    "health": _with(
        "user_factors movie_factors ratings",
        """SELECT (SELECT COUNT(*) FROM user_factors) AS total_users, (SELECT COUNT(*) FROM movie_factors) AS total_movies,
        (SELECT COUNT(*) FROM ratings) AS total_ratings,
        CASE WHEN (SELECT COUNT(*) FROM movie_factors) > 0 THEN 'present' ELSE 'missing' END AS index_status""",
    ),
    "health_cards": _with(
        "user_factors movie_factors ratings",
        """SELECT format('{:,}', (SELECT COUNT(*) FROM user_factors)) AS total_users,
        format('{:,}', (SELECT COUNT(*) FROM movie_factors)) AS total_movies,
        format('{:,}', (SELECT COUNT(*) FROM ratings)) AS total_ratings,
        CASE WHEN (SELECT COUNT(*) FROM movie_factors) > 0 THEN 'present' ELSE 'missing' END AS index_status""",
    ),
    "latency_floor_index": _with(
        "latencies",
        f"""SELECT user_id, COUNT(*) AS runs, {_AVG_MS} AS avg_ms, {_rank_value(0.5, _FLOOR)} AS p50_ms,
        {_rank_value(0.95, _FLOOR)} AS p95_ms, {_rank_value(0.99, _FLOOR)} AS p99_ms
        FROM (SELECT user_id, ms, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ms) AS rn,
              COUNT(*) OVER (PARTITION BY user_id) AS n FROM latencies WHERE ms IS NOT NULL) AS t GROUP BY user_id""",
    ),
    "latency_nearest_rank": _with("latencies", _overall("latencies")),
    "sample_users": _with("sampled", "SELECT user_id FROM sampled"),
    "latency_of_sample": _with(
        "latencies sampled", _overall("(SELECT * FROM latencies WHERE user_id IN (SELECT user_id FROM sampled)) AS l")
    ),
}
ORACLE["publish_pipeline"] = ORACLE["upsert_ratings"]
ORACLE |= {f"{name}_indexed": ORACLE[name] for name in ("search_title", "search_genre", "search_title_genre")}
ORACLE["cleaned_movie_files"] = ORACLE["clean_movies"]
ORACLE["synthetic_vectors"] = f"SELECT CAST(p_partkey + 1 AS INT) AS id, {_synthetic_vector('(p_partkey + 1)', 50, 43)} AS features FROM part"
# Lines with a field too many, with one cut off and with an open quote.
ORACLE["damaged_lines"] = """SELECT outcome, COUNT(*) AS lines, SUM(parts) AS parts FROM (
    SELECT CASE WHEN l_orderkey % 10 < 3 THEN 'damaged' ELSE 'sound' END AS outcome,
        CASE WHEN l_orderkey % 10 >= 3 THEN l_partkey END AS parts FROM lineitem) AS t GROUP BY outcome"""
ORACLE["item_overlap"] = _with(
    "train relevant",
    """SELECT user_id, COUNT(t) AS in_a, COUNT(r) AS in_b, COUNT(CASE WHEN t IS NOT NULL AND r IS NOT NULL THEN 1 END) AS in_both,
    COUNT(*) AS in_either FROM (
        SELECT COALESCE(a.user_id, b.user_id) AS user_id, a.movie_id AS t, b.movie_id AS r
        FROM (SELECT DISTINCT user_id, movie_id FROM train) AS a
        FULL JOIN (SELECT DISTINCT user_id, movie_id FROM relevant) AS b ON a.user_id = b.user_id AND a.movie_id = b.movie_id
    ) AS pairs GROUP BY user_id""",
)
ORACLE["stored_report"] = ORACLE["latency_nearest_rank"]
ORACLE |= {f"{name}_sketched": ORACLE[name] for name in ("latency_floor_index", "latency_nearest_rank")}
