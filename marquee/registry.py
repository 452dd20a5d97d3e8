"""Every operator as a named query over a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions import display, ranking
from marquee.functions.vectors import cosine_distance, cosine_similarity, unbroadcast, vector_text
from marquee.operators import cleaning, contracts, keyed, sampling, split
from marquee.operators.fold_in import fold_in
from marquee.operators.item_bitmaps import compared_sets, item_bitmaps
from marquee.operators.item_index import ItemIndex
from marquee.operators.quantile_sketch import quantile_sketches
from marquee.operators.text_index import TextIndex
from marquee.operators.topk import top_k
from marquee.plans import catalog, evaluation, pages, profiles, recommend, reports, training
from marquee.plans.cleaning_run import run_cleaning
from marquee.session import is_kept, new_folder, store_once
from marquee.sources import schemas
from marquee.sources.files import factor_layout, read_checked, read_factors, read_sound_lines
from marquee.sources.proxies import DAMAGED_ID, SUSPECT_MOVIE, SUSPECT_RATING, Proxies, columns
from marquee.sources.sinks import Store, write_report
from marquee.sources.synthetic import with_synthetic_vectors

Query = Callable[[SparkSession, str], DataFrame]

# The vectors of the test tables have 64 elements.
DIM = 64
MIN_RATINGS = 30
# Ratings a movie needs where few of them come through the cleaning.
FEW_RATINGS = 5
# The indexed search must find this share of the exact best ten of the test vectors, which have hardly any structure.
LSH_RECALL = 0.9

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Proxies], DataFrame]) -> Callable[[Proxies], DataFrame]:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Proxies(spark, sf_dir))
    return build


# Folders of indexes that queries of one application share, by application, data folder and name.
_BUILT: dict[tuple[str, str, str], str] = {}


def _built(p: Proxies, name: str, build: Callable[[str], object]) -> str:
    """The folder of an index over a data folder, built by the first query that needs it."""
    key = p.spark.sparkContext.applicationId, p.sf_dir, name
    if not is_kept(_BUILT.get(key)):
        path = new_folder(p.spark, name)
        build(path)
        _BUILT[key] = path
    return _BUILT[key]


def _item_index(p: Proxies) -> ItemIndex:
    return ItemIndex(p.spark, _built(p, "item-index", lambda path: ItemIndex.build(p.movie_factors, path)))


def _clustered_index(p: Proxies) -> ItemIndex:
    return ItemIndex(p.spark, _built(p, "clustered-index", lambda path: ItemIndex.build(p.clustered_parts, path)))


def _text_index(p: Proxies) -> TextIndex:
    return TextIndex(p.spark, _built(p, "text-index", lambda path: TextIndex.build(p.movies, path)))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# Cleaning


@query
def clean_movies(p: Proxies) -> DataFrame:
    return cleaning.clean_movies(p.dirty_movies)


@query
def clean_ratings(p: Proxies) -> DataFrame:
    return cleaning.clean_ratings(p.dirty_ratings)


@query
def cleaning_counts(p: Proxies) -> DataFrame:
    movies = cleaning.cleaning_counts(p.dirty_movies, cleaning.movie_rejection(), "movies")
    return movies.unionByName(cleaning.cleaning_counts(p.dirty_ratings, cleaning.rating_rejection(), "ratings"))


@query
def null_counts(p: Proxies) -> DataFrame:
    return cleaning.null_counts(cleaning.clean_ratings(p.dirty_ratings), "ratings")


@query
def item_support(p: Proxies) -> DataFrame:
    return cleaning.item_support(p.ratings_raw, "movie_id")


@query
def min_support(p: Proxies) -> DataFrame:
    return cleaning.min_support(p.ratings_raw, MIN_RATINGS, "movie_id")


@query
def epoch_to_time(p: Proxies) -> DataFrame:
    clean = cleaning.clean_ratings(p.dirty_ratings)
    time = F.timestamp_seconds("timestamp").cast("timestamp_ntz").alias("rated_at")
    return clean.select("userId", "movieId", "timestamp", time)


# Keyed tables and contracts


@query
def last_write_wins(p: Proxies) -> DataFrame:
    return p.ratings


@query
def upsert_movies(p: Proxies) -> DataFrame:
    """All movies, then all of them again under other ids, with other titles and without genres."""
    incoming = p.movies.select(
        (F.col("movie_id") + 100).alias("movie_id"),
        F.concat(F.lit("New "), "title").alias("title"),
        F.lit(None).cast("string").alias("genres"),
    )
    return keyed.upsert(p.movies, incoming, ["movie_id"])


@query
def upsert_ratings(p: Proxies) -> DataFrame:
    """The ratings of finished orders, then those of all others."""
    key = ["user_id", "movie_id"]
    finished = F.col("o_orderstatus") == "F"
    existing = keyed.newest_ratings(p.ratings_of(finished), key)
    incoming = keyed.newest_ratings(p.ratings_of(~finished), key)
    return keyed.upsert(existing, incoming, key)


def _upsert_factors(factors: DataFrame, id_column: str) -> DataFrame:
    """All vectors, then all of them again doubled and under other ids."""
    incoming = factors.select(
        (F.col(id_column) + 100).alias(id_column),
        F.transform("features", lambda x: x * F.lit(2).cast("float")).alias("features"),
        F.lit(2).alias("loaded_at"),
    )
    merged = keyed.upsert(factors.withColumn("loaded_at", F.lit(1)), incoming, [id_column], ["loaded_at"])
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return merged.select(id_column, F.size("features").alias("length"), F.round(total, 6).alias("total"), "loaded_at")


@query
def upsert_user_factors(p: Proxies) -> DataFrame:
    return _upsert_factors(p.user_factors, "user_id")


@query
def upsert_movie_factors(p: Proxies) -> DataFrame:
    return _upsert_factors(p.movie_factors, "movie_id")


def _suspect_ratings(p: Proxies) -> DataFrame:
    """Ratings that break each rule of the contract: lost users, ratings lost or out of range, unknown movies."""
    return p.ratings_raw.selectExpr(*columns(SUSPECT_RATING))


def _suspect_factors(factors: DataFrame, id_column: str) -> DataFrame:
    """Vectors with ids lost and repeated, and without features."""
    fault = F.col(id_column) % 41
    return factors.select(
        F.when(fault == 0, None).when(fault == 1, 1).otherwise(F.col(id_column)).alias(id_column),
        F.when(fault == 2, None).otherwise(F.col("features")).alias("features"),
    )


@query
def contract_report(p: Proxies) -> DataFrame:
    """Tables with every kind of fault, and one without rows."""
    movies = p.movies.selectExpr(*columns(SUSPECT_MOVIE))
    parts = [
        contracts.check(_suspect_ratings(p), contracts.RATINGS, {"movies": p.movies}),
        contracts.check(movies, contracts.MOVIES),
        contracts.check(movies.filter("title = genres"), contracts.Contract("no_movies", ("movie_id",), ("movie_id",))),
        contracts.check(_suspect_factors(p.user_factors, "user_id"), contracts.factor_contract("user_factors", "user_id", DIM)),
        contracts.check(_suspect_factors(p.movie_factors, "movie_id"), contracts.factor_contract("movie_factors", "movie_id", DIM - 1)),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def orphan_ratings(p: Proxies) -> DataFrame:
    return contracts.orphans_by_key(_suspect_ratings(p), p.movies, "movie_id")


@query
def refused_ratings(p: Proxies) -> DataFrame:
    return contracts.split_valid(_suspect_ratings(p), contracts.RATINGS)[1]


@query
def checked_scan(p: Proxies) -> DataFrame:
    columns = ["p_partkey", "p_name", "p_type"]
    return read_checked(p.spark, f"{p.sf_dir}/part.parquet", "part", columns, "p_partkey").select(*columns)


@query
def factor_scan(p: Proxies) -> DataFrame:
    """Vectors under other column names, read as factors."""
    factors = factor_layout(p.table("embeddings").withColumnRenamed("vec_id", "movieId"))
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return factors.select("id", F.size("features").alias("length"), F.round(total, 6).alias("total"))


@query
def vector_lengths(p: Proxies) -> DataFrame:
    return training.vector_lengths(p.movie_factors)


@query
def vector_texts(p: Proxies) -> DataFrame:
    """The text form of every vector, read back as numbers."""
    read = F.from_json(vector_text(F.col("features"), DIM), "array<double>")
    total = F.aggregate("read", F.lit(0.0), lambda s, x: s + x)
    texts = p.movie_factors.select("movie_id", read.alias("read"))
    return texts.select("movie_id", F.size("read").alias("length"), F.round(total, 6).alias("total"))


@query
def synthetic_vectors(p: Proxies) -> DataFrame:
    return with_synthetic_vectors(p.table("part").select((F.col("p_partkey") + 1).alias("id")), 50, 43)


@query
def synthetic_check(p: Proxies) -> DataFrame:
    """The check of generated vectors, on vectors with every kind of damage."""
    part = p.table("part")
    made = with_synthetic_vectors(part.select((F.col("p_partkey") + 1).alias("id")), 50, 43)
    damaged = made.filter("id % 31 <> 0").select(
        F.expr(DAMAGED_ID).alias("id"),
        F.when(F.col("id") % 23 == 0, None)
        .when(F.col("id") % 17 == 0, F.slice("features", 1, 49))
        .when(F.col("id") % 19 == 0, F.transform("features", lambda x: x + F.lit(3).cast("float")))
        .otherwise(F.col("features"))
        .alias("features"),
    )
    records = part.agg(F.count("*")).scalar()
    return contracts.synthetic_check(damaged, records, 50, "movie_factors")


# Splits, ranking and models


@query
def split_arithmetic(p: Proxies) -> DataFrame:
    train, test = split.split_arithmetic(p.ratings_raw, "user_id", "movie_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _split_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: rows and keys of both parts, keys found in both, and whether the train part has its share."""
    key = ["user_id", "movie_id"]
    tagged = train.select(*key, F.lit(1).alias("_t")).unionByName(test.select(*key, F.lit(0).alias("_t")))
    per_key = tagged.groupBy(*key).agg(F.count("*").alias("n"), F.sum("_t").alias("t"))
    share = F.sum("t") / F.sum("n")
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("keys"),
        F.count_if((F.col("t") > 0) & (F.col("t") < F.col("n"))).alias("divided_keys"),
        (F.abs(share - 0.8) < 0.03).alias("share_sound"),
    )


@query
def split_hash(p: Proxies) -> DataFrame:
    return _split_report(*split.split_hash(p.ratings_raw, ("user_id", "movie_id")))


@query
def split_random(p: Proxies) -> DataFrame:
    return _split_report(*split.split_random(store_once(p.ratings_eval, "ratings_eval")))


def _set_text(pairs: DataFrame) -> DataFrame:
    sets = evaluation.item_sets(pairs)
    return sets.select("user_id", "chunk", F.size("items").alias("size"), F.array_join("items", ",").alias("items"))


@query
def relevant_items(p: Proxies) -> DataFrame:
    return _set_text(evaluation.relevant_pairs(p.eval_split[1], p.movie_factors))


@query
def train_items(p: Proxies) -> DataFrame:
    return _set_text(p.eval_split[0])


@query
def item_overlap(p: Proxies) -> DataFrame:
    """For each user how many items were trained on, how many are relevant, and how many are both or either."""
    train, test = p.eval_split
    return compared_sets(item_bitmaps(train), item_bitmaps(evaluation.relevant_pairs(test, p.movie_factors)))


@query
def topk_dot_excluding(p: Proxies) -> DataFrame:
    train, test = p.eval_split
    relevant = evaluation.relevant_pairs(test, p.movie_factors)
    return _rounded(evaluation.ranked_for_evaluation(p.user_factors, p.movie_factors, train, relevant, 10), "score")


def _user_metrics(p: Proxies) -> DataFrame:
    return evaluation.user_metrics(p.user_factors, p.movie_factors, *p.eval_split, k=10)


@query
def user_metrics(p: Proxies) -> DataFrame:
    return _rounded(_user_metrics(p), "precision", "recall", "ndcg")


@query
def metrics_of_lists(p: Proxies) -> DataFrame:
    """The same metrics from one short list per user and kind."""
    train, test = p.eval_split
    relevant = evaluation.relevant_pairs(test, p.movie_factors)
    ranked = evaluation.ranked_for_evaluation(p.user_factors, p.movie_factors, train, relevant, 10)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("rank", "movie_id"))), lambda x: x["movie_id"])
    lists = relevant.groupBy("user_id").agg(F.collect_set("movie_id").alias("relevant"))
    lists = lists.join(p.user_factors.select("user_id"), "user_id", "left_semi")
    lists = lists.join(ranked.groupBy("user_id").agg(in_order.alias("recommended")), "user_id", "left")
    lists = lists.join(train.groupBy("user_id").agg(F.collect_set("movie_id").alias("train")), "user_id", "left")
    recommended = F.coalesce("recommended", F.slice("relevant", 1, 0))
    metrics = {"precision": ranking.precision_at, "hit": ranking.hit_at, "recall": ranking.recall_at, "ndcg": ranking.ndcg_at}
    found = [m(recommended, F.col("relevant"), F.col("train"), 10).alias(name) for name, m in metrics.items()]
    return _rounded(lists.select("user_id", *found), "precision", "recall", "ndcg")


@query
def precision_recall_hit(p: Proxies) -> DataFrame:
    means = evaluation.mean_metrics(_user_metrics(p))
    return _rounded(means, "precision", "hit_rate", "recall").select("precision", "hit_rate", "recall", "users")


@query
def ndcg(p: Proxies) -> DataFrame:
    return _rounded(evaluation.mean_metrics(_user_metrics(p)), "ndcg").select("ndcg", "users")


@query
def predicted_ratings(p: Proxies) -> DataFrame:
    return _rounded(evaluation.predict(p.eval_split[1], p.user_factors, p.movie_factors), "prediction")


@query
def rmse_table(p: Proxies) -> DataFrame:
    return _rounded(evaluation.rmse(evaluation.predict(p.eval_split[1], p.user_factors, p.movie_factors)), "rmse")


@query
def recommended_and_liked(p: Proxies) -> DataFrame:
    _, test = p.eval_split
    asked = p.user_factors.join(test.select("user_id").distinct(), "user_id", "left_semi")
    return evaluation.recommended_and_liked(top_k(asked, p.movie_factors, 10, "dot", sized_by=p.user_factors), test)


@query
def als_factors(p: Proxies) -> DataFrame:
    users, items = training.factor_tables(training.train_als(p.stored_split[0]))
    users = users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "features")
    return users.unionByName(items.select(F.lit("movie").alias("kind"), F.col("movie_id").alias("id"), "features"))


@query
def als_rmse(p: Proxies) -> DataFrame:
    train, test = p.stored_split
    model = training.train_als(train)
    return evaluation.rmse(model.transform(test.withColumn("rating", F.col("rating").cast("float"))))


@query
def als_ranking(p: Proxies) -> DataFrame:
    train, test = p.stored_split
    users, items = training.factor_tables(training.train_als(train))
    return evaluation.mean_metrics(evaluation.user_metrics(users, items, train, test, k=10))


@query
def als_predictions(p: Proxies) -> DataFrame:
    """The model's score of each test rating beside the product of the exported vectors: rows, and rows that differ."""
    train, test = p.stored_split
    model = training.train_als(train)
    key = ["user_id", "movie_id"]
    scored = model.transform(test.select(*key)).select(*key, F.col("prediction").alias("own"))
    exported = evaluation.predict(test.select(*key), *training.factor_tables(model))
    both = scored.join(exported, key, "full")
    apart = F.abs(F.col("own") - F.col("prediction")) > 1e-4
    return both.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(apart, F.lit(True))).alias("off"))


@query
def als_residuals(p: Proxies) -> DataFrame:
    """The fit against its normal equations: users, their ratings, users whose vector does not solve them, and users
    whose vector the fold-in does not give again."""
    train = p.stored_split[0]
    settings = training.AlsSettings()
    users, items = training.factor_tables(training.train_als(train, settings))
    found = fold_in(train, items, reg=settings.reg_param, alpha=settings.alpha, own=users)
    both = users.withColumnRenamed("features", "trained").join(found, "user_id", "full")
    apart = F.exists(F.zip_with("trained", "features", lambda a, b: F.abs(a.cast("double") - b)), lambda d: d > 1e-3)
    return both.agg(
        F.count("*").alias("users"),
        F.sum("ratings").alias("ratings"),
        F.count_if(F.coalesce(F.col("residual") > 1e-3, F.lit(True))).alias("unsolved"),
        F.count_if(F.coalesce(apart, F.lit(True))).alias("apart"),
    )


# Pipelines from files to files


def _raw_files(p: Proxies) -> str:
    """Dirty text written as CSV."""
    raw = new_folder(p.spark, "raw")
    for name, rows in (("movies", p.dirty_movies), ("ratings", p.dirty_ratings)):
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.write.options(**options).csv(f"{raw}/{name}.csv")
    return raw


@query
def damaged_lines(p: Proxies) -> DataFrame:
    """A CSV file in which every tenth order has a field too many, every tenth one too few, and every tenth an open quote."""
    raw, fault = new_folder(p.spark, "damaged"), F.col("l_orderkey") % 10
    fields = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")]
    line = (
        F.when(fault == 0, F.concat_ws(",", *fields, F.lit("more")))
        .when(fault == 1, F.concat_ws(",", *fields[:3]))
        .when(fault == 2, F.concat(F.lit('"'), F.concat_ws(",", *fields)))
        .otherwise(F.concat_ws(",", *fields))
    )
    p.table("lineitem").select(line.alias("value")).write.text(raw)
    sound, damaged = read_sound_lines(p.spark, raw, schemas.RAW_RATINGS, header=False)
    counts = [F.count("*").alias("lines"), F.sum("parts").alias("parts")]
    found = sound.select(F.col("movieId").cast("bigint").alias("parts")).agg(*counts).select(F.lit("sound").alias("outcome"), "*")
    aside = damaged.select(F.lit(None).cast("bigint").alias("parts")).agg(*counts).select(F.lit("damaged").alias("outcome"), "*")
    return found.unionByName(aside)


@query
def cleaning_pipeline(p: Proxies) -> DataFrame:
    """Raw files cleaned to stored tables, and the ratings read back."""
    _, ratings, _ = run_cleaning(p.spark, _raw_files(p), new_folder(p.spark, "clean"), FEW_RATINGS)
    return p.spark.read.parquet(ratings)


@query
def cleaned_movie_files(p: Proxies) -> DataFrame:
    """The movies that the same run stores."""
    movies, _, _ = run_cleaning(p.spark, _raw_files(p), new_folder(p.spark, "clean"), FEW_RATINGS)
    return p.spark.read.parquet(movies)


@query
def prepared_ratings(p: Proxies) -> DataFrame:
    """What training gets from raw files."""
    return training.prepare_ratings(p.spark, _raw_files(p), FEW_RATINGS)


@query
def training_pipeline(p: Proxies) -> DataFrame:
    """Split, fit, evaluation and export with the published settings: what was stored and how many users were judged."""
    names = {"user_id": "userId", "movie_id": "movieId"}
    ratings = p.ratings.select("user_id", "movie_id", F.col("rating").cast("float")).withColumnsRenamed(names)
    result = training.run_training(ratings, new_folder(p.spark, "model"), split="arithmetic")
    stored = [read_factors(p.spark, result[f"{kind}_factors_path"], kind) for kind in ("user", "movie")]
    users, movies = (f.agg(F.count("*")).scalar() for f in stored)
    return p.spark.range(1).select(
        users.alias("user_vectors"), movies.alias("movie_vectors"), F.lit(result["users"]).cast("bigint").alias("judged_users")
    )


@query
def publish_pipeline(p: Proxies) -> DataFrame:
    """Ratings of finished orders published, those of all others merged into them, and the published table read."""
    store = Store(p.spark, new_folder(p.spark, "tables"))
    key = ["user_id", "movie_id"]
    loaded = F.lit(0).cast("timestamp").alias("loaded_at")
    factors = [f.select("*", loaded) for f in (p.user_factors, p.movie_factors)]
    finished = F.col("o_orderstatus") == "F"
    for orders in (finished, ~finished):
        ratings = keyed.newest_ratings(p.ratings_of(orders), key).select(
            *key, F.col("rating").cast("decimal(2,1)").alias("rating"), F.col("rated_at").cast("timestamp").alias("rated_at")
        )
        store.publish(p.movies.fillna("Unknown", ["genres"]), ratings, *factors, dim=DIM)
    rated_at = F.col("rated_at").cast(p.ratings_raw.schema["rated_at"].dataType).alias("rated_at")
    return store.read("ratings").select(*key, F.col("rating").cast("double").alias("rating"), rated_at)


# The same evaluation of every customer on every part


@query
def customer_relevant_items(p: Proxies) -> DataFrame:
    return _set_text(evaluation.relevant_pairs(p.customer_split[1], p.part_vectors))


@query
def customer_train_items(p: Proxies) -> DataFrame:
    return _set_text(p.customer_split[0])


@query
def customer_topk_dot_excluding(p: Proxies) -> DataFrame:
    train, test = p.customer_split
    relevant = evaluation.relevant_pairs(test, p.part_vectors)
    return _rounded(evaluation.ranked_for_evaluation(p.customer_vectors, p.part_vectors, train, relevant, 10), "score")


def _customer_metrics(p: Proxies) -> DataFrame:
    return evaluation.user_metrics(p.customer_vectors, p.part_vectors, *p.stored_split, k=10)


@query
def customer_metrics(p: Proxies) -> DataFrame:
    return _rounded(_customer_metrics(p), "precision", "recall", "ndcg")


@query
def customer_mean_metrics(p: Proxies) -> DataFrame:
    return _rounded(evaluation.mean_metrics(_customer_metrics(p)), "precision", "hit_rate", "recall", "ndcg")


def _customer_predictions(p: Proxies) -> DataFrame:
    test = p.customer_split[1].select("user_id", "movie_id", "rating")
    return evaluation.predict(test, p.customer_vectors, p.part_vectors)


@query
def customer_predicted_ratings(p: Proxies) -> DataFrame:
    return _rounded(_customer_predictions(p), "prediction")


@query
def customer_rmse(p: Proxies) -> DataFrame:
    return _rounded(evaluation.rmse(_customer_predictions(p)), "rmse")


# Recommendations


def _recommended(p: Proxies) -> DataFrame:
    return recommend.recommendations(p.user_factors, p.movie_factors, p.movies, 10)


@query
def recommend_cosine(p: Proxies) -> DataFrame:
    return _rounded(_recommended(p), "similarity")


@query
def recommend_customers(p: Proxies) -> DataFrame:
    """Every customer against every part; both grow with the tables."""
    return _rounded(recommend.recommendations(p.customer_vectors, p.part_vectors, p.movies, 10), "similarity")


@query
def similarity_of_pairs(p: Proxies) -> DataFrame:
    """The similarity of each customer's ten nearest parts, from the two vectors of the pair."""
    pairs = top_k(p.customer_vectors, p.part_vectors, 10).select("user_id", "movie_id")
    both = pairs.join(unbroadcast(p.customer_vectors), "user_id")
    both = both.join(unbroadcast(p.part_vectors.withColumnRenamed("features", "other")), "movie_id")
    a, b = F.col("features"), F.col("other")
    found = both.select("user_id", "movie_id", cosine_similarity(a, b).alias("similarity"), cosine_distance(a, b).alias("distance"))
    return _rounded(found, "similarity", "distance")


@query
def recommend_lsh(p: Proxies) -> DataFrame:
    """The nearest items through the stored index."""
    return _rounded(_item_index(p).search(p.user_factors, 10), "score")


@query
def lsh_recall(p: Proxies) -> DataFrame:
    """The indexed search beside the exact one: whether it finds enough, with the same scores, from fewer pairs."""
    index = _item_index(p)
    exact = top_k(p.user_factors, p.movie_factors, 10)
    found = index.search(p.user_factors, 10).select("user_id", "movie_id", F.col("score").alias("found"))
    both = exact.join(found, ["user_id", "movie_id"], "left")
    pairs = index.asked_pairs(index.probes(p.user_factors))
    return both.agg(
        F.countDistinct("user_id").alias("users"),
        F.count("*").alias("exact_rows"),
        (F.count("found") >= LSH_RECALL * F.count("*")).alias("recall_sound"),
        F.count_if(F.col("found") != F.col("score")).alias("other_scores"),
        (F.lit(pairs) * 2 < F.countDistinct("user_id") * p.movie_factors.agg(F.count("*")).scalar()).alias("fewer_pairs"),
    )


@query
def pruned_topk(p: Proxies) -> DataFrame:
    """The exact best ten through the index, without the cells that cannot hold any of them."""
    return _rounded(_clustered_index(p).exact(p.clustered_customers, 10), "score")


@query
def pruned_topk_dot(p: Proxies) -> DataFrame:
    return _rounded(_clustered_index(p).exact(p.clustered_customers, 10, "dot"), "score")


@query
def pruned_share(p: Proxies) -> DataFrame:
    """Users and items, and whether less than a third of their pairs was scored for the exact best ten."""
    index = _clustered_index(p)
    scored = index.exact_pairs(p.clustered_customers, 10)
    items = p.clustered_parts.agg(F.count("*").alias("items"))
    users = p.clustered_customers.agg(F.count("*").alias("users"))
    return users.select("users", items.scalar().alias("items"), (F.lit(scored) * 3 < F.col("users") * items.scalar()).alias("pruned"))


@query
def recommendation_cards(p: Proxies) -> DataFrame:
    return pages.recommendation_cards(_recommended(p))


def _reasons(p: Proxies, require_shared: bool) -> DataFrame:
    pairs = top_k(p.customer_vectors, p.part_vectors, 10)
    reasons = recommend.explanations(pairs, p.ratings, p.movies, 3, require_shared)
    return reasons.withColumn("shared_genres", display.readable_list(F.col("shared_genres")))


@query
def explain_pairs(p: Proxies) -> DataFrame:
    return _reasons(p, False)


@query
def explain_pairs_sharing(p: Proxies) -> DataFrame:
    return _reasons(p, True)


# Profiles


@query
def user_history(p: Proxies) -> DataFrame:
    return profiles.history(p.ratings, p.movies, 50)


@query
def history_pages(p: Proxies) -> DataFrame:
    return pages.history_pages(profiles.history(p.ratings, p.movies, 50))


@query
def user_stats(p: Proxies) -> DataFrame:
    """All customers, and as many newcomers who have rated nothing."""
    ids = [(F.col("c_custkey") + shift).cast("int") for shift in (0, 100_000_000)]
    everyone = p.table("customer").select(F.explode(F.array(*ids)).alias("user_id"))
    return profiles.stats(p.ratings, p.movies, everyone)


@query
def rating_counts(p: Proxies) -> DataFrame:
    return profiles.rating_counts(p.ratings_raw)


@query
def all_users(p: Proxies) -> DataFrame:
    return profiles.all_users(p.user_factors, p.ratings, 500)


@query
def user_picker(p: Proxies) -> DataFrame:
    return pages.user_picker(profiles.all_users(p.user_factors, p.ratings, 500))


@query
def genre_distribution(p: Proxies) -> DataFrame:
    return profiles.genre_distribution(p.ratings, p.movies)


@query
def taste_shares(p: Proxies) -> DataFrame:
    return pages.taste_shares(profiles.genre_distribution(p.ratings, p.movies))


@query
def user_movie_rating(p: Proxies) -> DataFrame:
    return profiles.ratings_for_pairs(top_k(p.customer_vectors, p.part_vectors, 10), p.ratings)


# Catalogue


@query
def trending(p: Proxies) -> DataFrame:
    return catalog.trending(p.ratings, p.movies, 10, MIN_RATINGS)


@query
def search_title(p: Proxies) -> DataFrame:
    return catalog.search(p.movies, "RED", 20)


@query
def search_genre(p: Proxies) -> DataFrame:
    return catalog.search(p.movies, None, 30, "small")


@query
def search_title_genre(p: Proxies) -> DataFrame:
    return catalog.search(p.movies, "ring", 20, "economy")


@query
def search_title_indexed(p: Proxies) -> DataFrame:
    return catalog.search_indexed(_text_index(p), "RED", 20)


@query
def search_genre_indexed(p: Proxies) -> DataFrame:
    return catalog.search_indexed(_text_index(p), None, 30, "small")


@query
def search_title_genre_indexed(p: Proxies) -> DataFrame:
    return catalog.search_indexed(_text_index(p), "ring", 20, "economy")


@query
def search_files(p: Proxies) -> DataFrame:
    """For each question whether its postings lie in fewer files than there are."""
    index = _text_index(p)
    asked = [("RED", None), (None, "small"), ("ring", "economy")]
    counts = []
    for title, genre in asked:
        texts = {"title": title, "genres": genre}
        counts.append((title, genre, index.matching(texts).count(), *index.files(texts)))
    frame = p.spark.createDataFrame(counts, "title string, genre string, movies long, files int, all_files int")
    return frame.select("title", "genre", "movies", (F.col("files") * 2 < F.col("all_files")).alias("few_files"))


@query
def search_none(p: Proxies) -> DataFrame:
    return catalog.search(p.movies)


@query
def movie_cards(p: Proxies) -> DataFrame:
    return pages.movie_cards(catalog.search(p.movies, None, 30, "promo"))


@query
def all_genres(p: Proxies) -> DataFrame:
    return catalog.all_genres(p.movies)


@query
def movie_details(p: Proxies) -> DataFrame:
    return catalog.movie_details(p.movies)


@query
def title_year(p: Proxies) -> DataFrame:
    title = F.col("title")
    return p.movies.select("movie_id", display.title_part(title).alias("title"), display.year_part(title).alias("year"))


@query
def genre_text(p: Proxies) -> DataFrame:
    return p.movies.select("movie_id", display.genre_text(F.col("genres"), 3).alias("genre_text"))


# Reports


@query
def health(p: Proxies) -> DataFrame:
    return reports.health(p.user_factors, p.movie_factors, p.ratings)


@query
def health_cards(p: Proxies) -> DataFrame:
    return pages.health_cards(reports.health(p.user_factors, p.movie_factors, p.ratings))


@query
def latency_floor_index(p: Proxies) -> DataFrame:
    return reports.latency_summary(p.latencies)


@query
def latency_floor_index_sketched(p: Proxies) -> DataFrame:
    """The same from a sketch for each user."""
    sketches = store_once(quantile_sketches(p.latencies, ["user_id"], "ms"), "sketches")
    return reports.latency_summary(p.latencies, sketches=sketches)


@query
def latency_nearest_rank(p: Proxies) -> DataFrame:
    return _rounded(reports.latency_report(p.latencies), "avg_ms")


@query
def latency_nearest_rank_sketched(p: Proxies) -> DataFrame:
    """The same from a sketch for each day."""
    return _rounded(reports.latency_report(p.latencies, sketches=p.daily_sketches), "avg_ms")


@query
def stored_report(p: Proxies) -> DataFrame:
    """The report over all measures, written as JSON lines and read back."""
    report, path = reports.latency_report(p.latencies), new_folder(p.spark, "report")
    write_report(report, path)
    return _rounded(p.spark.read.schema(report.schema).json(path), "avg_ms")


@query
def sample_users(p: Proxies) -> DataFrame:
    return sampling.sample_ids(p.latencies, "user_id", 20, draw=sampling.arithmetic_draw("user_id"))


@query
def latency_of_sample(p: Proxies) -> DataFrame:
    return _rounded(reports.latency_report(reports.of_users(p.latencies, sample_users(p))), "avg_ms")
