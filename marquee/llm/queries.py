"""The operators as registered queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm.workers import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]):
    """Register a query under its function's name; it gets the session and a reader of tables."""

    def ask(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return build(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    QUERIES[build.__name__] = ask
    return build


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op3_simhash(spark, table):
    from marquee.llm.simhash import near_duplicate_classes

    return near_duplicate_classes(table("documents"), words=3, radius=3)


@query
def op4_bpe(spark, table):
    from marquee.llm.bpe import Codec

    codec = Codec.load(spark, tokenizer_file())
    coded = table("documents").select("doc_id", codec.encode(F.col("text")).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(codec.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


def learning_labels(labels: DataFrame) -> DataFrame:
    """The quality labels, but for the held-out third."""
    return labels.select("doc_id", "quality").where(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 == 1


@query
def op7_quality(spark, table):
    from marquee.llm.quality import CompressionClassifier

    docs = table("documents")
    model = CompressionClassifier.fit(docs, learning_labels(table("labels")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op10_sharding(spark, table):
    from marquee.llm.sharding import pack_shards

    return pack_shards(table("documents"), shards=24)


@query
def op6_warc(spark, table):
    from marquee.llm import warc
    from marquee.session import new_folder

    arc, made = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(table("pages"), arc)
    warc.arc_to_warc(spark, arc, made)
    return warc.resolved(warc.read_warc(spark, made))


# DuckDB has no base32: five bits of the digest at a time name a letter.
ORACLE["op6_warc"] = """
WITH digests AS (
    SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes,
        unhex(sha1(COALESCE(html, '')))::BIT::VARCHAR AS bits
    FROM pages
), named AS (
    SELECT page_id, payload_bytes, bits, list_aggregate(list_transform(range(32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_sum(list_transform(range(5), lambda j: (1 << (4 - j)) * CAST(substr(bits, (5 * i + j + 1)::INT, 1) AS INT)))::INT,
        1)), 'string_agg', '') AS payload_digest
    FROM digests
), largest AS (SELECT bits, max(page_id) AS original FROM named GROUP BY bits)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM named JOIN largest USING (bits)
"""


@query
def op9_secrets(spark, table):
    from marquee.llm.secret_scan import find_secrets, spans_text

    found = table("documents").select("doc_id", find_secrets(F.col("text")).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spans_text(F.filter("found", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


@query
def op5_neighbours(spark, table):
    from marquee.llm.neighbours import nearest_neighbours

    return nearest_neighbours(table("embeddings"), F.col("vec_id") % 50 == 0, k=5)


CONTROL_TEXT = r"\### Assistant: </turn> ok"


def with_control_conversation(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """All turns, and conversation -7, whose texts hold control strings."""
    rows = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    own = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(own)


@query
def op2_chat(spark, table):
    from marquee.llm.chat import expand_prefix_targets, parse, trainable

    examples = expand_prefix_targets(with_control_conversation(spark, table("conversations")))
    read = examples.select(
        "conv_id",
        F.length("text").cast("long").alias("formatted"),
        F.struct("example", trainable(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("text")).alias("loss"),
        # The turns themselves are read from the example that holds them all.
        F.when(F.col("is_last"), parse(F.col("text"))).alias("turns"),
    )
    read = read.select(
        "conv_id",
        "formatted",
        "loss",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
    )
    # A row without an id is a conversation of its own.
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("own")
    whole = read.withColumn("own", own).groupBy("conv_id", "own").agg(
        F.max(F.when(F.col("n_turns") >= 0, F.col("n_turns"))).alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "").alias("loss_text"),
        F.sum("formatted").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _shown_length(column: str, *controls: str) -> str:
    """SQL for the escaped length of a column."""
    text = rf"replace({column}, '\', '\\')"
    for control in controls:
        text = f"replace({text}, '{control}', '--')"
    return f"length({text})"


ORACLE["op2_chat"] = rf"""
WITH turns AS (
    SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own, turn,
        COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -7, NULL, 0, 'user', '{CONTROL_TEXT}'
    UNION ALL SELECT -7, NULL, 1, 'assistant', '{CONTROL_TEXT}'
), sized AS (
    SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id, own) AS n_turns,
        sum(4 + {_shown_length("role", "</turn>", "### ", ":")} + 2 + {_shown_length("text", "</turn>", "### ")} + 8) OVER w AS upto
    FROM turns
    WINDOW w AS (PARTITION BY conv_id, own ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, any_value(n_turns) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(COALESCE(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR n = n_turns)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id, own
"""


@query
def op1_urls(spark, table):
    from marquee.llm.url_templates import Rule, filter_urls

    rules = [
        Rule("allow", "org/"),
        Rule("block", "example.org/es/"),
        Rule("block", "example.org/en/1"),
        Rule("allow", "com/fr/"),
        Rule("block", "com/de/"),
    ]
    return filter_urls(table("pages"), rules)


@query
def op8_decontamination(spark, table):
    from marquee.llm.decontamination import Benchmark

    return Benchmark(table("benchmark")).leaks(table("documents"))


@query
def op12_repeats(spark, table):
    from marquee.llm.repeated_spans import without_repeats

    found = without_repeats(table("documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_whitening(spark, table):
    from marquee.llm.whitening import whitened_rows

    return whitened_rows(table("embeddings"))


@query
def op11_fill_in_middle(spark, table):
    from marquee.llm.fill_in_middle import examples, restored

    made = examples(table("documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


# Texts are counted in code points here, as SQL strings are.
ORACLE["op11_fill_in_middle"] = """
WITH drawn AS (
    SELECT doc_id, COALESCE(text, '') AS t, length(COALESCE(text, ''))::BIGINT AS n,
        sha256('1:' || COALESCE(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
        ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS d
    FROM drawn
), parts AS (
    SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m,
        substr(t, greatest(a, b) + 1) AS s,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
            WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""
