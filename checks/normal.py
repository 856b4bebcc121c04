"""Splitting wide tables: rows, values, entities and dependencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import table
from millrace.operators.normalise import extract_dependencies, extract_entities, split_values
from millrace.operators.rows import split_to_rows
from millrace.sources.responses import flatten


def split_words(spark, d):
    """N1"""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    return split_to_rows(part, "p_name", " ")


def split_lines(spark, d):
    """Whole texts, every line, empty ones kept"""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return split_to_rows(docs, "text", "\n", keep_empty=True, trim=True)


def _values(spark, d):
    return split_values(table(spark, d, "part"), "p_name", ["p_partkey"], ["p_partkey"], " ")


def extract_values_meta(spark, d):
    """N2 records"""
    return _values(spark, d)[0]


def extract_values_child(spark, d):
    """N2 values, F16"""
    return _values(spark, d)[1]


def _entities(spark, d):
    customers = table(spark, d, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    return extract_entities(customers, ["c_mktsegment", "c_nationkey"], "market_id")


def entity_fact(spark, d):
    """N3 facts"""
    return _entities(spark, d)[0]


def entity_dim(spark, d):
    """N3 entities"""
    return _entities(spark, d)[1]


def entity_natural(spark, d):
    """N3 with an id among the entity's own columns"""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    return extract_entities(items, ["l_suppkey", "l_returnflag"], "l_suppkey", False)[1]


def _dependencies(spark, d):
    return extract_dependencies(
        table(spark, d, "part"), ["p_brand"], ["p_type", "p_size"], "brand", variants_column="n"
    )


def transitive_fact(spark, d):
    """N4 facts"""
    return _dependencies(spark, d)[0]


def transitive_dim(spark, d):
    """N4 lookup"""
    return _dependencies(spark, d)[1]


def thread_responses(spark, d):
    """Every turn of every conversation as a response of two comment threads."""
    turns = table(spark, d, "conversations")

    def thread(ident, text):
        comment = F.struct(
            F.col("conv_id").cast("string").alias("videoId"),
            F.nullif("role", F.lit("system")).alias("authorDisplayName"),
            text.alias("textDisplay"),
            F.col("turn").cast("string").alias("likeCount"),
            F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
        )
        return F.struct(
            ident.alias("id"),
            F.struct(
                F.struct(comment.alias("snippet")).alias("topLevelComment"),
                F.length("text").alias("totalReplyCount"),
            ).alias("snippet"),
        )

    ident = F.concat_ws("-", "conv_id", "turn")
    items = F.array(
        thread(F.concat(F.lit(" "), ident, F.lit("-a ")), F.col("text")),
        thread(F.concat(ident, F.lit("-b")), F.nullif("role", F.lit("user"))),
    )
    return turns.select("role", F.to_json(F.struct(items.alias("items"))).alias("body"))


def flatten_nested(spark, d):
    """S9 F14 P7"""
    return flatten(thread_responses(spark, d), "threads", stamp=["role"])


def flatten_videos(spark, d):
    """Parts as video responses"""
    part = table(spark, d, "part")
    item = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.struct(
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("channelId"),
            F.split("p_name", " ").alias("tags"),
            F.nullif(F.col("p_size").cast("string"), F.lit("7")).alias("categoryId"),
        ).alias("snippet"),
        F.struct(
            F.col("p_partkey").alias("viewCount"),
            F.when(F.col("p_type") == "PROMO", "hidden")
            .otherwise(F.col("p_size").cast("string"))
            .alias("likeCount"),
        ).alias("statistics"),
        F.struct(
            F.concat(F.lit("PT"), "p_size", F.lit("M")).alias("duration"),
            (F.col("p_type") == "LARGE").alias("licensedContent"),
        ).alias("contentDetails"),
    )
    responses = part.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("body"))
    return flatten(responses, "videos")


def _responses(df, item, *stamp):
    """One response for each row."""
    return df.select(*stamp, F.to_json(F.struct(F.array(item).alias("items"))).alias("body"))


def channel_responses(spark, d):
    """Suppliers as channels; every seventh hides its counts."""
    snippet = F.struct(
        F.col("s_name").alias("title"),
        F.when(F.col("s_suppkey") % 5 > 0, F.concat(F.lit(" a\nb "), "s_name")).alias("description"),
        F.when(F.col("s_suppkey") % 3 > 0, F.lit("2010-01-01T00:00:00Z")).alias("publishedAt"),
        F.when(F.col("s_nationkey") > 3, F.col("s_nationkey").cast("string")).alias("country"),
    )
    statistics = F.struct(
        F.col("s_suppkey").cast("string").alias("viewCount"),
        F.when(F.col("s_suppkey") % 7 > 0, F.col("s_nationkey").cast("string")).alias("subscriberCount"),
        F.lit("12").alias("videoCount"),
    )
    item = F.struct(F.concat(F.lit(" s"), "s_suppkey").alias("id"), snippet.alias("snippet"), statistics.alias("statistics"))
    return _responses(table(spark, d, "supplier"), item)


def search_responses(spark, d):
    """Parts as search results, fetched for a category."""
    snippet = F.struct(
        F.col("p_name").alias("title"),
        F.concat(F.col("p_type"), F.lit(', "'), F.col("p_brand"), F.lit('"')).alias("description"),
        F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
        F.col("p_brand").alias("channelId"),
        F.nullif("p_type", F.lit("PROMO")).alias("channelTitle"),
        F.struct(F.struct(F.concat(F.lit("u/"), "p_partkey").alias("url")).alias("high")).alias("thumbnails"),
        F.when(F.col("p_size") % 2 == 0, "live").alias("liveBroadcastContent"),
    )
    item = F.struct(F.struct(F.col("p_partkey").cast("string").alias("videoId")).alias("id"), snippet.alias("snippet"))
    return _responses(table(spark, d, "part"), item, F.col("p_size").cast("string").alias("category_id"))


def category_responses(spark, d):
    """Nations as categories."""
    item = F.struct(
        F.col("n_nationkey").cast("string").alias("id"),
        F.struct(F.when(F.col("n_nationkey") != 2, F.col("n_name")).alias("title")).alias("snippet"),
    )
    return _responses(table(spark, d, "nation"), item)


def comment_responses(spark, d):
    """Line items as replies, fetched for their order as thread."""
    at = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    snippet = F.struct(
        F.concat(F.lit("c"), "l_suppkey").alias("authorDisplayName"),
        F.struct(F.nullif(F.col("l_suppkey").cast("string"), F.lit("1")).alias("value")).alias("authorChannelId"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("textDisplay"),
        F.col("l_linenumber").cast("string").alias("likeCount"),
        at.alias("publishedAt"),
        F.when(F.col("l_linenumber") > 1, at).alias("updatedAt"),
    )
    item = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), snippet.alias("snippet"))
    return _responses(table(spark, d, "lineitem"), item, F.col("l_orderkey").cast("string").alias("comment_thread_id"))


def flatten_channels(spark, d):
    """S9"""
    return flatten(channel_responses(spark, d), "channels")


def flatten_search(spark, d):
    """S9"""
    return flatten(search_responses(spark, d), "search", stamp=["category_id"])


def flatten_categories(spark, d):
    """S9"""
    return flatten(category_responses(spark, d), "categories")


def flatten_comments(spark, d):
    """S9"""
    return flatten(comment_responses(spark, d), "comments", stamp=["comment_thread_id"])


QUERIES = {
    f.__name__: f
    for f in (
        split_words,
        split_lines,
        extract_values_meta,
        extract_values_child,
        entity_fact,
        entity_dim,
        entity_natural,
        transitive_fact,
        transitive_dim,
        flatten_nested,
        flatten_videos,
        flatten_channels,
        flatten_search,
        flatten_categories,
        flatten_comments,
    )
}


def key_sql(*columns: str) -> str:
    """The stable key of :func:`millrace.functions.entity_key` in SQL."""
    parts = [
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')"
        for c in columns
    ]
    return f"sha256({' || '.join(parts)})"


SQL = {
    "split_words": """
        SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name, p_type FROM part""",
    "split_lines": """
        SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS text FROM documents""",
    "extract_values_meta": """
        SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part""",
    "extract_values_child": f"""
        SELECT p_partkey, value, {key_sql('p_partkey', 'value')} AS id FROM (
          SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS value FROM part) WHERE value <> ''""",
    "entity_fact": f"""
        WITH c AS (SELECT * REPLACE (nullif(c_mktsegment, 'BUILDING') AS c_mktsegment)
                   FROM customer)
        SELECT c_custkey, c_name, c_acctbal, {key_sql('c_mktsegment', 'c_nationkey')} AS market_id
        FROM c""",
    "entity_dim": f"""
        SELECT DISTINCT nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_nationkey,
               {key_sql("nullif(c_mktsegment, 'BUILDING')", 'c_nationkey')} AS market_id
        FROM customer""",
    "entity_natural": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "transitive_fact": f"""
        SELECT p_partkey, p_name, p_brand, p_retailprice, {key_sql('p_brand')} AS brand_id
        FROM part""",
    "transitive_dim": f"""
        WITH u AS (SELECT DISTINCT p_brand, p_type, p_size FROM part),
             m AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_type, p_size) AS rn,
                          count(*) OVER (PARTITION BY p_brand) AS n FROM u)
        SELECT p_brand, p_type, p_size, n, {key_sql('p_brand')} AS brand_id FROM m WHERE rn = 1""",
    "flatten_nested": r"""
        WITH c AS (SELECT *, regexp_replace(translate(text, chr(10) || chr(13), '  '),
                   '^[\x09-\x0d\x1c-\x1f\x{85}\p{Z}]+|[\x09-\x0d\x1c-\x1f\x{85}\p{Z}]+$',
                   '', 'g') AS clean FROM conversations),
        i AS (SELECT *, '-a' AS suffix, coalesce(clean, 'N/A') AS said FROM c
              UNION ALL SELECT *, '-b', coalesce(nullif(role, 'user'), 'N/A') FROM c)
        SELECT conv_id || '-' || turn || suffix AS comment_thread_id,
               CAST(conv_id AS VARCHAR) AS video_id,
               coalesce(nullif(role, 'system'), 'N/A') AS author_name, said AS text,
               turn AS like_count, '2024-01-01T00:00:00Z' AS published_at,
               length(text) AS total_reply_count, role
        FROM i""",
    "flatten_videos": """
        SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title, p_partkey AS view_count,
               CASE WHEN p_type <> 'PROMO' THEN CAST(p_size AS BIGINT) END AS like_count,
               CAST(NULL AS BIGINT) AS comment_count, 'N/A' AS published_at,
               p_size * 60.0::DOUBLE AS duration, 'N/A' AS dimension, 'N/A' AS definition,
               p_type = 'LARGE' AS licensed_content, p_brand AS channel_id,
               'N/A' AS channel_title, replace(p_name, ' ', ',') AS tags,
               coalesce(nullif(CAST(p_size AS VARCHAR), '7'), 'N/A') AS category_id,
               'N/A' AS audio_language, 'normal' AS live_broadcast_content
        FROM part""",
    "flatten_channels": """
        SELECT 's' || s_suppkey AS channel_id, s_name AS title,
               CASE WHEN s_suppkey % 5 > 0 THEN 'a b ' || s_name ELSE 'N/A' END AS description,
               CASE WHEN s_suppkey % 3 > 0 THEN '2010-01-01T00:00:00Z' END AS published_at,
               CAST(s_suppkey AS BIGINT) AS view_count,
               CASE WHEN s_suppkey % 7 > 0 THEN CAST(s_nationkey AS BIGINT) END AS subscriber_count,
               CAST(12 AS BIGINT) AS video_count,
               CASE WHEN s_nationkey > 3 THEN CAST(s_nationkey AS VARCHAR) ELSE 'N/A' END AS country
        FROM supplier""",
    "flatten_search": """
        SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title,
               p_type || ', "' || p_brand || '"' AS description, '2024-01-01T00:00:00Z' AS published_at,
               p_brand AS channel_id, coalesce(nullif(p_type, 'PROMO'), 'N/A') AS channel_title,
               'u/' || p_partkey AS thumbnails,
               CASE WHEN p_size % 2 = 0 THEN 'live' ELSE 'N/A' END AS "liveBroadcastContent",
               CAST(p_size AS VARCHAR) AS category_id
        FROM part""",
    "flatten_categories": """
        SELECT CAST(n_nationkey AS VARCHAR) AS category_id,
               CASE WHEN n_nationkey <> 2 THEN n_name ELSE 'N/A' END AS category_title FROM nation""",
    "flatten_comments": """
        SELECT l_orderkey || '-' || l_linenumber AS comment_id, 'c' || l_suppkey AS author_name,
               nullif(CAST(l_suppkey AS VARCHAR), '1') AS author_channel_id,
               l_returnflag || '/' || l_linestatus AS text_display, CAST(l_linenumber AS BIGINT) AS like_count,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
               CASE WHEN l_linenumber > 1 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') ELSE 'N/A' END AS updated_at,
               CAST(l_orderkey AS VARCHAR) AS comment_thread_id
        FROM lineitem""",
}
