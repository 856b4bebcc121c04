"""The spec runner and the golden pipelines, fed with raw tables made of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.normal import key_sql
from checks.tables import table
from millrace.plans.golden import GOLDEN
from millrace.plans.runner import INPUT_FRAME, apply_steps, run_pipeline


def _golden(spark, d, dataset: str, raw, frame: str, **options):
    """Run a golden spec on ``raw``; timestamps come back without zone, as SQL has them."""
    spec = GOLDEN[dataset]("unused", **options)
    df = run_pipeline(spark, spec, source=raw)[frame]
    zoned = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def pipeline_spec(spark, d):
    """Steps on named frames, a two-frame join among them"""
    frames, last = apply_steps(
        {INPUT_FRAME: table(spark, d, "part"), "sales": table(spark, d, "lineitem")},
        [
            {"name": "filter_rows", "params": {"condition": "p_size > 10"}},
            {"name": "rename_columns", "params": {"mapping": {"p_partkey": "l_partkey"}}},
            {
                "name": "extract_unique_entities",
                "params": {"entity_columns": ["p_brand", "p_type"], "id_column": "kind_id"},
                "multi_output": True,
                "output_names": ["parts", "kinds"],
            },
            {
                "name": "join_dataframes",
                "target": "parts",
                "params": {"df2": "sales", "join_cols": ["l_partkey"], "join_type": "inner"},
                "output_names": ["sold"],
            },
            {
                "name": "add_columns",
                "params": {"columns": {"late": "l_shipdate >= TIMESTAMP_NTZ'2000-01-01'"}},
            },
            {
                "name": "group_and_aggregate",
                "params": {
                    "group_by": ["kind_id"],
                    "aggregations": {
                        "n": "count(*)",
                        "late": "count_if(late)",
                        "qty": "sum(CAST(l_quantity AS BIGINT))",
                    },
                },
            },
            {
                "name": "join_dataframes",
                "params": {"df2": "kinds", "join_cols": ["kind_id"]},
                "output_names": ["report"],
            },
        ],
    )
    return frames[last]


def r1_categories(spark, d):
    """Many titles per category, the smallest is kept"""
    raw = table(spark, d, "part").select(
        F.when(F.col("p_size") == 50, "N/A").otherwise(F.col("p_size").cast("string")).alias(
            "category_id"
        ),
        F.col("p_brand").alias("category_title"),
    )
    return _golden(spark, d, "categories", raw, "categories_df")


def _raw_channels(spark, d):
    s = table(spark, d, "supplier")
    nation = table(spark, d, "nation").withColumnsRenamed({"n_nationkey": "s_nationkey"})
    return s.join(nation, "s_nationkey").select(
        F.col("s_suppkey").cast("string").alias("channel_id"),
        F.col("s_name").alias("title"),
        F.lit("about").alias("description"),
        F.concat(F.lit(2000) + F.col("s_nationkey"), F.lit("-03-04T05:06:07Z")).alias(
            "published_at"
        ),
        F.col("s_acctbal").cast("bigint").cast("string").alias("view_count"),
        F.when(F.col("s_acctbal") < 0, "N/A")
        .otherwise(F.length("s_name").cast("string"))
        .alias("subscriber_count"),
        F.when(F.col("s_nationkey") == 1, "0").otherwise("8").alias("video_count"),
        F.nullif("n_name", F.lit("NATION_2")).alias("country"),
    )


def r2_channels(spark, d):
    """R2"""
    raw = _raw_channels(spark, d)
    return _golden(spark, d, "channels_information", raw, "channels_df", as_of="2024-06-01")


def r2_countries(spark, d):
    """R2"""
    return _golden(spark, d, "channels_information", _raw_channels(spark, d), "countries_df")


def _raw_threads(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("comment_thread_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("video_id"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("author_name"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("text"),
        F.when(F.col("o_custkey") < 100, "N/A")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("like_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.lit("3").alias("total_reply_count"),
    )


def r3_comment_threads(spark, d):
    """R3"""
    return _golden(spark, d, "comment_threads", _raw_threads(spark, d), "comment_threads_df")


def r3_authors(spark, d):
    """R3"""
    return _golden(spark, d, "comment_threads", _raw_threads(spark, d), "authors_df")


def _raw_related(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("description"),
        F.concat(F.lit(1990) + F.col("p_size"), F.lit("-12-31T23:59:59Z")).alias("published_at"),
        F.nullif("p_brand", F.lit("Brand#3")).alias("channel_id"),
        F.col("p_type").alias("channel_title"),
        F.lit("http://x").alias("thumbnails"),
        F.lit("none").alias("liveBroadcastContent"),
        F.col("p_size").cast("string").alias("category_id"),
    )


def r4_related(spark, d):
    """R4"""
    return _golden(
        spark, d, "related_category_videos", _raw_related(spark, d), "related_category_videos_df"
    )


def r4_channel_names(spark, d):
    """One channel has several titles"""
    return _golden(
        spark,
        d,
        "related_category_videos",
        _raw_related(spark, d),
        "channels_basic_information_df",
    )


def r5_replies(spark, d):
    """R5"""
    items = table(spark, d, "lineitem")
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("comment_id"),
        F.col("l_returnflag").alias("author_name"),
        F.col("l_suppkey").cast("string").alias("author_channel_id"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text_display"),
        F.col("l_quantity").cast("int").cast("string").alias("like_count"),
        stamp.alias("published_at"),
        F.when(F.col("l_linestatus") == "O", stamp).otherwise("N/A").alias("updated_at"),
        F.nullif("l_orderkey", F.lit(7)).cast("string").alias("comment_thread_id"),
    )
    return _golden(spark, d, "replies", raw, "replies_df")


def raw_trending(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") == 9, "0")
        .otherwise(F.col("p_partkey").cast("string"))
        .alias("view_count"),
        F.col("p_size").cast("string").alias("like_count"),
        F.lit("N/A").alias("comment_count"),
        F.concat(F.lit(1990) + F.col("p_size"), F.lit("-01-02T03:04:05Z")).alias("published_at"),
        F.col("p_retailprice").alias("duration"),
        F.lit("2d").alias("dimension"),
        F.lit("hd").alias("definition"),
        (F.col("p_type") == "PROMO").alias("licensed_content"),
        F.col("p_brand").alias("channel_id"),
        F.col("p_type").alias("channel_title"),
        F.when(F.col("p_type") != "SMALL", F.replace("p_name", F.lit(" "), F.lit(","))).alias(
            "tags"
        ),
        F.col("p_size").cast("string").alias("category_id"),
        F.lit("en").alias("audio_language"),
        F.lit("none").alias("live_broadcast_content"),
    )


def r6_trending(spark, d):
    """Videos without tags stay"""
    return _golden(spark, d, "trending_videos", raw_trending(spark, d), "trending_videos_df")


def r6_tags(spark, d):
    """R6"""
    return _golden(spark, d, "trending_videos", raw_trending(spark, d), "tags_df")


def r6_channel_names(spark, d):
    """R6"""
    return _golden(
        spark, d, "trending_videos", raw_trending(spark, d), "channels_basic_information_df"
    )


QUERIES = {
    f.__name__: f
    for f in (
        pipeline_spec,
        r1_categories,
        r2_channels,
        r2_countries,
        r3_comment_threads,
        r3_authors,
        r4_related,
        r4_channel_names,
        r5_replies,
        r6_trending,
        r6_tags,
        r6_channel_names,
    )
}

_CHANNELS = """
    SELECT CAST(s_suppkey AS VARCHAR) AS channel_id, s_name AS channel_name,
           CAST(trunc(s_acctbal) AS BIGINT) AS total_views,
           CAST(CASE WHEN s_acctbal >= 0 THEN length(s_name) END AS BIGINT) AS subscribers,
           CAST(CASE s_nationkey WHEN 1 THEN 0 ELSE 8 END AS BIGINT) AS video_count,
           make_timestamp(2000 + s_nationkey, 3, 4, 5, 6, 7.0) AS published_at,
           nullif(n_name, 'NATION_2') AS country
    FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal >= 0"""
_NAMES = "SELECT DISTINCT p_brand AS channel_id, p_type AS channel_title FROM part"

SQL = {
    "pipeline_spec": f"""
        SELECT {key_sql('p_brand', 'p_type')} AS kind_id, p_brand, p_type, count(*) AS n,
               count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '2000-01-01') AS late,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
        FROM part JOIN lineitem ON p_partkey = l_partkey WHERE p_size > 10
        GROUP BY p_brand, p_type""",
    "r1_categories": """
        SELECT CASE WHEN p_size <> 50 THEN p_size END AS category_id, min(p_brand) AS category_name
        FROM part GROUP BY ALL""",
    "r2_channels": f"""
        SELECT channel_id, channel_name, published_at, subscribers, video_count, total_views,
               {key_sql('country')} AS country_id,
               CAST(2024 - year(published_at) AS INTEGER) AS channel_age_years,
               total_views / nullif(video_count, 0) AS avg_views_per_video
        FROM ({_CHANNELS})""",
    "r2_countries": f"""
        SELECT DISTINCT country, {key_sql('country')} AS country_id FROM ({_CHANNELS})""",
    "r3_comment_threads": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS comment_thread_id, o_orderstatus AS video_id,
               o_orderpriority || ' ' || o_orderstatus AS comment_text,
               CAST(CASE WHEN o_custkey >= 100 THEN o_custkey END AS INTEGER) AS comment_likes,
               o_orderdate AS published_at, 3 AS total_reply_count,
               {key_sql("nullif(o_orderpriority, '5-LOW')")} AS author_id,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders WHERE o_orderstatus <> 'P'""",
    "r3_authors": f"""
        SELECT DISTINCT nullif(o_orderpriority, '5-LOW') AS author_name,
               {key_sql("nullif(o_orderpriority, '5-LOW')")} AS author_id
        FROM orders WHERE o_orderstatus <> 'P'""",
    "r4_related": """
        SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title, p_type AS description,
               make_timestamp(1990 + p_size, 12, 31, 23, 59, 59.0) AS published_at,
               p_brand AS channel_id, 'http://x' AS thumbnails, 'none' AS is_live_content,
               p_size AS category_id, 1990 + p_size AS year
        FROM part WHERE p_brand <> 'Brand#3'""",
    "r4_channel_names": f"{_NAMES} WHERE p_brand <> 'Brand#3'",
    "r5_replies": f"""
        SELECT l_orderkey || '-' || l_linenumber AS comment_id,
               CAST(l_suppkey AS VARCHAR) AS author_channel_id,
               l_returnflag || ' ' || l_linestatus AS reply_text,
               CAST(trunc(l_quantity) AS INTEGER) AS reply_likes, l_shipdate AS published_at,
               CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS updated_at,
               CAST(l_orderkey AS VARCHAR) AS comment_thread_id,
               {key_sql('l_returnflag')} AS author_id,
               CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(month(l_shipdate) AS INTEGER) AS month
        FROM lineitem WHERE l_orderkey <> 7""",
    "r6_trending": """
        SELECT CAST(p_partkey AS VARCHAR) AS video_id, p_name AS title,
               CASE WHEN p_size = 9 THEN 0 ELSE p_partkey END AS views,
               CAST(p_size AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS comments,
               make_timestamp(1990 + p_size, 1, 2, 3, 4, 5.0) AS published_at,
               p_retailprice AS duration, '2d' AS dimension, 'hd' AS definition,
               p_type = 'PROMO' AS licensed_content, p_brand AS channel_id, p_size AS category_id,
               'en' AS audio_language, 'none' AS live_broadcast_content, 1990 + p_size AS year,
               CAST(p_size AS DOUBLE)
                 / nullif(CASE WHEN p_size = 9 THEN 0 ELSE p_partkey END, 0) * 100 AS engagement_rate
        FROM part""",
    "r6_tags": f"""
        SELECT video_id, value, {key_sql('video_id', 'value')} AS id FROM (
          SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS video_id,
                 unnest(string_split(p_name, ' ')) AS value FROM part WHERE p_type <> 'SMALL')""",
    "r6_channel_names": _NAMES,
}
