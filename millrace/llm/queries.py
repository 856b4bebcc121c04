"""One query for each operator: it reads its table in whole and gives the digest columns."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm import decontaminate, html_text, language, near_dup, packing, periodic, prefix_trie, quality, repeats
from millrace.llm import secrets, suffix_tree, token_files, topk
from millrace.llm.common import remainder, table
from millrace.sources.files import work_folder

VOCABULARY = "word_bpe_49k.json"


def op1_token_files(spark, d):
    """Token ids of all documents, written as flat files and read back."""
    folder = work_folder(spark, "tokens")
    docs = table(spark, d, "documents")
    token_files.write_tokens(docs, folder, public_tokenizers.path(VOCABULARY), end_id=2)
    return token_files.read_tokens(spark, folder)


def op2_secrets(spark, d):
    """Secrets in all documents: matches of the base patterns, and runs that look random."""
    docs = table(spark, d, "documents")
    found = secrets.find(docs, secrets.train(docs))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind, *_ in secrets.BASE),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op3_language(spark, d):
    """The language of all documents, learned from two thirds of them."""
    docs = table(spark, d, "documents")
    found = language.predict(docs, language.fit(docs, remainder(3) != 1))
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op4_packing(spark, d):
    """All documents in sequences of at most 2048 ids."""
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path(VOCABULARY))


def op5_benchmark_links(spark, d):
    """All documents with the benchmark items that they hold."""
    found = decontaminate.links(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        F.size("links").cast("long").alias("n_items"),
        F.array_sort("links.item_id").alias("item_ids"),
        F.array_max("links.similarity").alias("similarity"),
    )


def op6_suffix_tree(spark, d):
    """Scores of all documents, learned from four fifths of them."""
    return suffix_tree.score(table(spark, d, "documents"), remainder(5) != 1)


def op7_simhash_classes(spark, d):
    """Fingerprint and class of near copies of all documents."""
    found = near_dup.duplicate_classes(table(spark, d, "documents"))
    code = F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", code, "component_id")


def op8_quality(spark, d):
    """The quality of all documents, learned from three quarters of the labels."""
    docs = table(spark, d, "documents")
    model = quality.fit(docs, table(spark, d, "labels"), remainder(4) != 2)
    found = quality.score(docs, model)
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", predicted)


def op9_top5(spark, d):
    """The five best partners of every fiftieth vector among all vectors."""
    return topk.top(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_main_text(spark, d):
    """The main text of all pages."""
    return html_text.extract(table(spark, d, "pages"))


def op11_prefix_trie(spark, d):
    """Every node of the trie of all conversations, which begin with turns of the first of their twenty."""
    found = prefix_trie.paths(prefix_trie.symbols(table(spark, d, "conversations")))
    conv = F.col("conv_id")
    turns = F.crc32(conv.cast("string").cast("binary")) % 4
    return prefix_trie.nodes(prefix_trie.continued(found, conv - F.pmod(conv, F.lit(20)), turns, 3))


def periodic_words(name: int | None, words: list[bytes]) -> list[bytes]:
    """Words of one document in ten, made periodic from some place on: the rule of the query."""
    h = zlib.crc32(b"" if name is None else b"%d" % name)
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark, d):
    """The runs of all documents, and the documents without what runs repeat."""
    found = periodic.find(table(spark, d, "documents"), periodic_words)
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x),
    )
    run = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(run, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_repeated_bytes(spark, d):
    """All documents without the bytes of strings of 100 bytes that start earlier as well."""
    found = repeats.remove(table(spark, d, "documents"))
    removed = F.reduce("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_secrets,
        op3_language,
        op4_packing,
        op5_benchmark_links,
        op6_suffix_tree,
        op7_simhash_classes,
        op8_quality,
        op9_top5,
        op10_main_text,
        op11_prefix_trie,
        op12_periodic_runs,
        op13_repeated_bytes,
    )
}


def _crc32(number: str) -> str:
    """The unsigned crc32 of a number's decimal digits in SQL, which has no such function: bit by bit."""
    digits = f"CAST({number} AS VARCHAR)"
    mixed = f"(CASE WHEN i % 8 = 0 THEN xor(crc, CAST(ascii(substr({digits}, i // 8 + 1, 1)) AS BIGINT)) ELSE crc END)"
    step = f"xor({mixed} >> 1, 3988292384 * ({mixed} & 1))"
    ones = "CAST(4294967295 AS BIGINT)"
    return f"xor({ones}, list_reduce(range(8 * length({digits})), lambda crc, i: {step}, {ones}))"


SQL: dict[str, str] = {
    "op11_prefix_trie": rf"""
        WITH turns AS (
            SELECT CAST(conv_id AS BIGINT) AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, conv_id - ((conv_id % 20) + 20) % 20 AS base, {_crc32("conv_id")} % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT c.conv_id, 0 AS part, place, role, text
            FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
            UNION ALL
            SELECT c.conv_id, 1, place, role, text
            FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
        ), paths AS (
            SELECT conv_id, list(struct_pack(role, text) ORDER BY part, place) AS turns,
                   list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY part, place) AS words
            FROM rebuilt GROUP BY conv_id
            UNION ALL
            SELECT conv_id, [], [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM rebuilt)
        ), starts AS (
            SELECT conv_id, depth, sha256(CAST(turns[1:depth] AS VARCHAR)) AS node,
                   sha256(CAST(turns[1:depth - 1] AS VARCHAR)) AS parent,
                   coalesce(words[depth], 0) AS words, depth = len(turns) AS ends,
                   list_transform(range(0, depth + 1), lambda k: sha256(CAST(turns[1:k] AS VARCHAR))) AS above
            FROM paths, unnest(range(0, len(turns) + 1)) t(depth)
        ), nodes AS (
            SELECT node, min(conv_id) AS conv_id, max(depth) AS depth, max(parent) AS parent, count(*) AS n_convs,
                   max(words) AS words, max(above) AS above,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM starts GROUP BY node
        ), children AS (
            SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
        ), below AS (
            SELECT node, sum((n_convs - 1) * words) AS saved, count(*) FILTER (WHERE childless) AS n_leaves
            FROM (SELECT unnest(above) AS node, n_convs, words, c.node IS NULL AS childless
                  FROM nodes n LEFT JOIN children c ON c.node = n.node)
            GROUP BY node
        )
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id,
               n.n_convs, coalesce(c.n_children, 0) AS n_children, b.n_leaves,
               CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN children c ON c.node = n.node
        LEFT JOIN nodes p ON p.node = n.parent
    """,
    "op12_periodic_runs": rf"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   {_crc32("doc_id")} AS h
            FROM documents
        ), places AS (
            SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a
            FROM split
        ), periods AS (
            SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM places
        ), words AS (
            SELECT doc_id, n, CAST(i AS BIGINT) AS i,
                   w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
            FROM periods, unnest(range(0, n)) t(i)
        ), same AS (
            SELECT x.doc_id, x.i, y.i - x.i AS lag
            FROM words x JOIN words y
              ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= x.n
        ), stretches AS (
            SELECT doc_id, lag, min(i) AS start, count(*) + lag AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM same)
            GROUP BY doc_id, lag, island
        ), runs AS (
            SELECT doc_id, start, length, min(lag) AS period
            FROM stretches WHERE length >= greatest(6, 4 * lag) GROUP BY doc_id, start, length
        ), best AS (
            SELECT * FROM runs QUALIFY row_number() OVER (
                PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1
        ), listed AS (
            SELECT doc_id, count(*) AS n_runs,
                   string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
            FROM runs GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
            FROM words x
            WHERE NOT EXISTS (SELECT 1 FROM runs r
                              WHERE r.doc_id = x.doc_id AND x.i >= r.start + r.period AND x.i < r.start + r.length)
            GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period,
               1000 * b.length // b.period AS exponent_milli,
               sha256(coalesce(l.runs, '')) AS runs_sha256, sha256(coalesce(k.collapsed, '')) AS collapsed_sha256
        FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id
        LEFT JOIN kept k ON k.doc_id = d.doc_id
    """,
    "op13_repeated_bytes": """
        WITH docs AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
            FROM documents
        ), places AS (
            SELECT doc_id, n, p, substr(h, 2 * p + 1, 2) AS byte, md5(substr(h, 2 * p + 1, 200)) AS string
            FROM docs, unnest(range(0, n)) t(p)
        ), again AS (
            SELECT doc_id, p, byte,
                   p <= n - 100 AND row_number() OVER (PARTITION BY string, p <= n - 100 ORDER BY doc_id, p) > 1 AS again
            FROM places
        ), covered AS (
            SELECT doc_id, p, byte,
                   bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone
            FROM again
        ), edges AS (
            SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS first
            FROM covered
        ), cut AS (
            SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE first) AS n_spans,
                   string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept
            FROM edges GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, coalesce(c.n_removed, 0) AS n_removed,
               coalesce(c.n_spans, 0) AS n_spans, sha256(unhex(coalesce(c.kept, ''))) AS kept_sha256
        FROM docs d LEFT JOIN cut c ON c.doc_id = d.doc_id
    """,
    "op9_top5": """
        WITH whole AS (
            SELECT CAST(vec_id AS BIGINT) AS vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
