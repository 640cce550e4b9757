"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm.block_neighbours import nearest
from bazaarlens.llm.exact_dedup import duplicates
from bazaarlens.llm.language_crf import predict_languages, train
from bazaarlens.llm.licence_rules import check_sql, licences
from bazaarlens.llm.packing import pack
from bazaarlens.llm.phrase_graph import collocations
from bazaarlens.llm.preference import edited_preferences, swapped_answers
from bazaarlens.llm.prefix_bpe import encode_documents
from bazaarlens.llm.prefix_trie import prefix_trie
from bazaarlens.llm.quality_rules import quality
from bazaarlens.llm.simhash import near_duplicates
from bazaarlens.llm.token_files import read_token_files, write_token_files
from bazaarlens.llm.warc import read_archives, write_archives
from bazaarlens.session import fresh_path
from bazaarlens.llm.registry import ORACLE, QUERIES, query, table  # noqa: F401


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_licence_rules", check_sql())
def op2_licence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return licences(table(spark, folder, "documents"))


@query(
    "op3_block_neighbours",
    """
    WITH v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
          AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
    ), pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        WHERE q.vec_id % 20 = 0
    ), ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM pairs
    )
    SELECT * FROM ranked WHERE rank <= 20
    """,
)
def op3_block_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


@query(
    "op4_preference",
    r"""
    WITH last AS (
        SELECT conv_id, max(turn) AS t, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id
    ), swap AS (
        SELECT a.conv_id, a.t, b.answer AS other FROM last a JOIN last b ON b.conv_id = xor(a.conv_id, 1)
    ), c AS (
        SELECT conv_id, turn, role, text, CASE WHEN role = 'assistant' AND turn = t THEN other ELSE text END AS bad
        FROM conversations LEFT JOIN swap USING (conv_id)
    ), f AS (
        SELECT *, coalesce(turn < min(CASE WHEN bad IS DISTINCT FROM text THEN turn END) OVER (PARTITION BY conv_id),
                           min(CASE WHEN bad IS DISTINCT FROM text THEN turn END) OVER (PARTITION BY conv_id) IS NULL) AS same
        FROM c
    ), t AS (
        SELECT conv_id, turn, role, text, 'prompt' AS part FROM f WHERE same
        UNION ALL SELECT conv_id, turn, role, text, 'chosen' FROM f WHERE NOT same
        UNION ALL SELECT conv_id, turn, role, bad, 'rejected' FROM f WHERE NOT same
    ), r AS (
        SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM t
    ), s AS (
        SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, part ORDER BY turn) AS upto,
               coalesce(sum(CASE WHEN part = 'prompt' THEN length(rendered) END) OVER (PARTITION BY conv_id), 0) AS prompt
        FROM r
    ), p AS (
        SELECT *, (upto + CASE WHEN part = 'prompt' THEN 0 ELSE prompt END)::BIGINT AS char_end FROM s
    )
    SELECT conv_id AS pair_id, part, turn, 1::INTEGER AS copy, role, rendered, char_end - length(rendered) AS char_start,
           char_end, part <> 'prompt' AND role = 'assistant' AS trained
    FROM p
    """,
)
def op4_preference(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return edited_preferences(turns.withColumnRenamed("conv_id", "pair_id"), swapped_answers(turns))


@query("op5_prefix_bpe")
def op5_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query(
    "op6_warc",
    """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
    ), g AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
    FROM g
    """,
)
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = read_archives(write_archives(table(spark, folder, "pages"), fresh_path(spark, "archives")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return read_token_files(write_token_files(table(spark, folder, "documents"), path, fresh_path(spark, "token-files")))


@query("op9_language_crf")
def op9_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return predict_languages(docs, train(docs))


@query(
    "op10_exact_dedup",
    r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
           text_sha256
    FROM d
    """,
)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates(table(spark, folder, "documents"))


@query(
    "op11_phrase_graph",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
        FROM documents
    ), words AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda w: w <> '') AS w FROM pieces
    ), places AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
    ), f AS (
        SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
        FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
    ), total AS (
        SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
    ), candidates AS (
        SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
    ), parts AS (
        SELECT lang, k, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS left_part, array_to_string(w[cut + 1 : k], ' ') AS right_part
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
    ), cuts AS (
        SELECT p.*, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.left_part JOIN f y ON y.lang = p.lang AND y.phrase = p.right_part
    ), lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), inner_phrases AS (
        SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS longer
        FROM candidates, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL
    ), ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
        FROM lowest LEFT JOIN inner_phrases USING (lang, phrase) WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
)
def op11_phrase_graph(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


@query("op12_prefix_trie")
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"), group=20, most=4)


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"))
