"""Registered queries of this subpackage, each over its whole tables, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm import chat, decontaminate, fingerprints, html_text, jaccard, lexical, mixing, neighbours, prefixes
from daytally.llm import quality, sharding, substrings, tokens

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model)


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sharding.assign(docs.select("doc_id", "source", "n_chars"))


# The conversation that carries control strings in its texts.
CONTROL_TURNS = [
    (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
    (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
]


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(CONTROL_TURNS, rows.schema))
    return chat.digest_conversations(chat.format_conversations(rows))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def conversation_trie(conversations: DataFrame, trie: prefixes.Trie = prefixes.Trie()) -> DataFrame:
    """Trie of conversations whose first turns, up to three by their id's checksum, are those of the
    first conversation of their twenty."""
    c = F.col("conv_id")
    turns = prefixes.ordered_turns(conversations)
    return prefixes.prefix_nodes(prefixes.with_shared_heads(turns, c - c % 20, F.crc32(c.cast("string")) % 4, 3), trie)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_quality_scores": op1_quality_scores,
    "op2_page_text": op2_page_text,
    "op3_decontamination": op3_decontamination,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_nearest": op6_nearest,
    "op7_shards": op7_shards,
    "op8_chat_format": op8_chat_format,
    "op9_source_mix": op9_source_mix,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE: dict[str, str] = {
    "op8_chat_format": """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, n, r, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, r)
),
shown AS (
    SELECT *, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS escaped,
        replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n') AS head
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(head) + length(escaped) + length('<|im_start|>') + length('<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
""",
    # The checksum that says how many turns are shared is worked out byte by byte.
    "op11_prefix_trie": r"""
WITH src AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (SELECT DISTINCT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes FROM src),
convs AS (
    SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda crc, b:
        list_reduce(list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, i:
            CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 4 AS h
    FROM ids
),
rebuilt AS (
    SELECT c.conv_id, s.pos, s.role, s.text FROM convs c JOIN src s ON s.conv_id = c.conv_id - c.conv_id % 20 AND s.pos < c.h
    UNION ALL
    SELECT c.conv_id, s.pos, s.role, s.text FROM convs c JOIN src s ON s.conv_id = c.conv_id AND s.pos >= c.h
),
steps AS (
    SELECT conv_id, row_number() OVER w AS depth,
        string_agg(sha256(length(role) || ':' || role || text), '') OVER w AS key,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
),
nodes AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM steps GROUP BY depth, key),
ends AS (
    SELECT depth, key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
    FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS most FROM steps) WHERE depth = most GROUP BY depth, key
),
children AS (SELECT depth - 1 AS depth, left(key, 64 * (depth - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children, coalesce(e.ids, '') AS ids
    FROM nodes n LEFT JOIN children c USING (depth, key) LEFT JOIN ends e USING (depth, key)
),
below AS (
    SELECT a.up AS depth, left(f.key, 64 * a.up) AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM full_nodes f, (SELECT unnest(range((SELECT max(depth) + 1 FROM nodes))) AS up) a WHERE a.up <= f.depth GROUP BY ALL
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs, CAST(f.n_children AS BIGINT) AS n_children,
    CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_nodes f JOIN below b USING (depth, key)
LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.key = left(f.key, 64 * (f.depth - 1))
""",
    "op13_lexical_search": r"""
WITH found AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
docs AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM docs),
lengths AS (SELECT doc_id, 10 + (90 * n * totals.docs) // totals.words AS m FROM docs, totals),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * max(totals.docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id
),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
