"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.embeddings import near_vectors
from flowlake.llm.lines import dedup_lines
from flowlake.llm.multiindex import nearest_vectors
from flowlake.llm.packing import pack_documents
from flowlake.llm.phrases import mine_phrases
from flowlake.llm.pieces import encode_pieces
from flowlake.llm.quality import grade_documents, train_quality
from flowlake.llm.simhash import simhash_groups
from flowlake.llm.substrings import remove_repeats
from flowlake.llm.surrogates import replace_entities
from flowlake.llm.toolcalls import link_tool_calls
from flowlake.llm.toxicity import score_toxicity, train_toxicity
from flowlake.llm.whitening import whiten_vectors

# Whoever runs this on real data gives a secret key of their own.
SURROGATE_KEY = "a key for the test tables"


def _table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of an installed vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def graded_labels(spark: SparkSession, tables: str) -> DataFrame:
    """Ratings of documents: 0 bad, 1 readable but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    rated = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return _table(spark, tables, "labels").where(rated).select("doc_id", grade.alias("grade"))


def op1_quality_classifier(spark: SparkSession, tables: str) -> DataFrame:
    documents = _table(spark, tables, "documents")
    return grade_documents(documents, train_quality(documents, graded_labels(spark, tables)))


# Tools of the conversations; the system's own tool has no schema.
TOOLS = {
    "search": {
        "properties": {
            "query": {"type": "string", "minLength": 40},
            "limit": {"type": "integer", "maximum": 80},
            "after": {"type": "string"},
        },
        "required": ["query"],
        "additionalProperties": False,
    },
    "translate": {
        "properties": {
            "query": {"type": "string"},
            "after": {"type": "string"},
            "limit": {"type": "integer", "minimum": 20},
        },
        "required": ["query", "limit", "after"],
    },
}


def op2_tool_call_linking(spark: SparkSession, tables: str) -> DataFrame:
    """Conversations read as tool traffic: what a user says is a call that may
    use the result of the user's last call, an answer is the result of the call
    before it, and a system prompt is a call of a tool nobody knows."""
    rows = _table(spark, tables, "conversations")
    length = F.length("text")
    use = F.when(F.col("turn") >= 2, F.concat(F.lit("$result:c"), F.col("turn") - 2))
    query = F.when(length % 13 > 0, F.col("text"))
    asked = F.struct(query.alias("query"), (length % 100).alias("limit"), use.alias("after"))
    calls = rows.where("role IN ('user', 'system')").select(
        "conv_id",
        "turn",
        F.concat(F.lit("c"), "turn").alias("call_id"),
        F.when(F.col("role") == "system", "configure")
        .when(length % 2 == 0, "search")
        .otherwise("translate")
        .alias("name"),
        F.to_json(asked).alias("arguments"),
    )
    results = rows.where("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit("c"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    linked = link_tool_calls(calls, results, TOOLS).withColumn("errors", F.array_join("errors", "; "))
    # Results have no name, level, errors or record of their own.
    return linked.fillna("", ["name", "errors", "record"]).fillna(-1, ["level"]).fillna(False, ["valid"])


def op3_surrogates(spark: SparkSession, tables: str) -> DataFrame:
    documents = _table(spark, tables, "documents")
    return replace_entities(documents, SURROGATE_KEY).select("doc_id", "text", "n_entities")


def op4_line_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return dedup_lines(_table(spark, tables, "documents"))


def op5_substring_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return remove_repeats(_table(spark, tables, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op6_multi_index(spark: SparkSession, tables: str) -> DataFrame:
    return nearest_vectors(_table(spark, tables, "embeddings"))


def op7_simhash_near_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return simhash_groups(_table(spark, tables, "documents"))


def op8_sentencepiece(spark: SparkSession, tables: str) -> DataFrame:
    return encode_pieces(_table(spark, tables, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_hierarchical_packing(spark: SparkSession, tables: str) -> DataFrame:
    return pack_documents(_table(spark, tables, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_embedding_near_dedup(spark: SparkSession, tables: str) -> DataFrame:
    return near_vectors(_table(spark, tables, "embeddings"))


def op11_toxicity(spark: SparkSession, tables: str) -> DataFrame:
    """Ratings whose crc32 of doc_id leaves no rest modulo 5 are held out."""
    documents, ratings = _table(spark, tables, "documents"), _table(spark, tables, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = train_toxicity(documents, ratings.where(~held_out).select("doc_id", "toxic"))
    scored = score_toxicity(documents, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op12_embedding_whitening(spark: SparkSession, tables: str) -> DataFrame:
    return whiten_vectors(_table(spark, tables, "embeddings"))


def op13_phrase_mining(spark: SparkSession, tables: str) -> DataFrame:
    return mine_phrases(_table(spark, tables, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_tool_call_linking": op2_tool_call_linking,
    "op3_surrogates": op3_surrogates,
    "op4_line_dedup": op4_line_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_multi_index": op6_multi_index,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_hierarchical_packing": op9_hierarchical_packing,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_phrase_mining": op13_phrase_mining,
}

_NEAR_VECTORS = """
WITH RECURSIVE units AS (
    SELECT vec_id, embedding::DOUBLE[] AS v, len(embedding) AS dim FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
    ON a.vec_id <> b.vec_id AND a.dim = b.dim AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reach AS (
    SELECT vec_id AS node, vec_id AS other FROM embeddings
    UNION
    SELECT node, b FROM reach JOIN links ON a = other
),
counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT node AS vec_id, min(other) AS component_id FROM reach GROUP BY node)
LEFT JOIN counts ON counts.node = vec_id"""

_SUBSTRINGS = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, array_to_string(w[i : i + 12], ' ') AS gram FROM words
),
earliest AS (SELECT gram, min(doc_id) AS first FROM windows GROUP BY gram),
gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS place
    FROM windows JOIN earliest USING (gram) WHERE first < doc_id
),
lists AS (SELECT doc_id, list(place) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
        list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(gone, i) THEN NULL ELSE x END),
            lambda x: x IS NOT NULL) END, ' ')) AS kept_sha256
FROM words LEFT JOIN lists USING (doc_id)"""

_TOOL_CALLS = """
WITH RECURSIVE turns AS (SELECT DISTINCT conv_id, turn, role, text, length(text) AS n FROM conversations),
calls AS (
    SELECT conv_id, turn, n % 100 AS lim,
        CASE WHEN role = 'system' THEN 'configure' WHEN n % 2 = 0 THEN 'search' ELSE 'translate' END AS name,
        CASE WHEN n % 13 > 0 THEN text END AS query, CASE WHEN turn >= 2 THEN turn - 2 END AS use
    FROM turns WHERE role IN ('user', 'system')
),
results AS (SELECT conv_id, turn, turn - 1 AS call, text FROM turns WHERE role = 'assistant'),
levels AS (
    SELECT c.conv_id, c.turn, 0 AS level FROM calls c ANTI JOIN calls d ON d.conv_id = c.conv_id AND d.turn = c.use
    UNION ALL
    SELECT c.conv_id, c.turn, level + 1 FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.use = l.turn
),
checked AS (
    SELECT *, CASE name
            WHEN 'search' THEN [
                CASE WHEN lim > 80 THEN 'limit: maximum' END,
                CASE WHEN length(query) < 40 THEN 'query: minLength' END,
                CASE WHEN query IS NULL THEN 'query: required' END]
            WHEN 'translate' THEN [
                CASE WHEN use IS NULL THEN 'after: required' END, CASE WHEN lim < 20 THEN 'limit: minimum' END,
                CASE WHEN query IS NULL THEN 'query: required' END]
            ELSE ['unknown tool'] END
        || [CASE WHEN use IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM calls d WHERE d.conv_id = calls.conv_id AND d.turn = calls.use
        ) THEN 'no such call: c' || use END] AS found
    FROM calls
)
SELECT conv_id, 'call' AS kind, turn, 'c' || turn AS call_id, name, level,
    CASE WHEN r.conv_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
    len(list_filter(found, lambda x: x IS NOT NULL)) = 0 AS valid,
    array_to_string(list_filter(found, lambda x: x IS NOT NULL), '; ') AS errors,
    concat('{"arguments":{', CASE WHEN use IS NOT NULL THEN concat('"after":"$result:c', use, '",') END,
        '"limit":', lim, CASE WHEN query IS NOT NULL THEN concat(',"query":', to_json(query)) END,
        '},"id":"c', turn, '","name":"', name, '","result":', coalesce(to_json(r.text)::VARCHAR, 'null'), '}') AS record
FROM checked JOIN levels USING (conv_id, turn)
LEFT JOIN (SELECT conv_id, call AS turn, text FROM results) r USING (conv_id, turn)
UNION ALL
SELECT r.conv_id, 'result', r.turn, 'c' || call, '', -1,
    CASE WHEN c.conv_id IS NULL THEN 'orphan' ELSE 'linked' END, false, '', ''
FROM results r LEFT JOIN calls c ON c.conv_id = r.conv_id AND c.turn = r.call"""

_PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
),
counted AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1),
inner_ AS (
    SELECT DISTINCT c.lang, array_to_string(c.w[i : i + k.k - 1], ' ') AS phrase, c.a AS f
    FROM candidates c, (SELECT unnest(range(2, 5)) AS k) k, (SELECT unnest(range(1, 5)) AS i)
    WHERE k.k < c.k AND i + k.k - 1 <= c.k
),
kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.a)
),
cuts AS (
    SELECT kept.lang, kept.phrase, kept.a, cut, x.f AS l, y.f AS r, n, (1000 * kept.a * n) // (x.f * y.f) AS score
    FROM kept, (SELECT unnest(range(1, 5)) AS cut) JOIN totals ON true
    JOIN counted x ON x.lang = kept.lang AND x.phrase = array_to_string(kept.w[1 : cut], ' ')
    JOIN counted y ON y.lang = kept.lang AND y.phrase = array_to_string(kept.w[cut + 1 : kept.k], ' ')
    WHERE cut < kept.k AND totals.lang = kept.lang
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000"""

ORACLE_SQL: dict[str, str] = {
    "op2_tool_call_linking": _TOOL_CALLS,
    "op5_substring_dedup": _SUBSTRINGS,
    "op10_embedding_near_dedup": _NEAR_VECTORS,
    "op13_phrase_mining": _PHRASES,
}
