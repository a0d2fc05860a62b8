"""The registered queries of the subpackage, each over the whole of its tables, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries import table
from .context_tree import context_tree_scores
from .decontaminate import leaks
from .divergence import source_divergence
from .exact_dedup import exact_duplicates
from .licenses import license_spans
from .mixing import mix
from .negatives import hard_negatives
from .passages import remove_passages
from .repeats import remove_repeats
from .secrets import secret_spans
from .simhash import near_duplicates
from .token_counts import byte_level_pieces, token_counts
from .toxicity import toxicity

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), byte_level_pieces(VOCABULARY))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


OP2_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, translate(coalesce(text, ''), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), '') AS bare
    FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
    SELECT doc_id, sha256(bare) AS text_sha256,
        first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(t) DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY bare) AS group_size
    FROM d
)
"""


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_spans(table(spark, folder, "documents"))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).drop("source", "times")


def op7_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree_scores(table(spark, folder, "documents"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_spans(table(spark, folder, "documents"))


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


OP11_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
tok AS (SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
found AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k ON g.lang = k.lang
    LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
),
shares AS (
    SELECT lang, source, term, n,
        1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p
    FROM grid
),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM grid GROUP BY lang, term)
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
groups AS (SELECT DISTINCT lang, source FROM d),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every
)
WHERE part = 'pair' OR rank <= 200
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), label=label)


OP12_SQL = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id AS other_id, list_dot_product(a.v, o.v)::BIGINT AS score
    FROM e a JOIN e o ON a.vec_id % 100 = 0 AND o.vec_id <> a.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM scored WHERE same
    ) WHERE place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
    SELECT p.*, n.other_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INT AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
) WHERE rank <= 5
"""


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_passages(table(spark, folder, "documents")).drop("spans")


OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
windows AS (
    SELECT row, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 11, 1))) AS i FROM d)
),
judged AS (SELECT row, i, doc_id > min(doc_id) OVER (PARTITION BY w) AS gone FROM windows),
covered AS (SELECT row, list(DISTINCT p) AS gone FROM (SELECT row, unnest(range(i, i + 13)) AS p FROM judged WHERE gone) GROUP BY row),
cut AS (
    SELECT doc_id, len(words) AS n, coalesce(len(gone), 0) AS n_gone,
        [words[p] for p in range(1, len(words) + 1) if gone IS NULL OR NOT list_contains(gone, p)] AS kept
    FROM d LEFT JOIN covered USING (row)
)
SELECT doc_id, n AS n_words, n_gone AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM cut
"""


QUERIES = {
    "op1_token_counts": (op1_token_counts, None),
    "op2_exact_dedup": (op2_exact_dedup, OP2_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_license_scan": (op4_license_scan, None),
    "op5_suffix_dedup": (op5_suffix_dedup, None),
    "op6_mix_sources": (op6_mix_sources, None),
    "op7_context_tree": (op7_context_tree, None),
    "op8_secret_scan": (op8_secret_scan, None),
    "op9_decontaminate": (op9_decontaminate, None),
    "op10_simhash": (op10_simhash, None),
    "op11_source_divergence": (op11_source_divergence, OP11_SQL),
    "op12_hard_negatives": (op12_hard_negatives, OP12_SQL),
    "op13_substring_dedup": (op13_substring_dedup, OP13_SQL),
}
