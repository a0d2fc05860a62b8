"""Counts, co-occurrence and PMI over the lines of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import (
    cooccurrence,
    distinct_terms,
    doc_freq,
    documents_of,
    line_count,
    lines_of,
    pair_counts,
    pmi,
    stripes,
    tokenize,
    top_pair,
    top_partners,
    vocab_positions,
    word_count,
)
from ..plans.sizing import dealt
from . import table

# Places of the sorted vocabulary, from either end.
PLACES = [1, -3, 2, 100, 5000, -1, -2000]
ANCHORS = ["the", "de", "License.", "und"]

LINES_SQL = r"""
split AS (
  SELECT doc_id, string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') AS parts FROM documents
),
lines AS (SELECT doc_id AS docid, unnest(range(len(parts))) AS ln, unnest(parts) AS line FROM split)"""

LINE_TERMS_SQL = LINES_SQL + r""",
tok AS MATERIALIZED (
  SELECT docid, ln, unnest(list_distinct([t for t in string_split_regex(line, '\s+') if t <> ''])) AS term FROM lines
)"""

# Every pair of different words of a line, without any pruning.
PAIRS_SQL = LINE_TERMS_SQL + """,
df AS MATERIALIZED (SELECT term, count(*) AS df FROM tok GROUP BY term),
ids AS MATERIALIZED (SELECT term, row_number() OVER () AS id FROM df),
numbered AS MATERIALIZED (SELECT docid, ln, id FROM tok JOIN ids USING (term)),
once AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b, count(*) AS n
  FROM numbered a JOIN numbered b ON a.docid = b.docid AND a.ln = b.ln AND a.id < b.id
  GROUP BY 1, 2 HAVING count(*) >= 10
),
named AS (SELECT p.term AS x, q.term AS y, n FROM once JOIN ids p ON p.id = once.a JOIN ids q ON q.id = once.b),
pairs AS MATERIALIZED (SELECT x, y, n FROM named UNION ALL SELECT y, x, n FROM named),
scored AS (
  SELECT x, y, n, log10(n::DOUBLE * (SELECT count(*) FROM lines) / (dx.df::DOUBLE * dy.df::DOUBLE)) AS pmi
  FROM pairs JOIN df dx ON dx.term = x JOIN df dy ON dy.term = y
)"""

# Each pair once, of the words that are frequent enough by themselves.
HALF_SQL = LINE_TERMS_SQL + """,
df AS MATERIALIZED (SELECT term, count(*) AS df, row_number() OVER (ORDER BY term) AS id FROM tok GROUP BY term HAVING count(*) >= 10),
numbered AS MATERIALIZED (SELECT docid, ln, id FROM tok JOIN df USING (term)),
once AS (
  SELECT a.id AS a, b.id AS b, count(*) AS n
  FROM numbered a JOIN numbered b ON a.docid = b.docid AND a.ln = b.ln AND a.id < b.id
  GROUP BY 1, 2 HAVING count(*) >= 10
),
scored AS (
  SELECT p.term AS x, q.term AS y, n, log10(n::DOUBLE * (SELECT count(*) FROM lines) / (p.df::DOUBLE * q.df::DOUBLE)) AS pmi
  FROM once JOIN df p ON p.id = once.a JOIN df q ON q.id = once.b
)"""

ALPHA_COUNTS_SQL = """
counts AS (
  SELECT term, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS term FROM documents) GROUP BY term
)"""

WS_COUNTS_SQL = r"""
counts AS (
  SELECT term, count(*) AS cnt
  FROM (SELECT unnest([t for t in string_split_regex(text, '\s+') if t <> '']) AS term FROM documents) GROUP BY term
)"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return dealt(documents_of(table(spark, folder, "documents"), "doc_id", "text"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_of(_texts(spark, folder), "docid", "line")


def _counts(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    return word_count(tokenize(_texts(spark, folder), mode))


def _pmi(spark: SparkSession, folder: str) -> DataFrame:
    return pmi(_lines(spark, folder))


def cooccur_stripes(spark: SparkSession, folder: str) -> DataFrame:
    found = stripes(cooccurrence(_lines(spark, folder), by="stripes"))
    return found.select("x", F.explode("stripe").alias("y", "n"))


QUERIES = {
    "wordcount_alpha": (
        lambda spark, folder: _counts(spark, folder, "alpha"),
        f"WITH {ALPHA_COUNTS_SQL} SELECT term, cnt FROM counts",
    ),
    "wordcount_ws": (
        lambda spark, folder: _counts(spark, folder, "ws"),
        f"WITH {WS_COUNTS_SQL} SELECT term, cnt FROM counts",
    ),
    "line_df": (
        lambda spark, folder: doc_freq(tokenize(_lines(spark, folder), distinct=True)),
        f"WITH {LINE_TERMS_SQL} SELECT term, count(*) AS df FROM tok GROUP BY term",
    ),
    "line_count": (
        lambda spark, folder: line_count(_lines(spark, folder)),
        f"WITH {LINES_SQL} SELECT count(*) AS n FROM lines",
    ),
    "distinct_terms": (
        lambda spark, folder: distinct_terms(tokenize(_texts(spark, folder))),
        f"WITH {WS_COUNTS_SQL} SELECT count(*) AS terms FROM counts",
    ),
    "vocab_positions": (
        lambda spark, folder: vocab_positions(_counts(spark, folder, "alpha"), PLACES),
        f"""WITH {ALPHA_COUNTS_SQL},
        placed AS (
          SELECT term, cnt, row_number() OVER (ORDER BY term) AS up, row_number() OVER (ORDER BY term DESC) AS down FROM counts
        )
        SELECT up AS position, term, cnt FROM placed WHERE up IN ({", ".join(str(p) for p in PLACES if p > 0)})
        UNION ALL SELECT -down, term, cnt FROM placed WHERE -down IN ({", ".join(str(p) for p in PLACES if p < 0)})""",
    ),
    "cooccur_pairs": (
        lambda spark, folder: cooccurrence(_lines(spark, folder)),
        f"WITH {PAIRS_SQL} SELECT x, y, n FROM pairs",
    ),
    "cooccur_stripes": (cooccur_stripes, f"WITH {PAIRS_SQL} SELECT x, y, n FROM pairs"),
    "pmi_pairs": (
        lambda spark, folder: _pmi(spark, folder).filter("x < y").withColumn("pmi", F.round("pmi", 8)),
        f"WITH {HALF_SQL} SELECT x, y, n, round(pmi, 8) AS pmi FROM scored",
    ),
    "pmi_pair_counts": (
        lambda spark, folder: pair_counts(_pmi(spark, folder)),
        f"""WITH {PAIRS_SQL}
        SELECT count(*) AS ordered, count(*) FILTER (WHERE x < y) AS unordered FROM scored""",
    ),
    "pmi_top1": (
        lambda spark, folder: top_pair(_pmi(spark, folder)).withColumn("pmi", F.round("pmi", 8)),
        f"""WITH {PAIRS_SQL}
        SELECT x, y, n, round(pmi, 8) AS pmi FROM scored WHERE x < y ORDER BY scored.pmi DESC, x, y LIMIT 1""",
    ),
    "pmi_top_partners": (
        lambda spark, folder: top_partners(_pmi(spark, folder), ANCHORS).withColumn("pmi", F.round("pmi", 8)),
        f"""WITH {PAIRS_SQL},
        ranked AS (
          SELECT x, row_number() OVER (PARTITION BY x ORDER BY pmi DESC, y) AS rank, y, pmi
          FROM scored WHERE x IN ({", ".join(f"'{a}'" for a in ANCHORS)})
        )
        SELECT x, rank, y, round(pmi, 8) AS pmi FROM ranked WHERE rank <= 3""",
    ),
}
