"""Exact duplicates by recipes of content-defined chunks, in DataFrame functions alone.

A text is cut where its own characters say so, so equal texts have equal chunks. Chunks are deduplicated first, and
their hashes verified: two different chunks of one hash get different identifiers. A document is then its recipe,
the ordered list of its chunks' identifiers, and only recipes, some 8 bytes for about 700 of text, are grouped and
joined. Texts move once at most, as distinct chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.skew import lookup_join
from .columns import BLANKS, doc_rows

# A chunk ends after this many characters at least and at most, ...
SHORTEST, LONGEST = 512, 8192
# ... and in between after two characters of this class: every ninth code point of Latin-1, by rule.
CUT_CLASS = "".join(f"\\x{c:02x}" for c in range(256) if c % 9 == 1)


def normalised(text: Column) -> Column:
    """The text without blanks."""
    return F.translate(text, BLANKS, "")


def chunks(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The chunks of a text in order; concatenated they are the text, and an empty text has none."""
    pattern = f"(?s).{{{shortest},{longest}}}?[{CUT_CLASS}]{{2}}|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_hash(chunk: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits)


def _recipes(docs: DataFrame, bits: int) -> DataFrame:
    """``<doc_id, n_chars, text_sha256, recipe>`` with verified identifiers in the recipes, written."""
    bare = docs.select("doc_id", F.length("text").alias("n_chars"), normalised(F.col("text")).alias("bare"))
    cut = bare.withColumn("cut", chunks(F.col("bare")))
    by_hash = cut.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("bare").cast("binary"), 256).alias("text_sha256"),
        F.transform("cut", lambda c: F.struct(chunk_hash(c, bits).alias("hash"), F.lit(0).alias("variant"))).alias("recipe"),
    )
    # Distinct chunks meet whole; only their hashes are then counted.
    distinct = bare.select(F.explode(chunks(F.col("bare"))).alias("chunk")).distinct()
    hashed = distinct.withColumn("hash", chunk_hash(F.col("chunk"), bits))
    shared = hashed.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("hash")
    collided = durable(shared, "collided")
    if collided.isEmpty():
        return durable(by_hash, "recipes")
    # Different chunks with one hash: number them, and put the numbers into the recipes that hold such a hash.
    variants = (
        hashed.join(collided, "hash", "left_semi")
        .groupBy("hash")
        .agg(F.posexplode(F.array_sort(F.collect_list("chunk"))).alias("variant", "chunk"))
    )
    placed = cut.select(F.sha2(F.col("bare").cast("binary"), 256).alias("text_sha256"), F.posexplode("cut").alias("at", "chunk"))
    resolved = (
        placed.distinct()
        .withColumn("hash", chunk_hash(F.col("chunk"), bits))
        .join(variants, ["hash", "chunk"], "left")
        .groupBy("text_sha256")
        .agg(F.array_sort(F.collect_list(F.struct("at", "hash", F.coalesce("variant", F.lit(0)).alias("variant")))).alias("placed"))
        .select("text_sha256", F.transform("placed", lambda p: F.struct(p["hash"].alias("hash"), p["variant"].alias("variant"))).alias("exact"))
    )
    merged = by_hash.join(resolved, "text_sha256", "left")
    return durable(merged.select("doc_id", "n_chars", "text_sha256", F.coalesce("exact", "recipe").alias("recipe")), "recipes")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hash_bits: int = 64) -> DataFrame:
    """``<doc_id, keep_id, group_size, kept, text_sha256>``, one row per document, dropped ones too.

    Texts that are equal but for blanks form a group. The row with the most characters stays, then the one of the
    smallest id; a null id comes last. A null text counts as empty; all empty texts are one group. Rows that
    repeat an id are members of their own: each counts in ``group_size``, and ``kept`` is told by the id alone.
    ``hash_bits`` under 64 makes hashes collide, for tests.
    """
    rows = _recipes(doc_rows(docs, doc_id, text), hash_bits)
    ranked = F.struct("n_chars", (-F.col("doc_id")).alias("rank"))
    groups = rows.groupBy("recipe").agg(F.count("*").alias("group_size"), F.max(ranked).alias("best"))
    kept = durable(groups.select("recipe", "group_size", (-F.col("best.rank")).alias("keep_id")), "groups")
    joined = lookup_join(rows, kept, "recipe", "group_size", broadcast_bytes=16 << 20)
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
