"""Audit of how the words of a language's sources diverge, by stripes that are folded in the mappers.

A partition folds whole documents into stripes, ``term -> (documents, occurrences by source)``, and spills them when
they have grown to a bound. Stripes of one term meet in the order of their keys and are merged in one pass over a
sorted stream. A merged stripe has all that a term adds to the divergences: the shares of each source side by side.
All arithmetic is that of whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.sizing import broadcast_if_small
from ..plans.skew import lookup_join
from .columns import each_text, whole_text

# Fixed values of the contract: documents a term must be in, the unit of shares, ranks told of terms.
MIN_DOCS, UNIT_STEPS, TOP = 3, 3, 200
# Occurrence counts (one for a term and source) that a task holds before it spills, and that are scored together.
HELD, TOGETHER = 300_000, 1 << 16
# Cells of terms by sources that are looked at together.
CELLS = 1 << 20
# Bytes of a text that are cut into words together.
PIECE = 1 << 22

# ASCII letters and everything beyond ASCII, in UTF-8; lower() of bytes changes A-Z alone.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")

STRIPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("sources", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
STRIPE_DDL = "lang string, term string, df bigint, sources array<int>, counts array<bigint>"


def term_counts(text: bytes) -> Counter:
    """How often a text has each of its terms."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        border = BREAK.search(text, at + PIECE)
        end = border.start() if border else len(text)
        counts.update(TERM.findall(text[at:end].lower()))
        at = end
    return counts


def _stripe_rows(lang: list, term: list, df: list, sizes: list, sources: list, counts: list) -> pa.RecordBatch:
    offsets = pa.array(np.r_[0, np.cumsum(np.asarray(sizes, np.int64))].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(sources, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(term, pa.string()), pa.array(df, pa.int64()), *lists], schema=STRIPE)


def _folded(held: int):
    def spill(stripes: dict[str, dict[bytes, list]]) -> Iterator[pa.RecordBatch]:
        for lang, terms in stripes.items():
            keys = list(terms)
            for i in range(0, len(keys), 50_000):
                part = [terms[k] for k in keys[i : i + 50_000]]
                yield _stripe_rows(
                    [lang] * len(part),
                    [k.decode() for k in keys[i : i + 50_000]],
                    [df for df, _ in part],
                    [len(by) for _, by in part],
                    [s for _, by in part for s in by],
                    [n for _, by in part for n in by.values()],
                )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, list]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["number"].to_pylist(), each_text(batch["text"])):
                terms = stripes.setdefault(lang, {})
                for term, n in term_counts(text).items():
                    stripe = terms.get(term)
                    if stripe is None:
                        terms[term] = [1, {source: n}]
                        entries += 1
                        continue
                    stripe[0] += 1
                    by = stripe[1]
                    if source in by:
                        by[source] += n
                    else:
                        by[source] = n
                        entries += 1
                if entries >= held:
                    yield from spill(stripes)
                    stripes, entries = {}, 0
        yield from spill(stripes)

    return fold


def _merged(min_docs: int):
    """Stripes come sorted by language and term; those of one key become one. A key's rows are never held but as their sum."""

    def summed(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """One row a key, and the documents of each."""
        n = len(rows)
        changes = pc.or_(*(pc.not_equal(rows[c].slice(1), rows[c].slice(0, n - 1)) for c in ("lang", "term")))
        first = np.flatnonzero(np.r_[True, changes.to_numpy()])
        df = np.add.reduceat(rows["df"].to_numpy(), first)
        sources, counts = rows["sources"].combine_chunks(), rows["counts"].combine_chunks()
        key = np.repeat(np.repeat(np.arange(len(first)), np.diff(np.r_[first, n])), pc.list_value_length(sources).to_numpy())
        sources, counts = sources.flatten().to_numpy(), counts.flatten().to_numpy()
        order = np.lexsort((sources, key))
        key, sources, counts = key[order], sources[order], counts[order]
        cell = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (sources[1:] != sources[:-1])])
        sizes = np.bincount(key[cell], minlength=len(first))
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (sources[cell], np.add.reduceat(counts, cell))]
        keys = [rows[c].combine_chunks().take(pa.array(first)) for c in ("lang", "term")]
        return pa.Table.from_arrays([*keys, pa.array(df), *lists], schema=STRIPE), df

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch.cast(STRIPE)])
            rows, df = summed(rows if before is None else pa.concat_tables([before, rows]))
            before = rows.slice(len(rows) - 1)
            yield from rows.slice(0, len(rows) - 1).filter(pa.array(df[:-1] >= min_docs)).combine_chunks().to_batches()
        if before is not None and before["df"][0].as_py() >= min_docs:
            yield from before.combine_chunks().to_batches()

    return merge


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total) of whole numbers, three digits at a time, so that nothing overflows."""
    whole, rest = np.zeros_like(count), count + 1
    for _ in range(UNIT_STEPS):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return whole + 1


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _scored(top: int):
    """What a share of a language's stripes adds to its divergences; the other side has each source's total."""
    schema = pa.schema([("lang", pa.string()), ("number", pa.int32()), ("other", pa.int32()), ("term", pa.string()), ("value", pa.int64())])

    def score(key: tuple, stripes: pa.Table, totals: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        totals = totals.sort_by("number")
        size, n = len(totals), totals["n"].to_numpy()
        terms = totals["terms"][0].as_py()
        pairs = np.zeros((size, size), np.int64)
        stripes = stripes.take(pc.sort_indices(stripes["term"].cast(pa.binary()))).combine_chunks()
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in range(size)]  # values and rows
        step = max(1, CELLS // max(1, size))
        for at in range(0, len(stripes), step):
            part = stripes.slice(at, step)
            sources, counts = part["sources"].combine_chunks(), part["counts"].combine_chunks()
            cells = np.zeros((len(part), size), np.int64)
            row = np.repeat(np.arange(len(part)), pc.list_value_length(sources).to_numpy())
            cells[row, sources.flatten().to_numpy()] = counts.flatten().to_numpy()
            p = share(cells, n + terms)
            q = share(cells.sum(axis=1), int(n.sum()) + terms)
            for i in range(size):
                pairs[i] += _divergence(p[:, [i]], p).sum(axis=0)
                told = np.flatnonzero((cells[:, i] > 0) & (p[:, i] > q))
                value = np.r_[best[i][0], _divergence(p[told, i], q[told])]
                where = np.r_[best[i][1], at + told]  # rows are in the order of their terms
                order = np.lexsort((where, -value))[:top]
                best[i] = value[order], where[order]
        a, b = np.divmod(np.arange(size * size), size) if size else (np.zeros(0, np.int64),) * 2
        apart = a != b
        rows = [len(v) for v, _ in best]
        where = np.concatenate([w for _, w in best]) if size else np.zeros(0, np.int64)
        count = int(apart.sum())
        columns = [
            pa.array([lang] * (count + sum(rows)), pa.string()),
            pa.array(np.r_[a[apart], np.repeat(np.arange(size), rows)], pa.int32()),
            pa.concat_arrays([pa.array(b[apart], pa.int32()), pa.nulls(sum(rows), pa.int32())]),
            pa.concat_arrays([pa.nulls(count, pa.string()), stripes["term"].combine_chunks().take(pa.array(where)).cast(pa.string())]),
            pa.array(np.concatenate([pairs.ravel()[apart], *(v for v, _ in best)])),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    return score


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    held: int = HELD,
    together: int = TOGETHER,
) -> DataFrame:
    """``<lang, source, part, item, value, rank>``: how far each source of a language is from its others, and in which terms.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a language keeps those in ``min_docs``
    of its documents. A source's share of a term is ``1 + floor(10**9 * (count + 1) / (all + terms))``, one of the
    language likewise over all its documents, and ``(p - q)**2 / q``, rounded down, is the divergence of two shares.
    Part ``pair`` has every other source of the language with the divergence summed over all kept terms; part
    ``term`` the ``top`` kept terms that the source has a greater share of than the language, with that term's
    divergence. Ranks go by value, then by item.

    Null texts, languages and sources count as empty ones. A source of a language is told even if it has no term,
    and pairs of a language without kept terms have 0. Each row is a document, repeated ones too; other columns,
    whatever their names, are not read. Sources of a language meet in pairs, as the result has them all; shuffled
    are stripes only, one for a term and task that holds ``held`` counts at most.
    """
    rows = docs.select(*(whole_text(c).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    groups = rows.groupBy("lang", "source").agg(F.count("*").alias("documents"))
    number = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    groups = durable(groups.withColumn("number", number), "groups")
    numbered = lookup_join(rows, groups, ["lang", "source"], "documents").select("lang", "number", "text")
    folded = numbered.mapInArrow(_folded(held), STRIPE_DDL)
    sorted_ = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    stripes = durable(sorted_.mapInArrow(_merged(min_docs), STRIPE_DDL), "stripes")

    kept = stripes.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.size("sources")).alias("entries"))
    chunks = F.greatest(F.lit(1), F.ceil(F.coalesce("entries", F.lit(0)) / together)).cast("int")
    langs = groups.select("lang").distinct().join(kept, "lang", "left")
    langs = durable(langs.select("lang", F.coalesce("terms", F.lit(0)).alias("terms"), chunks.alias("chunks")), "langs")
    counted = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    counted = counted.groupBy("lang", F.col("e.sources").alias("number")).agg(F.sum("e.counts").alias("n"))
    totals = groups.select("lang", "number").join(counted, ["lang", "number"], "left").join(langs, "lang")
    totals = totals.select("lang", "number", F.coalesce("n", F.lit(0)).alias("n"), "terms", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    dealt = lookup_join(stripes, langs, "lang", "terms").select("lang", F.pmod(F.xxhash64("term"), "chunks").cast("int").alias("chunk"), "term", "sources", "counts")
    schema = "lang string, number int, other int, term string, value bigint"
    scored = dealt.groupBy("lang", "chunk").cogroup(totals.groupBy("lang", "chunk")).applyInArrow(_scored(top), schema)
    scored = durable(scored, "scored")

    names = groups.select("lang", "number", "source")
    pairs = durable(scored.filter("term IS NULL").groupBy("lang", "number", "other").agg(F.sum("value").alias("value")), "pairs")
    others = names.select("lang", F.col("number").alias("other"), F.col("source").alias("item"))
    pairs = pairs.join(broadcast_if_small(others), ["lang", "other"]).select("lang", "number", F.lit("pair").alias("part"), "item", "value")
    best = [F.desc("value"), F.asc("item")]
    terms = scored.filter("term IS NOT NULL").select("lang", "number", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    ranked = [t.withColumn("rank", F.row_number().over(W.partitionBy("lang", "number").orderBy(*best))) for t in (pairs, terms)]
    both = ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))
    return both.join(broadcast_if_small(names), ["lang", "number"]).select("lang", "source", "part", "item", "value", "rank")
