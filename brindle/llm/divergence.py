"""Source divergence audit: how far each source's use of words is from the others'.

Terms are runs of ASCII letters and anything beyond ASCII, A-Z in lower case; each lang
keeps the ``V`` terms that at least ``least`` of its documents hold. A group (lang,
source), and a lang, gives each kept term ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``,
``N`` being the sum of its counts of kept terms. The divergence of two such numbers is
``f = floor((p - q)^2 / (p + q))``. All numbers are whole.

Count-cell ranking: terms with the same pair of counts are one cell, as ``f`` depends on
nothing else, so ``f`` is worked out once a cell and weighted with the number of its terms.

* Part ``term`` (group against lang, p > q): cells are (group count, lang count). Cells of
  an equal value are merged, the merged cells ranked by value, and the cumulative number
  of terms says which of them reach rank ``most``. Only those are expanded to terms, in
  the order of their UTF-8 bytes.
* Part ``pair`` (group against each other source of the lang): cells are (own count, other
  count). Only terms that both hold make rows. A term that one or none of them holds has
  the other's number for a count of 0, so its cells follow from the histogram of the
  holder's counts, and from V.

Words are counted within tasks first, by group and term, with Arrow's hash tables over
the words' bytes, so a lang or source with most of the documents arrives as a row for
each task and term. Null ``text``, ``lang`` and ``source`` count as ''. A repeated row is
one more document. A lang without kept terms has only pairs, of value 0; a group without
terms takes part in pairs; an empty table gives an empty report.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm import text
from brindle.llm.tables import prepare, written

SCALE = 1_000_000_000
LEAST, MOST = 10, 10
# Rows of counts that a task holds before it hands them on.
HELD = 2_000_000


def counted(data: np.ndarray, at: np.ndarray, group: np.ndarray) -> pa.Table:
    """``group``, ``term``, ``n`` and ``docs`` (rows with it) of texts with the given groups."""
    low = text.fold(data)
    starts, ends, first = text.words(low, at, text.LETTERS)
    if not len(starts):
        none = pa.array([], pa.int64())
        return pa.table({"group": none, "term": pa.array([], pa.string()), "n": none, "docs": none})
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    # the words one after another: what is no letter lies between them
    body = pa.py_buffer(low[text.LETTERS[low]])
    terms = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), body).dictionary_encode()
    term = terms.indices.to_numpy().astype(np.int64)
    n_terms = len(terms.dictionary)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    pair = np.sort(row * n_terms + term)
    heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    times = np.diff(np.append(heads, len(pair)))
    row, term = np.divmod(pair[heads], n_terms)
    key = group[row] * n_terms + term
    sums = pa.table({"key": key, "n": times}).group_by("key", use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    of_group, term = np.divmod(sums["key"].to_numpy(), n_terms)
    return pa.table(
        {
            "group": of_group,
            "term": terms.dictionary.take(pa.array(term)).cast(pa.string()),
            "n": sums["n_sum"].cast(pa.int64()),
            "docs": sums["n_count"].cast(pa.int64()),
        }
    )


def _merged(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.rename_columns(["group", "term", "n", "docs"])


def term_counts(documents: DataFrame, body: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, each group's terms once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        waiting: list[pa.Table] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            if waiting:
                whole = _merged(waiting)
                names = list(groups)
                of = whole["group"].to_pylist()
                columns = [pa.array([names[g][k] for g in of], pa.string()) for k in (0, 1)]
                columns += [whole[c].combine_chunks() for c in ("term", "n", "docs")]
                yield from pa.table(columns, ["lang", "source", "term", "n", "docs"]).to_batches(100_000)

        for batch in batches:
            named = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            group = np.array([groups.setdefault(pair, len(groups)) for pair in named], np.int64)
            for lo, hi, data, at in text.pieces(batch.column(0)):
                waiting.append(counted(data, at, group[lo:hi]))
                held += len(waiting[-1])
                if held > HELD:
                    waiting = [_merged(waiting)]
                    held = len(waiting[0])
                    if held > HELD // 2:
                        yield from out()
                        groups, waiting, held = {}, [], 0
                        group = np.array([groups.setdefault(pair, len(groups)) for pair in named], np.int64)
        yield from out()

    rows = documents.select(F.col(body).alias("body"), _name(lang).alias("lang"), _name(source).alias("source"))
    counts = rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def share(count: str, total: str, terms: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``; the product may go beyond 64 bits.

    Without terms there is nothing to share out, and the number isn't used.
    """
    whole = f"cast(greatest({total} + 2 * {terms}, 1) as decimal(20, 0))"
    return F.expr(f"1L + (cast({SCALE} as decimal(10, 0)) * cast({count} + 2 as decimal(20, 0))) div {whole}")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def audit(
    documents: DataFrame, body: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, most: int = MOST
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of both parts: all other sources of
    the lang, and the ``most`` terms that the source has more of than its lang."""
    prepare(documents.sparkSession)
    counts = written(term_counts(documents, body, lang, source), "term-counts")
    known = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    kept = written(counts.join(known.drop("docs"), ["lang", "term"]).select("lang", "source", "term", "n", "total"), "kept-terms")

    langs = known.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    occurring = documents.select(_name(lang).alias("lang"), _name(source).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count("*").alias("n_terms"))
    groups = occurring.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = written(groups.select("lang", "source", "n_group", "n_terms", "v", "n_lang"), "groups")
    return _terms(kept, groups, most).unionByName(_pairs(kept, groups))


def _terms(kept: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """The part ``term``."""

    def valued(rows: DataFrame) -> DataFrame:
        p, q = share("n", "n_group", "v"), share("total", "n_lang", "v")
        return rows.withColumns({"p": p, "q": q}).where("p > q").withColumn("value", divergence("p", "q"))

    cells = kept.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("terms"))
    merged = valued(cells.join(groups, ["lang", "source"])).groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # a value has a term at least, so no more than ``most`` values reach the report
    highest = merged.withColumn("place", F.row_number().over(down)).where(F.col("place") <= most)
    before = F.sum("terms").over(down) - F.col("terms")
    reached = highest.withColumn("before", before).where(F.col("before") < most)
    limits = written(reached.groupBy("lang", "source").agg(F.min("value").alias("limit")), "value-limits")
    expanded = valued(kept.join(groups.join(limits, ["lang", "source"]), ["lang", "source"])).where("value >= limit")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    listed = expanded.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most)
    return listed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The part ``pair``."""
    one = groups.select("lang", "source", "n_group", "n_terms", "v").withColumn("none", share("0", "n_group", "v"))
    other = one.select("lang", *[F.col(c).alias(f"other_{c}") for c in ("source", "n_group", "n_terms", "none")])
    both = written(one.join(other, "lang").where("source < other_source"), "source-pairs")
    ids = ["lang", "source", "other_source"]

    # terms of both
    mine = kept.select("lang", "term", "source", "n")
    theirs = kept.select("lang", "term", F.col("source").alias("other_source"), F.col("n").alias("other_n"))
    met = mine.join(theirs, ["lang", "term"]).where("source < other_source")
    cells = met.groupBy(*ids, "n", "other_n").agg(F.count("*").alias("terms"))
    shares = {"p": share("n", "n_group", "v"), "q": share("other_n", "other_n_group", "v")}
    beside = divergence("p", "q") - divergence("p", "other_none") - divergence("none", "q")
    shared = cells.join(both, ids).withColumns(shares).groupBy(*ids).agg(
        F.sum(F.col("terms") * beside).alias("value"), F.sum("terms").alias("n_met")
    )

    # terms of one, as if the other had none of them
    histogram = written(kept.groupBy("lang", "source", "n").agg(F.count("*").alias("terms")), "count-histogram")
    alone = histogram.join(both, ["lang", "source"]).withColumn("p", share("n", "n_group", "v")).groupBy(*ids).agg(
        F.sum(F.col("terms") * divergence("p", "other_none")).alias("value")
    )
    turned = histogram.withColumnsRenamed({"source": "other_source", "n": "other_n"}).join(both, ["lang", "other_source"])
    turned = turned.withColumn("q", share("other_n", "other_n_group", "v")).groupBy(*ids).agg(
        F.sum(F.col("terms") * divergence("none", "q")).alias("value")
    )
    held = shared.unionByName(alone.withColumn("n_met", F.lit(0).cast("bigint"))).unionByName(
        turned.withColumn("n_met", F.lit(0).cast("bigint"))
    ).groupBy(*ids).agg(F.sum("value").alias("value"), F.sum("n_met").alias("n_met"))

    # terms of neither
    neither = F.expr("v - n_terms - other_n_terms + coalesce(n_met, 0L)")
    rest = F.when(F.col("v") > 0, neither * divergence("none", "other_none")).otherwise(F.lit(0))
    summed = written(both.join(held, ids, "left").select(*ids, (F.coalesce("value", F.lit(0)) + rest).alias("value")), "pair-values")
    way = summed.select("lang", "source", F.col("other_source").alias("item"), "value")
    back = summed.select("lang", F.col("other_source").alias("source"), F.col("source").alias("item"), "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return way.unionByName(back).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank")
    )
