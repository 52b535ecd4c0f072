"""How far the word use of sources differs: a K-squared quadtree over term counts.

For each language the counts of its kept terms form a matrix, a row for each source and a
column for each term, mostly zero. Terms are in the order of falling document frequency,
so the zeros gather at one side. The matrix is cut into pages, each a quadtree: a quadrant
without counts is a missing branch, and the leaves are small blocks of counts. Two pages of
the same columns are walked jointly. Where the branches of both are missing, all terms of
the quadrant have the two groups' shares of an unseen term, so one product prices them;
where one is there, the walk goes on to the leaves and adds up their terms. The diagonal
page walks with itself. Pages are joined by columns, each pair in a task of its own, and
their sums are added; work grows with the counts and with the pairs of sources asked for.

All arithmetic is in whole numbers. The share of a term is found by long division in steps
of a thousand, which is exact for totals below 9e15.

Defined cases: null text, lang and source count as empty; every group that occurs gets its
pairs even without a term (all shares are then those of an unseen term); a language without
kept terms has pairs of value 0 and no terms; a language of one source has no pairs;
repeated rows count as often as they come; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.common import written
from reelspark.operators.spread import lookup_join, rank_within

#: A term is kept in a language where so many of its documents hold it.
LEAST_DOCS = 10
TOP_TERMS = 10
#: Shares are in parts of this.
UNIT = 1_000_000_000
#: Terms that a counting task holds at a time.
HELD = 200_000


@dataclass(frozen=True)
class Shape:
    """Rows and columns of a leaf, and levels above the leaves of a page."""

    rows: int = 16
    columns: int = 128
    levels: int = 4

    @property
    def page_rows(self) -> int:
        return self.rows << self.levels

    @property
    def page_columns(self) -> int:
        return self.columns << self.levels


SHAPE = Shape()
_NO_CELLS = np.empty(0, dtype=np.int64)

#: Bytes of a text that belong to terms, A-Z lower-cased; all others part terms.
_TERM_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(docs: DataFrame, most: int = HELD) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it), added up."""
    texts = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )

    def rows(counts: dict, holders: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            own = holders[lang, source]
            terms = list(found)
            for at in range(0, len(terms), 8192):
                some = terms[at : at + 8192]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(some)),
                        "source": pa.array([source] * len(some)),
                        "term": pa.array(some, pa.binary()).cast(pa.string()),
                        "n": pa.array([found[t] for t in some], pa.int64()),
                        "docs": pa.array([own[t] for t in some], pa.int64()),
                    }
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, holders, held = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
                terms = text.as_py().translate(_TERM_BYTES).split()
                if not terms:
                    continue
                own = counts[lang, source]
                before = len(own)
                own.update(terms)
                holders[lang, source].update(set(terms))
                held += len(own) - before
                if held > most:
                    yield from rows(counts, holders)
                    counts, holders, held = defaultdict(Counter), defaultdict(Counter), 0
        yield from rows(counts, holders)

    parts = texts.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * count / total), exact: long division in base 1000."""
    left, out = count, 0
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return 1 + out


def share_column(count: Column, total: Column) -> Column:
    """The same as an expression."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * count.cast("decimal(19,0)")
    # pmod and subtraction keep to whole numbers, where a quotient would round
    return (F.lit(1) + ((wide - wide % total.cast("decimal(19,0)")) / total.cast("decimal(19,0)")).cast("long")).cast("long")


def gap(p, q):
    """floor((p - q)^2 / (p + q)) of arrays."""
    return (p - q) * (p - q) // (p + q)


class Page:
    """A block of the matrix as a quadtree: which quadrants of each level hold counts,
    and the shares of the terms in its leaves."""

    def __init__(self, shape: Shape, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        self.shape, self.totals = shape, totals
        self.unseen = shares(np.full(len(totals), 2), totals)
        self.leaves: dict[tuple[int, int], tuple] = {}
        self.levels: list[set[tuple[int, int]]] = []
        at = rows // shape.rows * (1 << shape.levels) + columns // shape.columns
        order = np.argsort(at, kind="stable")
        spots, starts = np.unique(at[order], return_index=True)
        for spot, members in zip(spots.tolist(), np.split(order, starts[1:])):
            row, column = divmod(spot, 1 << shape.levels)
            low = row * shape.rows
            mine = self.unseen[low : low + shape.rows]
            block = np.repeat(mine[:, None], shape.columns, axis=1)
            r, c = rows[members], columns[members] % shape.columns
            block[r - low, c] = shares(counts[members] + 2, totals[r])
            self.leaves[row, column] = block
        nodes = set(self.leaves)
        for _ in range(shape.levels + 1):
            self.levels.append(nodes)
            nodes = {(r >> 1, c >> 1) for r, c in nodes}

    def block(self, row: int, column: int) -> np.ndarray:
        """A leaf's shares; one row of unseen shares where it is missing."""
        found = self.leaves.get((row, column))
        return self.unseen[row * self.shape.rows : (row + 1) * self.shape.rows][:, None] if found is None else found


def walk(a: Page, b: Page, width: int) -> np.ndarray:
    """For each pair of rows of two pages, the sum of gaps over the first ``width``
    columns."""
    out = np.zeros((len(a.totals), len(b.totals)), dtype=np.int64)
    free = gap(a.unseen[:, None], b.unseen[None, :])
    shape = a.shape

    def visit(level: int, ra: int, rb: int, column: int) -> None:
        span = shape.columns << level
        terms = min(width, (column + 1) * span) - column * span
        high = shape.rows << level
        rows, columns = slice(ra * high, (ra + 1) * high), slice(rb * high, (rb + 1) * high)
        if terms <= 0 or not free[rows, columns].size:
            return
        if (ra, column) not in a.levels[level] and (rb, column) not in b.levels[level]:
            out[rows, columns] += terms * free[rows, columns]
        elif level:
            for i in (0, 1):
                for j in (0, 1):
                    for k in (0, 1):
                        visit(level - 1, 2 * ra + i, 2 * rb + j, 2 * column + k)
        else:
            p, q = a.block(ra, column)[:, :terms], b.block(rb, column)[:, :terms]
            for i in range(len(p)):
                found = gap(p[i][None, :], q)
                # a row without a leaf in either page is one column wide
                out[ra * high + i, columns] += found.sum(axis=1) * (1 if found.shape[1] == terms else terms)

    visit(shape.levels, 0, 0, 0)
    return out


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, shape: Shape = SHAPE, held: int = HELD
) -> DataFrame:
    """lang, source, part, item, value and rank, of parts ``pair`` and ``term``."""
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    counts = written(term_counts(docs, held), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("all_docs"))
    kept = written(kept.where(F.col("all_docs") >= least_docs), "kept")
    columns = rank_within(kept, "lang", [F.desc("all_docs"), F.col("term")], "column")
    columns = written(columns.withColumn("column", F.col("column") - 1), "columns")
    langs = columns.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_n"))
    cells = lookup_join(counts.select("lang", "source", "term", "n"), columns, ["lang", "term"])
    cells = written(cells, "cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("_n"))
    ranked = rank_within(groups, "lang", [F.col("source")], "row").withColumn("row", F.col("row") - 1)
    ranked = lookup_join(ranked, sums, ["lang", "source"], "left")
    ranked = lookup_join(ranked, langs, ["lang"], "left")
    ranked = written(ranked.select(
        "lang", "source", "row", F.coalesce("v", F.lit(0)).cast("long").alias("v"), "lang_n",
        (F.coalesce("_n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).cast("long").alias("total"),
    ), "groups")
    return _pairs(cells, ranked, shape).union(_terms(cells, ranked, top))


def _terms(cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms that a group uses more than its language does."""
    named = lookup_join(cells, groups.select("lang", "source", "v", "lang_n", "total"), ["lang", "source"])
    p = share_column(F.col("n") + 2, F.col("total"))
    q = share_column(F.col("all_n") + 2, F.col("lang_n") + 2 * F.col("v"))
    found = named.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    found = found.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("term"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )


def _pairs(cells: DataFrame, groups: DataFrame, shape: Shape) -> DataFrame:
    """The sums of all pairs of sources of a language."""
    height, breadth = shape.page_rows, shape.page_columns
    rows = groups.withColumn("page_row", F.floor(F.col("row") / height).cast("int"))
    # every page of a language's grid, so that pages without counts are priced as well
    heads = rows.where("v > 0").groupBy("lang", "page_row", "v").agg(
        F.sort_array(F.collect_list(F.struct("row", "total"))).alias("totals")
    )
    last = F.floor((F.col("v") - 1) / breadth).cast("int")
    heads = heads.select("lang", "page_row", "v", F.col("totals.total").alias("totals"), F.explode(F.sequence(F.lit(0), last)).alias("page_column"))
    place = lookup_join(cells.select("lang", "source", "column", "n"), groups.select("lang", "source", "row"), ["lang", "source"])
    place = place.select(
        "lang",
        F.floor(F.col("row") / height).cast("int").alias("page_row"),
        F.floor(F.col("column") / breadth).cast("int").alias("page_column"),
        F.struct((F.col("row") % height).cast("int").alias("r"), (F.col("column") % breadth).cast("int").alias("c"), "n").alias("cell"),
    )
    spot = ["lang", "page_row", "page_column"]
    # at most height x breadth counts each, by construction
    pages = heads.join(place.groupBy(*spot).agg(F.collect_list("cell").alias("cells")), spot, "left")
    pages = written(pages, "pages")
    asked = heads.groupBy("lang").agg(F.max("page_row").alias("last"))
    met = lookup_join(pages, asked, ["lang"]).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    ).select(
        "lang", "page_column", "page_row", "v", "totals", "cells",
        F.least("page_row", "other").alias("low"), F.greatest("page_row", "other").alias("high"),
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lang, width, low, high = {}, "", 0, 0, 0
        for batch in batches:
            heads = batch.drop_columns(["cells"]).to_pylist()
            for head, cells in zip(heads, batch["cells"]):
                lang, low, high = head["lang"], head["low"], head["high"]
                width = min(head["v"] - head["page_column"] * breadth, breadth)
                own = [cells.values.field(k).to_numpy().astype(np.int64) for k in "rcn"] if cells.is_valid else [_NO_CELLS] * 3
                found[head["page_row"]] = Page(shape, *own, np.array(head["totals"], dtype=np.int64))
        value = walk(found[low], found[high], width)
        i, j = np.divmod(np.arange(value.size), value.shape[1])
        i, j, value = i + low * height, j + high * height, value.reshape(-1)
        keep = i < j
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * int(keep.sum()), pa.string()), "a": i[keep], "b": j[keep], "value": value[keep]}
        )

    parts = met.groupBy("lang", "low", "high", "page_column").applyInArrow(sums, "lang string, a long, b long, value long")
    parts = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # languages without kept terms: pairs of value 0
    few = groups.where("v = 0").select("lang", F.col("row").alias("a"))
    none = few.join(few.withColumnRenamed("a", "b"), "lang").where("a < b").withColumn("value", F.lit(0).cast("long"))
    half = written(parts.union(none.select("lang", "a", "b", "value")), "pairs")
    both = half.union(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("row").alias("a"), "source")
    both = lookup_join(both, names, ["lang", "a"])
    both = lookup_join(both, names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))
    return both.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )
