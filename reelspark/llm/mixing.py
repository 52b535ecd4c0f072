"""Mix sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies that each of its documents
should have; the whole part is certain, the fraction is rounded. Rounding pairs two
fractional documents and moves words between them, up or down at random so that each
expectation stays, until one has a whole copy or none; the other goes on. This runs
over random chunks of a source, the leftover of each chunk moves to the next level, and
so on up a tree until one fractional document per source is left, which is rounded by
chance. The words of a source so miss their target by less than one document.

All of it is built-in expressions: a chunk is one array fold.

Defined cases: a null text has size 0 and is never taken; null is a source of its own,
last in order; rows that repeat doc_id, source and size are told apart by a number and
rounded on their own; an empty table gives no rows. Random numbers are hashes of the
rows, so reruns agree. Other columns pass through ``repeat_documents`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.common import WORD, text_of, unused, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
#: Documents that one fold takes, on average.
CHUNK = 96

_EPS = 1e-9


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size, and a number that tells equal rows apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
    )
    same = Window.partitionBy("doc_id", "source", "size").orderBy("doc_id")
    return rows.withColumn("_copy", F.row_number().over(same))


def targets(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """source, source_size and target: one row per source.

    Filling by weight under a cap: with sources in order of cap over weight, the first
    one whose cap is at or above the level that the uncapped ones share gives the level.
    The windows run over one row per source.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    t = totals.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(most))
    t = t.withColumn("_r", F.col("_cap") / F.col("_w"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy("_r", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = t.withColumn("_all", F.sum("source_size").over(every) * share)
    spent = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    t = t.withColumn("_level", (F.col("_all") - spent) / F.sum("_w").over(onward))
    t = t.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_r"), F.struct("_r", "_level"))).over(every)["_level"])
    filled = F.least(F.col("_cap"), F.col("_level") * F.col("_w"))
    return t.select("source", "source_size", "_docs", F.coalesce(filled, F.col("_cap")).alias("target"))


def _unit(seed: int, *parts: Column) -> Column:
    """A number from 0 up to 1, from a hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 52)) / float(1 << 52)


def _fold(items: Column, seed: int) -> Column:
    """Pivotal rounding over an array of (key, a, x): a words, x the fraction left.

    The state holds one unsettled document and the settled ones.
    """
    item = "struct<key:struct<doc_id:bigint,size:bigint,_copy:int>,a:double,x:double>"
    settled = "array<struct<key:struct<doc_id:bigint,size:bigint,_copy:int>,x:double>>"
    start = F.struct(F.lit(None).cast(item).alias("rest"), F.array().cast(settled).alias("done"))

    def settle(entry: Column, x: Column) -> Column:
        return F.struct(entry["key"].alias("key"), x.alias("x"))

    def step(state: Column, new: Column) -> Column:
        old = state["rest"]
        up = F.least(old["a"] * (1 - old["x"]), new["a"] * new["x"])
        down = F.least(old["a"] * old["x"], new["a"] * (1 - new["x"]))
        rise = _unit(seed, old["key"], new["key"]) * (up + down) < down
        moved = F.when(rise, up).otherwise(-down)
        x, y = old["x"] + moved / old["a"], new["x"] - moved / new["a"]
        pair = F.transform(
            F.array(F.struct(old.alias("e"), x.alias("x")), F.struct(new.alias("e"), y.alias("x"))),
            lambda p: F.struct(
                p["e"].alias("e"),
                F.when(p["x"] < _EPS, 0.0).when(p["x"] > 1 - _EPS, 1.0).otherwise(p["x"]).alias("x"),
            ),
        )
        whole = F.filter(pair, lambda p: (p["x"] == 0.0) | (p["x"] == 1.0))
        open_ = F.filter(pair, lambda p: (p["x"] > 0.0) & (p["x"] < 1.0))
        left = F.get(open_, F.lit(0))
        rest = F.when(
            left.isNotNull(),
            F.struct(left["e"]["key"].alias("key"), left["e"]["a"].alias("a"), left["x"].alias("x")),
        )
        done = F.concat(state["done"], F.transform(whole, lambda p: settle(p["e"], p["x"])))
        return F.when(old.isNull(), F.struct(new.cast(item).alias("rest"), state["done"].alias("done"))).otherwise(
            F.struct(rest.cast(item).alias("rest"), done.alias("done"))
        )

    return F.aggregate(items, start, step)


def rounded(open_items: DataFrame, largest: int, chunk: int = CHUNK) -> DataFrame:
    """source, key, x (0 or 1) for items (source, key, a, x); ``largest`` is the number
    of items of the largest source and sets the height of the tree."""
    chunks, level, parts = max(1, -(-largest // chunk)), 0, []
    counted = open_items
    while True:
        slot = F.pmod(F.xxhash64(F.lit(level), "key"), F.lit(chunks))
        grouped = counted.groupBy("source", slot.alias("_slot")).agg(
            F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(level), "key").alias("h"), "key", "a", "x"))).alias("i")
        )
        items = F.transform("i", lambda e: F.struct(e["key"].alias("key"), e["a"].alias("a"), e["x"].alias("x")))
        folded = written(grouped.select("source", _fold(items, level).alias("s")), "rounding")
        parts.append(folded.select("source", F.explode("s.done").alias("d")).select("source", "d.key", "d.x"))
        rest = folded.where("s.rest is not null").select("source", "s.rest.key", "s.rest.a", "s.rest.x")
        if chunks == 1:
            last = F.when(_unit(level + 1, F.col("key")) < F.col("x"), 1.0).otherwise(0.0)
            parts.append(rest.select("source", "key", last.alias("x")))
            out = parts[0]
            for part in parts[1:]:
                out = out.unionByName(part)
            return out
        counted, chunks, level = rest, -(-chunks // chunk), level + 1


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row."""
    rows = written(sized(docs), "sizes")
    goal = written(targets(rows, weights, share, most), "targets")
    largest = goal.agg(F.max("_docs")).first()[0] or 0
    # one row per source: Spark broadcasts it where it is small, and may split it else
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = (
        rows.withColumnRenamed("source", "_s")
        .join(goal.withColumn("_per", per), F.col("_s").eqNullSafe(F.col("source")))
        .drop("_s")
    )
    whole = F.floor(F.col("_per") + _EPS)
    joined = joined.withColumn("_whole", whole).withColumn("_x", F.greatest(F.col("_per") - whole, F.lit(0.0)))
    key = F.struct("doc_id", "size", F.col("_copy").cast("int").alias("_copy"))
    fractional = (F.col("_x") > _EPS) & (F.col("size") > 0)
    open_items = joined.where(fractional).select(
        "source", key.alias("key"), F.col("size").cast("double").alias("a"), F.col("_x").alias("x")
    )
    won = (
        rounded(open_items, largest)
        .where("x = 1.0")
        .select(F.col("source").alias("_s"), F.col("key.doc_id").alias("_d"), F.col("key.size").alias("_z"), F.col("key._copy").alias("_c"))
        .withColumn("_won", F.lit(1))
    )
    same = (
        F.col("source").eqNullSafe(F.col("_s"))
        & F.col("doc_id").eqNullSafe(F.col("_d"))
        & (F.col("size") == F.col("_z"))
        & (F.col("_copy") == F.col("_c"))
    )
    out = joined.join(won, same, "left")
    copies = F.when(F.col("size") > 0, F.col("_whole") + F.coalesce("_won", F.lit(0))).otherwise(0).cast("long")
    return out.select(
        "doc_id", "source", "size", "_copy", "source_size", F.col("target").cast("double").alias("target"),
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns only."""
    decided = mix(docs, **options)
    size, copy, times = (unused(docs, n) for n in ("_size", "_copy", "_times"))
    rows = docs.withColumn(size, F.regexp_count(text_of(), F.lit(WORD)).cast("long"))
    same = Window.partitionBy("doc_id", "source", size).orderBy("doc_id")
    repeated = decided.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    rows = rows.withColumn(copy, F.row_number().over(same) if repeated else F.lit(1))
    right = decided.where("copies > 0").select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_copy").alias("_c"),
        F.col("copies").alias("_k"),
    )
    right = right.toDF(*(unused(rows, c) for c in right.columns))
    d, s, z, c, k = (right[n] for n in right.columns)
    joined = rows.join(
        right, rows["doc_id"].eqNullSafe(d) & rows["source"].eqNullSafe(s) & (rows[size] == z) & (rows[copy] == c)
    )
    return joined.withColumn(times, F.explode(F.sequence(F.lit(1), k.cast("int")))).select(*docs.columns)
