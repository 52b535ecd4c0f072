"""Shards of bounded size by extendible hashing.

A directory maps hash prefixes to shards. A shard that is too large is split on the next
bit of the hash, and only that one, until each fits its byte limit. Bytes are added up
per prefix at the directory's depth first; the sizes of all shorter prefixes follow from
those sums, so one round settles every shard that fits by that depth, and the next round
reads only the rows of cells that are still too large, ``STEP`` bits deeper.

Defined cases: a null id hashes like the empty text; a null text has no bytes; rows with
equal ids have equal hashes and stay together, so a shard of one id may exceed the limit
and says so in ``oversized``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import text_of, written
from reelspark.operators.spread import lookup_join

LIMIT_BYTES = 1 << 20
#: Bits of the hash in use.
BITS = 60
STEP = 12


def hash_bits(key: str) -> Column:
    """The first 60 bits of the md5 of the key's text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.left(F.md5(text), F.lit(BITS // 4)), 16, 10).cast("long")


def _prefix(bits: Column, depth: Column) -> Column:
    return F.call_function("shiftright", bits, (F.lit(BITS) - depth).cast("int"))


def _leaves(cells: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """prefix, depth, bytes, rows and fits for the cells of one round: each cell's
    shallowest ancestor between the two depths that fits, else the cell itself.

    Sizes never grow with depth, so the first depth that fits is the shard's.
    """
    depths = F.sequence(F.lit(base), F.lit(depth))
    above = cells.withColumn("depth", F.explode(depths)).withColumn("prefix", _prefix(F.col("_bits"), F.col("depth")))
    nodes = above.groupBy("depth", "prefix").agg(
        F.sum("_bytes").alias("bytes"),
        F.sum("_rows").alias("rows"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
        F.min("_bits").alias("_first"),
    )
    fits = (F.col("bytes") <= limit) | (F.col("_low") == F.col("_high"))
    nodes = nodes.withColumn("fits", fits)
    # a node is a shard if it fits and its parent does not
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_parent"), F.col("fits").alias("_parent_fits")
    )
    nodes = nodes.withColumn("_parent", F.shiftright("prefix", 1))
    joined = nodes.join(parents, ["depth", "_parent"], "left")
    open_parent = F.coalesce(~F.col("_parent_fits"), F.lit(True))
    return joined.where(open_parent & (F.col("fits") | (F.col("depth") == depth))).select(
        "depth", "prefix", "bytes", "rows", "fits", "_low", "_high"
    )


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The shards of rows (_bits, _bytes)."""
    done: list[DataFrame] = []
    left, base = rows, 0
    while True:
        depth = min(base + STEP, BITS)
        cells = left.groupBy((F.shiftright("_bits", BITS - depth)).alias("_cell")).agg(
            F.sum("_bytes").alias("_bytes"),
            F.count("*").alias("_rows"),
            F.min("_bits").alias("_low"),
            F.max("_bits").alias("_high"),
        )
        cells = cells.withColumn("_bits", F.shiftleft("_cell", BITS - depth))
        found = written(_leaves(cells, base, depth, limit), "directory")
        if depth == BITS:
            done.append(found)
            break
        done.append(found.where("fits"))
        too_large = found.where("not fits")
        if not too_large.limit(1).count():
            break
        keys = too_large.select(F.col("prefix").alias("_cell"))
        left = lookup_join(left.withColumn("_cell", F.shiftright("_bits", BITS - depth)), keys, ["_cell"]).drop("_cell")
        base = depth
    return reduce(DataFrame.unionByName, done)


def placed(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows with the depth, prefix, bytes and rows of their shard.

    A directory entry is a cell at the depth of the shallowest shard, and holds the shards
    below it as an array, of which a row matches one. So entries number no more than
    shards, however deep the deepest shard lies.
    """
    least = shards.agg(F.min("depth")).first()[0] or 0
    within = F.call_function("shiftright", F.col("prefix"), (F.col("depth") - least).cast("int"))
    entries = shards.groupBy(within.alias("_cell")).agg(
        F.collect_list(F.struct("depth", "prefix", "bytes", "rows")).alias("_shards")
    )
    met = lookup_join(rows.withColumn("_cell", F.shiftright("_bits", BITS - least)), entries, ["_cell"])
    own = F.filter("_shards", lambda s: _prefix(F.col("_bits"), s["depth"]) == s["prefix"])
    return met.select(*rows.columns, F.inline(own))


def shard(docs: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id") -> DataFrame:
    """The key, bytes and shard of every row: the shard's hash prefix as bits, its
    depth, its bytes and whether it is oversized."""
    rows = written(
        docs.select(
            F.col(key).alias("_key"), hash_bits(key).alias("_bits"), F.octet_length(text_of()).cast("long").alias("_bytes")
        ),
        "hashes",
    )
    out = placed(rows, directory(rows, limit))
    bits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth").cast("int"), "0")
    return out.select(
        F.col("_key").alias(key),
        F.col("_bytes").alias("n_bytes"),
        F.when(F.col("depth") == 0, "").otherwise(bits).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.col("bytes").alias("shard_bytes"),
        F.col("rows").alias("shard_rows"),
        (F.col("bytes") > limit).alias("oversized"),
    )
