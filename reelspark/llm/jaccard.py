"""Near copies by exact Jaccard similarity of word shingles, through a token-group matrix.

A document's set holds the hashes of its distinct shingles; equal sets are one node.

1. A fixed table of counts over all shingles gives one order for them, rare ones first.
2. Nodes that share a minimum under one of a few hash functions are compared with one
   of them, in linear work. Linked nodes form groups, every other node is a group alone.
3. The matrix keeps each group's union of tokens. Two sets that are similar enough share
   tokens among their rarest ones: the smaller set among its first seventh, the larger
   one among its first quarter. The matrix therefore lists those tokens only, and the
   number of a query's rare tokens in a group's union bounds the overlap. A group opens
   for a query when the bound is met.
4. In an open group the query's whole set is first held against the union of all tokens
   of the members, which bounds the overlap again, and then against the members.

Step 3 misses no link between groups, whatever order step 1 gave: it is a matter of work
only. So components are exact up to collisions of 64-bit hashes. Hot tokens, hot groups
and large groups are split: joins on tokens may be divided, groups open in chunks of
members and of queries.

Defined cases: null or wordless texts have an empty set and link with nothing; a text
shorter than the shingle is one shingle; rows with a null doc_id take part but cannot
name a component unless all of it is null; repeated rows get equal results; an empty
table gives no rows; other columns pass through ``keep_one`` untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import sliced, small_batches, text_of, unused, written
from reelspark.llm.graph import components
from reelspark.operators.spread import lookup_join

WIDTH = 5
#: Similarity in percent.
PERCENT = 75
#: Entries of the count table: 16 MB, whatever the corpus.
CELLS = 1 << 23
SEGMENTS = 32
#: Hash functions of step 2.
ROUNDS = 4
#: Rare tokens that a query and a group must share, where sets are large enough.
MATCHES = 2
#: Members and queries that meet in one task at a time, on average.
MEMBERS, QUERIES = 64, 256
#: Word hashes that a task keeps at hand.
WORDS = 1 << 16
#: Bytes up to which a narrow side of a join is broadcast; beyond, both sides shuffle.
BROADCAST_BYTES = 4 << 20

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _FACTORS[3]
    h = (h ^ (h >> np.uint64(29))) * _FACTORS[0]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str, hashes: dict, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    k = min(n, width)
    x = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    h = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h = _scrambled(h * _FACTORS[1] + x[j : n - k + 1 + j])
    return np.unique(h)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def small_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join with a narrow stored side: broadcast if its values are measured small."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in right.dtypes if kind in ("string", "binary")]
    width = sum(wide, F.lit(8 * len(right.columns)))
    if (right.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), keys, how)
    return lookup_join(left, right, keys, how)


def token_counts(docs: DataFrame, width: int, cells: int = CELLS) -> np.ndarray:
    """How many documents hold a shingle of each cell: a table of fixed size."""
    step = cells // SEGMENTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = _WordHashes(), np.zeros(cells, dtype=np.uint16)
        for batch in sliced(batches):
            sets = [shingle_set(t, hashes, width) for t in batch["text"].to_pylist()]
            if sets:
                at = (np.concatenate(sets) & np.uint64(cells - 1)).astype(np.int64)
                at, times = np.unique(at, return_counts=True)
                # counts end at 65,535 here as in the sum
                total[at] = np.minimum(total[at] + times, 2**16 - 1)
        blobs = []
        for s in range(SEGMENTS):
            part = total[s * step : (s + 1) * step]
            at = np.flatnonzero(part)
            gaps = np.diff(at, prepend=0).astype("<u4")
            blobs.append(zlib.compress(gaps.tobytes() + part[at].astype("<u4").tobytes(), 1))
        yield pa.RecordBatch.from_pydict({"segment": pa.array(range(SEGMENTS), pa.int32()), "counts": blobs})

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, segment = np.zeros(step, dtype=np.int64), 0
        for batch in rows:
            for s, blob in zip(batch["segment"].to_pylist(), batch["counts"].to_pylist()):
                segment = s
                data = zlib.decompress(blob)
                if data:
                    gaps, times = np.frombuffer(data, dtype="<u4").reshape(2, -1)
                    total[np.cumsum(gaps)] += times
        blob = np.minimum(total, 2**16 - 1).astype("<u2").tobytes()
        yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "counts": [blob]})

    schema = "segment int, counts binary"
    parts = _texts(docs).mapInArrow(count, schema).groupBy("segment").applyInArrow(add, schema).collect()
    table = np.zeros(cells, dtype=np.uint16)
    for row in parts:
        table[row["segment"] * step : (row["segment"] + 1) * step] = np.frombuffer(row["counts"], dtype="<u2")
    return table


def _needed(n: int, percent: int) -> tuple[int, int]:
    """Least overlap of a set of n with any similar one, and with a similar larger one."""
    return -(-percent * n // 100), -(-2 * percent * n // (100 + percent))


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, node, minima and rare tokens of every row, stored."""
    table = docs.sparkSession.sparkContext.broadcast(token_counts(docs, width))
    seeds = (np.arange(1, ROUNDS + 1, dtype=np.uint64) * _FACTORS[2]).astype(np.uint64)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _WordHashes(), table.value
        for batch in sliced(batches):
            out = {"n": [], "node": [], "minima": [], "rare": [], "first": [], "common": []}
            for text in batch["text"].to_pylist():
                s = shingle_set(text, hashes, width)
                n = len(s)
                out["n"].append(n)
                if not n:
                    for name in ("node", "minima", "rare", "first", "common"):
                        out[name].append(None)
                    continue
                out["node"].append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                out["minima"].append([int(_scrambled(s ^ x).min().view(np.int64)) for x in seeds])
                least, least_larger = _needed(n, percent)
                matches = min(MATCHES, least)
                seen = counts[(s & np.uint64(CELLS - 1)).astype(np.int64)]
                rare = np.lexsort((s, seen))[: n - least + matches]
                out["rare"].append(s[rare].tobytes())
                out["common"].append(float(np.log(seen[rare].astype(float)).mean()))
                out["first"].append(n - least_larger + matches)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(out["n"], pa.int64()),
                    pa.array(out["node"], pa.int64()),
                    pa.array(out["minima"], pa.list_(pa.int64())),
                    pa.array(out["rare"], pa.binary()),
                    pa.array(out["first"], pa.int32()),
                    pa.array(out["common"], pa.float64()),
                ],
                names=["doc_id", "n", "node", "minima", "rare", "first", "common"],
            )

    schema = "doc_id long, n long, node long, minima array<long>, rare binary, first int, common double"
    return written(_texts(docs).mapInArrow(describe, schema), "shingles")


def rare_tokens(rows: DataFrame) -> DataFrame:
    """token, node, n, grp and whether the token is among the first of its set, for rows
    with a blob of tokens."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            blobs = batch["rare"].to_pylist()
            lengths = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            for name in ("node", "n", "grp", "first"):
                assert batch[name].null_count == 0
            repeat = {c: np.repeat(batch[c].to_numpy(), lengths) for c in ("node", "n", "grp", "first")}
            yield pa.RecordBatch.from_pydict(
                {
                    "token": np.frombuffer(b"".join(blobs), dtype=np.int64),
                    "node": repeat["node"],
                    "n": repeat["n"],
                    "grp": repeat["grp"],
                    "early": place < repeat["first"],
                }
            )

    columns = rows.select("node", "n", "grp", "first", "rare")
    return columns.mapInArrow(spread, "token long, node long, n long, grp long, early boolean")


def open_groups(
    docs: DataFrame, nodes: DataFrame, queries: DataFrame, members: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links (a, b) found by holding queries (node, grp) against the members (node, grp)
    of their groups. A query that links to several members of a chunk yields one link.

    nodes: node, n and rep, a document with that set.
    """
    asked = queries.groupBy("grp").agg(F.count("*").alias("_q"))
    sizes = lookup_join(members, asked, ["grp"], "left_semi").groupBy("grp").agg(F.count("*").alias("_m"))
    shape = asked.join(sizes, "grp").select(
        "grp",
        F.ceil(F.col("_m") / MEMBERS).cast("int").alias("_chunks"),
        F.ceil(F.col("_q") / QUERIES).cast("int").alias("_salts"),
    )
    shape = written(shape, "shapes")
    # no group has more than MEMBERS or QUERIES rows on average in a (chunk, salt)
    left = lookup_join(queries, shape, ["grp"]).select(
        "node", "grp", F.lit(True).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("node"), F.col("_salts")).cast("int").alias("salt"),
    )
    right = lookup_join(members, shape, ["grp"]).select(
        "node", "grp", F.lit(False).alias("asks"),
        F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("salt"),
    )
    places = written(left.union(right), "places")
    wanted = written(lookup_join(nodes, places.select("node").distinct(), ["node"]).select(
        F.col("rep").alias("doc_id"), "node"
    ), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in sliced(batches):
            found = [shingle_set(t, hashes, width) for t in batch["text"].to_pylist()]
            # rows that share the id of the wanted document without its set drop out here
            same = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in found]
            keep = [i for i, (a, b) in enumerate(zip(same, batch["node"].to_pylist())) if a == b]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([same[i] for i in keep], pa.int64()),
                    pa.array([found[i].tobytes() for i in keep], pa.binary()),
                ],
                names=["node", "tokens"],
            )

    texts = small_join(
        _texts(docs).withColumn("_key", F.coalesce("doc_id", F.lit(_NO_ID))),
        wanted.withColumn("_key", F.coalesce("doc_id", F.lit(_NO_ID))).drop("doc_id"),
        ["_key"],
        "inner",
    ).select("node", "text")
    whole = texts.mapInArrow(sets, "node long, tokens binary")
    together = small_join(whole, places, ["node"], "inner")

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks: dict[int, np.ndarray] = {}
        holds: dict[int, np.ndarray] = {}
        for batch in rows:
            for node, blob, ask in zip(
                batch["node"].to_pylist(), batch["tokens"].to_pylist(), batch["asks"].to_pylist()
            ):
                (asks if ask else holds)[node] = np.frombuffer(blob, dtype=np.uint64)
        a, b = [], []
        if holds:
            names = np.array(list(holds), dtype=np.int64)
            sizes_ = np.array([len(s) for s in holds.values()], dtype=np.int64)
            tokens = np.concatenate(list(holds.values()))
            owner = np.repeat(np.arange(len(names)), sizes_)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            union = np.unique(tokens)
            for node, s in asks.items():
                inside = s[np.searchsorted(union, s) < len(union)]
                inside = inside[union[np.searchsorted(union, inside)] == inside]
                # similar sets overlap in percent / (100 + percent) of both sizes
                if (100 + percent) * len(inside) < percent * (len(s) + int(sizes_.min())):
                    continue
                low, high = np.searchsorted(tokens, inside), np.searchsorted(tokens, inside, side="right")
                runs = high - low
                if not len(runs):
                    continue
                at = np.repeat(low - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
                shared = np.bincount(owner[at], minlength=len(names))
                hit = np.flatnonzero(
                    ((100 + percent) * shared >= percent * (len(s) + sizes_)) & (names != node)
                )
                if len(hit):
                    a.append(node)
                    b.append(int(names[hit[0]]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return written(together.groupBy("grp", "chunk", "salt").applyInArrow(compare, "a long, b long"), "links")


#: Stands for a null id where rows are matched.
_NO_ID = -(1 << 63)


def links(docs: DataFrame, base: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The nodes (node, n, rep) and links between them that connect all that is linked."""
    named = base.where("n > 0")
    nodes = written(
        named.groupBy("node").agg(
            F.min("doc_id").alias("rep"),
            F.min("n").alias("n"),
            F.min("minima").alias("minima"),
            F.max("common").alias("common"),
        ),
        "nodes",
    )
    # step 2: one comparison per node and hash function, with a node of about its size: the
    # one whose rare tokens are the most common, since its copies have tokens of their own
    keys = nodes.select(
        "node",
        "common",
        F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).alias("band"),
        F.posexplode("minima").alias("round", "least"),
    )
    first = keys.groupBy("round", "least", "band").agg(
        F.max_by("node", F.struct("common", "node")).alias("grp"), F.count("*").alias("_n")
    ).where("_n > 1")
    pairs = lookup_join(keys, first, ["round", "least", "band"]).where("node <> grp").select("node", "grp").distinct()
    pairs = written(pairs, "pairs")
    leaders = pairs.select(F.col("grp").alias("node"), "grp").distinct()
    found = open_groups(docs, nodes, pairs, leaders, width, percent)
    groups = written(components(found).select("node", F.col("root").alias("grp")), "groups")

    # step 3: the matrix holds the tokens that more than one group has
    rows = small_join(named, groups, ["node"], "left").withColumn("grp", F.coalesce("grp", "node"))
    seen = rare_tokens(rows).groupBy("token").agg(
        F.min("grp").alias("_low"), F.max("grp").alias("_high"), F.max("early").alias("_early")
    )
    several = written(seen.where("_low < _high and _early").select("token"), "tokens")
    shared = written(small_join(rare_tokens(rows), several, ["token"], "left_semi").distinct(), "matrix")
    matrix = (
        shared.where("early")
        .groupBy("token", F.col("grp").alias("other"))
        .agg(F.min("n").alias("low"), F.max("n").alias("high"))
    )
    meets = lookup_join(shared, matrix, ["token"]).where(
        (F.col("grp") != F.col("other"))
        & (F.col("n") >= F.col("low"))
        & (percent * F.col("n") <= 100 * F.col("high"))
    )
    least = F.ceil(percent * F.least("n", "low") / 100)
    bound = meets.groupBy("node", "other").agg(
        F.count("*").alias("met"), F.min(F.least(F.lit(MATCHES), least)).alias("need")
    )
    queries = written(bound.where("met >= need").select("node", F.col("other").alias("grp")), "queries")
    # step 4
    alone = nodes.select("node", F.col("node").alias("grp")).join(groups.select("node"), "node", "left_anti")
    more = open_groups(docs, nodes, queries, groups.union(alone), width, percent)
    return nodes, found.union(more)


def _components(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, n and node of every row, and node and component_id of every node."""
    with small_batches(docs.sparkSession):
        base = described(docs, width, percent)
        nodes, linked = links(docs, base, width, percent)
        linked = written(linked, "all-links")
    roots = components(linked)
    owned = lookup_join(nodes.select("node", "rep"), roots, ["node"], "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = owned.groupBy("root").agg(F.min("rep").alias("component_id"))
    return base, written(lookup_join(owned, least, ["root"]).select("node", "root", "component_id"), "components")


def near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    base, named = _components(docs, width, percent)
    return lookup_join(base.select("doc_id", "n", "node"), named, ["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, with all its columns: the one with the
    smallest id, rows without an id last; of rows that repeat that id any one.

    Rows are told apart by a number, not by their id: of two texts with one id, a copy
    goes and a text without another copy stays. Rows without words are in no group and
    stay, as often as they come.
    """
    place = unused(docs, "_place")
    numbered = written(docs.withColumn(place, F.monotonically_increasing_id()), "numbered")
    # the number stands in for the id, which only names the rows in what follows
    rows = numbered.select(F.col(place).alias("doc_id"), "text")
    base, named = _components(rows, width, percent)
    ids = numbered.select(F.col(place).alias("doc_id"), F.col("doc_id").alias("id"))
    found = lookup_join(base.select("doc_id", "node"), named.select("node", "root"), ["node"])
    found = lookup_join(found, ids, ["doc_id"])
    order = F.struct(F.col("id").isNull().alias("late"), "id", "doc_id")
    first = written(found.groupBy("root").agg(F.min(order)["doc_id"].alias("_first")), "first")
    extra = lookup_join(found, first, ["root"]).where("doc_id <> _first").select(F.col("doc_id").alias(place))
    kept = small_join(numbered, written(extra, "extra"), [place], "left_anti")
    return kept.select(*docs.columns)
