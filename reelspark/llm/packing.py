"""Large-item matching packs documents into sequences of fixed length.

Only the number of pieces of each length decides which lengths share a sequence, and
there are at most ``capacity`` lengths. The plan is therefore made from that histogram:
pieces above a third of the capacity are matched greedily, at most two to a sequence,
the longest with the longest that still fits; shorter pieces go, longest first, where
they leave the least gap. The plan is a short list of patterns (lengths, number of
sequences); a piece finds its pattern by its rank among the pieces of its length. So
one plan covers all data, however it is partitioned, and no task sees more than rows.

Defined cases: a null text is empty and still ends with its end id; a repeated row is
packed as often as it occurs; null ids are kept; an empty table gives no rows; other
columns are not read. Which of several equal pieces goes where follows storage order.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.common import text_of, written
from reelspark.operators.spread import lookup_join

CAPACITY = 2048
#: Entries that a task keeps of already encoded words; the memory is emptied when full.
CACHE = 400_000

_ARROW = {"long": pa.int64(), "int": pa.int32()}
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _seq long"


def rank_file() -> str:
    """The vocabulary of byte_bpe_50k as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: The token that the vocabulary writes whole, and its id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


class Encoder:
    """Ids of a text as little-endian 32-bit integers.

    A text is first cut at the special token, which has an id of its own and which no
    other token reaches across.

    The splitting pattern never joins a character other than white space to a space
    after it, so a text may be cut before each single space between two other
    characters and every part looked up on its own.
    """

    _PAIR = re.compile(r"\s\s")
    _CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self._known: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.array(self._encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if SPECIAL not in text:
            return self._plain(text)
        special = np.array([SPECIAL_ID], dtype="<u4").tobytes()
        return special.join(self._plain(part) for part in text.split(SPECIAL))

    def _plain(self, text: str) -> bytes:
        parts = (self._CUT.split(text) if self._PAIR.search(text) else text.split(" ")) if text else [""]
        known, out = self._known, [self._direct(parts[0])]
        for part in parts[1:]:
            found = known.get(part)
            if found is None:
                if len(known) >= CACHE:
                    known.clear()
                found = self._direct(" " + part)
                if len(part) <= 64:
                    known[part] = found
            out.append(found)
        return b"".join(out)


def pieces_of(docs: DataFrame, ranks: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece; only documents above the capacity are cut, the first piece
    taking what is left over. The rows are stored: their places are used twice."""

    schema = pa.schema([(n, _ARROW[t]) for n, t in map(str.split, PIECES.split(", "))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks)
        end = np.array([end_id], dtype="<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                first = n if n <= capacity else (n % capacity or capacity)
                start, length, piece = 0, first, 0
                while start < n:
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc, piece, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
                    start, length, piece = start + length, capacity, piece + 1
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return written(rows.mapInArrow(cut, PIECES), "pieces")


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths in order, number of sequences) for a histogram of lengths."""
    left = {n: c for n, c in counts.items() if c}
    open_bins: list[tuple[int, int, tuple[int, ...]]] = []  # gap, number, lengths
    third = capacity // 3
    large = sorted(n for n in left if n > third)
    while large:
        top = large[-1]
        if not left[top]:
            large.pop()
            continue
        at = len([n for n in large if n <= capacity - top]) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        if at < 0:
            open_bins.append((capacity - top, left[top], (top,)))
            left[top] = 0
        else:
            mate = large[at]
            number = left[top] // 2 if mate == top else min(left[top], left[mate])
            if mate == top and number == 0:
                mates = [n for n in large[:at] if left[n]]
                if not mates:
                    open_bins.append((capacity - top, 1, (top,)))
                    left[top] = 0
                    continue
                mate, number = mates[-1], 1
            open_bins.append((capacity - top - mate, number, (top, mate)))
            left[top] -= number
            left[mate] -= number
    open_bins.sort()
    for n in sorted((n for n in left if n <= third), reverse=True):
        todo = left[n]
        while todo:
            at = bisect_left(open_bins, (n,))
            if at == len(open_bins):
                per = capacity // n
                full, rest = divmod(todo, per)
                if full:
                    insort(open_bins, (capacity - per * n, full, (n,) * per))
                if rest:
                    insort(open_bins, (capacity - rest * n, 1, (n,) * rest))
                break
            gap, number, lengths = open_bins.pop(at)
            times = min(gap // n, -(-todo // number))
            used = min(number, todo // times)
            insort(open_bins, (gap - times * n, used, lengths + (n,) * times))
            if used < number:
                insort(open_bins, (gap, number - used, lengths))
            todo -= used * times
    return [(list(lengths), number) for _, number, lengths in open_bins]


def slots(plan: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of each run of places."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, number in plan:
        offset = 0
        for n in lengths:
            rank = taken.get(n, 0)
            out.setdefault(n, []).append((rank, sequence, offset))
            taken[n] = rank + number
            offset += n
        sequence += number
    return {n: tuple(np.array(c, dtype=np.int64) for c in zip(*runs)) for n, runs in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces.

    The histogram has at most ``capacity`` rows. The rank of a piece is the number of
    pieces of its length in earlier partitions plus its own place, so no group of
    equally long pieces meets in one task.
    """
    tally = written(pieces.groupBy("length", "_part").agg(F.count("*").alias("_n")), "tally")
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places = slots(patterns(counts, capacity))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = tally.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = lookup_join(pieces, starts, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_seq"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            first, base, off = places[int(n)]
            run = np.searchsorted(first, ranks[rows], side="right") - 1
            sequence[rows] = base[run] + ranks[rows] - first[run]
            offset[rows] = off[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    kept = [c for c in pieces.columns if c not in ("_part", "_seq")]
    return ranked.withColumn("_place", place("length", "_rank")).select(
        *kept, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset")
    )
