"""Language-model scores from an Elias-Fano trie of all n-grams.

Every word, pair and triple of words of the training documents counts; none is merged or
dropped. The trie is dealt out by ranges of the hash of a context, so that all that
follows one context stands together. A shard of a level holds its contexts as a rising
Elias-Fano sequence, a monotone sequence of pointers from each context to its first
successor, the successors, and a quantised log probability for each. A context's
successors begin anew at the value that the context before ends with, so the whole level
rises, and a successor can only be searched relative to its context: find the context,
follow its pointers, add the base that stands before them, search between them.

Documents are cut into chunks of a bounded number of tokens. A chunk sends each of its
distinct nodes to its shard once, with how often its training documents hold it. The
shard adds up, smooths and quantises, writes its levels as one file in the shared folder,
maps that file into memory and answers every chunk from it; a chunk's answers meet its
tokens again. So a hot word is asked for once a chunk, the number of shards grows with
the text, and no worker holds more than one shard or one chunk. A context that many words
follow is split by its successors into as many contexts as there are shards.

The model is a hierarchy of Dirichlet priors: add-one words, smoothed into pairs, these
into triples. What a level keeps of a pair or triple is the log of its joint probability,
in steps of 1/4096 of a decade; a shard answers with the whole number of occurrences that
it stands for, so a token's log10 probability is off by at most 5e-4. Counts of words, and
the base score from them, are exact.

Defined cases: a null text is empty and has only its end token; a null id is the empty
text, so its remainder is 0 and it trains; repeated rows count as often as they occur;
with no training document every token is unknown; an empty table gives no rows; other
columns are not read. Word counts are exact up to collisions of 61-bit hashes; pairs and
triples are told apart by 29 bits of their context and 32 of their own path, and a context
that is split adds the bits of the split.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import shared_folder, text_of, written

FOLDS, HELD_OUT = 7, 2
#: Tokens of a chunk; longer documents are cut.
CHUNK = 1 << 19
#: Bytes of text whose nodes a shard holds on average, and the least number of shards.
SHARD_BYTES, SHARDS = 8 << 20, 128
#: Which of a place's nodes (word, pair, triple) are counted in one shuffle, and which half
#: of their names, where not all: triples take two shuffles, each half the disk.
ROUNDS = (((0, 1), None), ((2,), 0), ((2,), 1))
#: Weight of the shorter context: so many observations of its distribution.
PRIOR = 4.0
#: Words whose hashes a task keeps at hand.
WORDS = 400_000
#: Low bits of a node's name that tell successors apart; the bits above name the context.
SUCCESSOR_BITS = 34
#: A context is split if its word is more than one in so many tokens (at most twice as
#: many words are; of a chunk only such words are told).
HOT = 512
#: Where more than one in so many values is asked for, a sequence is read once, in order.
MANY = 8
#: Steps of a decade in which log probabilities are kept.
STEPS = 4096

#: Whether Spark drops a query's shuffle files as soon as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_HASH = (1 << 63) - 1
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) & _HASH


#: The end token, and what precedes a text; the blank keeps them apart from all words.
END, START = b" end", word_hash(b" start")


def tokens(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    words.append(END)
    return words


def trains(doc_id: int | None) -> bool:
    text = "" if doc_id is None else str(doc_id)
    return zlib.crc32(text.encode()) % FOLDS != HELD_OUT


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = word_hash(word)
        return value


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def _planes(values: np.ndarray, dtype: str = "<u8") -> bytes:
    """Numbers by byte places, so that the leading zeros of many stand together."""
    return values.astype(dtype).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _numbers(blob: bytes, dtype: str = "<u8") -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1).astype(np.int64)


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th one (from 0) of each word, by bytes."""
    parts = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.uint8)
    byte = np.minimum((upto <= k[:, None]).sum(axis=1), 7)
    row = np.arange(len(words))
    bits = np.unpackbits(parts[row, byte][:, None], axis=1, bitorder="little")
    left = k - np.where(byte > 0, upto[row, byte - 1], 0)
    return byte * 8 + np.minimum((np.cumsum(bits, axis=1, dtype=np.uint8) <= left[:, None]).sum(axis=1), 7)


def remove_folder(folder: str) -> None:
    """Remove a folder of level files, if there is one."""
    files, path = pa.fs.FileSystem.from_uri(folder)
    if files.get_file_info(path).type == pa.fs.FileType.Directory:
        files.delete_dir(path)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of so many bits end to end, and a spare word."""
    out = np.zeros(len(values) * bits // 64 + 2, dtype="<u8")
    bit = np.arange(len(values), dtype=np.int64) * bits
    word, off = bit >> 6, (bit & 63).astype(np.uint64)
    values = values.astype(np.uint64)
    np.bitwise_or.at(out, word, values << off)
    over = (bit & 63) + bits > 64
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - off[over]))
    return out


def _unpack(packed: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(at), dtype=np.int64)
    bit = at * bits
    word, off = bit >> 6, (bit & 63).astype(np.uint64)
    first = packed[word] >> off
    second = np.where(off > 0, packed[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
    return ((first | second) & np.uint64((1 << bits) - 1)).astype(np.int64)


class EliasFano:
    """A rising sequence: low bits packed, high bits as a bit vector of ones per value
    and zeros per step, with a count of zeros for each word of it."""

    def __init__(self, low_bits: int, count: int, low: np.ndarray, high: np.ndarray):
        self.low_bits, self.count, self.low, self.high = low_bits, count, low, high
        bits = np.bitwise_count(high).astype(np.int64)
        self._zeros = np.append(0, np.cumsum(64 - bits))

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        at = np.arange(n, dtype=np.int64)
        ones = (values >> low_bits) + at
        length = int(universe >> low_bits) + n + 2
        vector = np.zeros(-(-length // 64) * 64, dtype=np.uint8)
        vector[ones] = 1
        high = np.packbits(vector, bitorder="little").view("<u8")
        return cls(low_bits, n, _pack(values & ((1 << low_bits) - 1), low_bits), high)

    @property
    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.low_bits, self.count], "<u8"), self.low, self.high]

    @classmethod
    def over(cls, arrays: list[np.ndarray]) -> EliasFano:
        """The sequence over arrays as ``arrays`` gives them, without a copy."""
        (low_bits, count), low, high = arrays
        return cls(int(low_bits), int(count), low, high)

    def _low(self, at: np.ndarray) -> np.ndarray:
        return _unpack(self.low, self.low_bits, at)

    def _after_zeros(self, k: np.ndarray) -> np.ndarray:
        """The place behind the k-th zero (k from 1), 0 for k = 0."""
        word = np.maximum(np.searchsorted(self._zeros, k, side="left") - 1, 0)
        at = np.maximum(k - self._zeros[word] - 1, 0)
        return np.where(k > 0, word * 64 + _select(~self.high[word], at) + 1, 0)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at these places."""
        if len(at) * MANY > self.count:
            return self.values()[at]
        ones = np.arange(len(self._zeros), dtype=np.int64) * 64 - self._zeros
        word = np.searchsorted(ones, at, side="right") - 1
        place = word * 64 + _select(self.high[word], at - ones[word])
        return ((place - at) << self.low_bits) | self._low(at)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        at = np.arange(self.count, dtype=np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        return ((ones - at) << self.low_bits) | self._low(at)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The index of each value, -1 where it is absent."""
        if len(values) * MANY > self.count:
            if not self.count:
                return np.full(len(values), -1, dtype=np.int64)
            own = self.values()
            at = np.minimum(np.searchsorted(own, values), self.count - 1)
            return np.where(own[at] == values, at, -1)
        out = np.full(len(values), -1, dtype=np.int64)
        # beyond the last step there is nothing
        steps = self._zeros[-1]
        inside = np.flatnonzero((values >= 0) & (values >> self.low_bits <= steps))
        if len(inside) < len(values):
            out[inside] = self.find(values[inside])
            return out
        for begin in range(0, len(values) if self.count else 0, 1 << 16):
            v = values[begin : begin + (1 << 16)]
            step = v >> self.low_bits
            low = v & ((1 << self.low_bits) - 1)
            at = self._after_zeros(step)
            index = at - step
            open_ = np.arange(len(v))
            while len(open_):
                inside = index[open_] < self.count
                open_ = open_[inside]
                place = at[open_]
                one = (self.high[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
                open_ = open_[one == 1]
                here = self._low(index[open_])
                hit = here == low[open_]
                out[begin + open_[hit]] = index[open_[hit]]
                open_ = open_[here < low[open_]]
                at[open_] += 1
                index[open_] += 1
        return out


class Level:
    """The nodes of two or three words of a shard: contexts, pointers to their successors,
    successors, the codes that occur, and which of them each successor has."""

    PARTS = 12

    def __init__(self, arrays: list[np.ndarray]):
        self.first = int(arrays[0][0])
        self.contexts, self.pointers, self.successors = (EliasFano.over(arrays[i : i + 3]) for i in (1, 4, 7))
        self.book, self.codes = arrays[10].astype(np.int64), arrays[11]

    @classmethod
    def arrays_of(cls, names: np.ndarray, codes: np.ndarray) -> list[np.ndarray]:
        """What a level of these rising names consists of."""
        context, successor = _parts(names)
        begin = np.flatnonzero(np.append(len(names) > 0, context[1:] != context[:-1])[: len(names)])
        contexts, ends = context[begin], np.append(begin[1:], len(names))
        # each context goes on from the last value of the one before
        last = successor[ends - 1] if len(begin) else begin
        base = np.cumsum(last) - last
        values = successor + np.repeat(base, ends - begin)
        first = int(contexts[0]) if len(contexts) else 0
        pointers = np.append(begin, len(names))
        book, which = np.unique(codes, return_inverse=True)
        rising = (contexts - first, pointers, values)
        sequences = [EliasFano.of(v, int(v[-1]) if len(v) else 0).arrays for v in rising]
        return [np.array([first], "<u8"), *(a for part in sequences for a in part), book, _pack(which, _width(book))]

    def find(self, names: np.ndarray) -> np.ndarray:
        """The code of each of the rising names, -1 where it is absent."""
        context, successor = _parts(names)
        new = np.append(len(names) > 0, context[1:] != context[:-1])[: len(names)]
        own, back = context[new], np.cumsum(new) - 1
        place = self.contexts.find(own - self.first)
        known = np.flatnonzero(place >= 0)
        begin, end, base = (np.zeros(len(own), dtype=np.int64) for _ in range(3))
        both = self.pointers.get(np.append(place[known], place[known] + 1))
        begin[known], end[known] = both[: len(known)], both[len(known) :]
        later = known[begin[known] > 0]
        base[later] = self.successors.get(begin[later] - 1)
        out = np.full(len(names), -1, dtype=np.int64)
        asked = np.flatnonzero(place[back] >= 0)
        of = back[asked]
        at = self.successors.find(base[of] + successor[asked])
        hit = (at >= begin[of]) & (at < end[of])
        out[asked[hit]] = self.book[_unpack(self.codes, _width(self.book), at[hit])]
        return out


def _width(book: np.ndarray) -> int:
    """Bits of a place in it."""
    return max(len(book) - 1, 0).bit_length()


def _parts(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The context of a name, and its successor there, from 1, without the length."""
    return names >> SUCCESSOR_BITS, ((names & ((1 << SUCCESSOR_BITS) - 1)) >> 2) + 1


def codes_of(counts: np.ndarray, n: int) -> np.ndarray:
    """Log probabilities in steps, two bytes each."""
    return np.clip(np.rint(-np.log10(counts / max(n, 1)) * STEPS), 0, 65534).astype(np.uint16)


def masses(codes: np.ndarray, n: int) -> np.ndarray:
    """How often codes say that their nodes occur, in whole numbers, 0 for -1."""
    return np.where(codes >= 0, np.rint(n * 10.0 ** (-codes / STEPS)), 0).astype(np.int64)


def levels_blob(words: np.ndarray, counts: np.ndarray, deeper: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """A shard's words, the running sum of their counts, and levels of names and codes, as
    one file."""
    before = np.append(0, np.cumsum(counts))
    arrays = EliasFano.of(words, int(words[-1]) if len(words) else 0).arrays + EliasFano.of(before, int(before[-1])).arrays
    for names, codes in deeper:
        arrays += Level.arrays_of(names, codes)
    sizes = np.array([len(arrays), *map(len, arrays)], "<u8")
    return b"".join(a.astype("<u8", copy=False).tobytes() for a in (sizes, *arrays))


def levels_over(whole: np.ndarray) -> tuple[EliasFano, np.ndarray, list[Level]]:
    """The words, their counts, and the levels of a file, without a copy."""
    number = int(whole[0])
    cuts = np.cumsum(np.append(number + 1, whole[1 : number + 1].astype(np.int64)))
    arrays = [whole[b:e] for b, e in zip(cuts[:-1], cuts[1:])]
    deeper = [Level(arrays[i : i + Level.PARTS]) for i in range(6, len(arrays), Level.PARTS)]
    return EliasFano.over(arrays[:3]), np.diff(EliasFano.over(arrays[3:6]).values()), deeper


def keep_file(folder: str, name: str, blob: bytes) -> np.ndarray:
    """Write a file of the shared folder in one step, so that a repeated task replaces it
    whole, and map it into memory. Where the folder is no mounted one, it is read."""
    files, path = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    part = f"{path}/{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(blob)
    files.move(part, f"{path}/{name}")
    if isinstance(files, pa.fs.LocalFileSystem):
        mapped = pa.memory_map(f"{path}/{name}")
        return np.frombuffer(mapped.read_buffer(), "<u8")
    with files.open_input_file(f"{path}/{name}") as file:
        return np.frombuffer(file.read_buffer(), "<u8")


def _packed(values: np.ndarray, universe: int) -> bytes:
    level = EliasFano.of(values, universe)
    return np.array([level.low_bits, level.count, len(level.low)], "<u8").tobytes() + level.low.tobytes() + level.high.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    whole = np.frombuffer(blob, dtype="<u8")
    low_bits, count, size = (int(x) for x in whole[:3])
    return EliasFano(low_bits, count, whole[3 : 3 + size], whole[3 + size :]).values()


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left.astype(np.uint64) * _MIX[0]) ^ right.astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    h = (h ^ (h >> np.uint64(29))) * _MIX[0]
    return (h ^ (h >> np.uint64(32))).view(np.int64) & _HASH


def _node(h: np.ndarray, order: int) -> np.ndarray:
    """The name of a node: a hash of 61 bits, and its length in words."""
    return (h & ~np.int64(3)) | order


def nodes(words: np.ndarray, hot: np.ndarray, splits: int) -> np.ndarray:
    """The nodes of each place: word, pair with the word before, triple with the two
    before (three rows). The first place has no pair, the first two have no triple; there
    the shorter node stands. The high bits of pairs and triples name their context; those
    of hot words are split by the word that follows."""
    one = _node(words, 1)
    two, three = one.copy(), one.copy()
    often = hot[np.searchsorted(hot, words).clip(max=len(hot) - 1)] == words if len(hot) else words < 0
    split = words % splits + 1
    low = np.int64((1 << SUCCESSOR_BITS) - 1)

    def below(context: np.ndarray, path: np.ndarray, splitting: np.ndarray, order: int) -> np.ndarray:
        high = _mixed(context, np.where(splitting, split[-len(context) :], 0))
        return _node((high & ~low) | (path & low), order)

    pairs = _mixed(words[:-1], words[1:])
    two[1:] = below(words[:-1], pairs, often[:-1], 2)
    three[:2] = two[:2]
    if len(words) > 2:
        triples = _mixed(pairs[:-1], words[2:])
        three[2:] = below(pairs[:-1], triples, often[:-2] & often[1:-1], 3)
    return np.stack([one, two, three])


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pieces laid end to end, the piece of each token and its place in it."""
    begin = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(sizes)), sizes)
    return piece, np.arange(sizes.sum()) - begin[piece]


def _asked(
    words: np.ndarray, sizes: np.ndarray, leads: np.ndarray, hot: np.ndarray, splits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of a chunk's tokens, whether a token is more than what leads its piece
    in, and its piece."""
    piece, place = _places(sizes)
    every = nodes(words, hot, splits)
    # nodes do not reach into the piece before
    every[1:, place == 0] = every[0, place == 0]
    every[2, place == 1] = every[1, place == 1]
    return every, place >= leads[piece], piece


def chunks(docs: DataFrame) -> DataFrame:
    """The tokens of all documents, in chunks: row, doc_id and size of each piece, how many
    tokens only lead it in, and the words. Each text begins with START."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, task = _Hashes(), TaskContext.get().partitionId()
        held: list[tuple[int, int | None, int, np.ndarray]] = []
        number = row = filled = 0

        def flush() -> pa.RecordBatch:
            words = np.concatenate([h for *_, h in held])
            found, code, times = np.unique(words, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            often = times * 2 * HOT > len(words)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) | number], pa.int64()),
                    pa.array([[r for r, *_ in held]], pa.list_(pa.int64())),
                    pa.array([[d for _, d, *_ in held]], pa.list_(pa.int64())),
                    pa.array([[n for _, _, n, _ in held]], pa.list_(pa.int32())),
                    pa.array([[len(h) for *_, h in held]], pa.list_(pa.int32())),
                    pa.array([found[order].astype("<i8").tobytes()], pa.binary()),
                    pa.array([zlib.compress(_planes(rank[code], "<u4"), 1)], pa.binary()),
                    pa.array([found[often].tolist()], pa.list_(pa.int64())),
                    pa.array([times[often].tolist()], pa.list_(pa.int64())),
                    pa.array([sum(len(h) - n for _, d, n, h in held if trains(d))], pa.int64()),
                ],
                names=["chunk", "rows", "ids", "leads", "sizes", "words", "codes", "often", "times", "learnt"],
            )

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = tokens(text)
                h = np.fromiter(map(hashes.__getitem__, own), dtype=np.int64, count=len(own))
                h = np.append(np.int64(START), h)
                row += 1
                for at in range(1, len(h), CHUNK):
                    lead = min(at, 2)
                    piece = h[at - lead : at + CHUNK]
                    held.append(((task << 40) | row, doc, lead, piece))
                    filled += len(piece)
                    if filled >= CHUNK:
                        yield flush()
                        held.clear()
                        number, filled = number + 1, 0
        if held:
            yield flush()

    schema = "chunk long, rows array<long>, ids array<long>, leads array<int>, sizes array<int>, words binary, codes binary"
    schema += ", often array<long>, times array<long>, learnt long"
    return written(_rows(docs).mapInArrow(cut, schema), "chunks")


def hot_words(cut: DataFrame) -> np.ndarray:
    """All words that are more than one in HOT tokens, and at most 2 * HOT in all: such a
    word is more than half as frequent over the chunks that tell of it."""
    total = cut.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    told = cut.select(F.explode(F.arrays_zip("often", "times")).alias("t")).groupBy("t.often")
    hot = told.agg(F.sum("t.times").alias("n")).where(F.col("n") * 2 * HOT > total)
    return np.array(sorted(r["often"] for r in hot.collect()), dtype=np.int64)


def _distinct(every: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct nodes of a round, the index of each, and which nodes it takes."""
    rows, half = ROUNDS[turn]
    mine = np.zeros(every.shape, dtype=bool)
    mine[list(rows)] = True if half is None else every[list(rows)] >> 62 == half
    keys, back = np.unique(every[mine], return_inverse=True)
    return keys, back, mine


def _words(words: bytes, codes: bytes) -> np.ndarray:
    return np.frombuffer(words, dtype="<i8")[_numbers(zlib.decompress(codes), "<u4")]


def node_answers(cut: DataFrame, shards: int, turn: int, hot: np.ndarray, n: int, folder: str) -> DataFrame:
    """For each chunk and shard what the shard's levels, kept as a file in the folder, say
    of the chunk's nodes, in their order: how often each occurs, of a word exactly, of
    others as their code has it, 0 where absent. For each shard also, as chunk -1, how many words and
    tokens it holds."""
    width = -(-(1 << 63) // shards)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("chunk", "ids", "leads", "sizes", "words", "codes"))
            for chunk, ids, leads, sizes, words, codes in zip(*columns):
                leads, sizes = np.array(leads), np.array(sizes)
                every, inside, piece = _asked(_words(words, codes), sizes, leads, hot, shards)
                keys, back, mine = _distinct(every, turn)
                if not len(keys):
                    continue
                learnt = np.array([trains(d) for d in ids])[piece]
                counted, place = inside & learnt, _places(sizes)[1]
                # a text's START counts once; where a triple is missing, nothing does
                first = (place == 0) & (leads == 1)[piece] & learnt
                here = np.stack([counted | first, counted, counted & (place > 1)])[mine]
                times = np.bincount(back[here], minlength=len(keys))
                at = keys // width
                cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                ends = np.append(cuts[1:], len(keys))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": np.full(len(cuts), chunk, dtype=np.int64),
                        "shard": at[cuts],
                        "keys": pa.array([_packed(keys[b:e] - at[b] * width, width) for b, e in zip(cuts, ends)], pa.binary()),
                        "times": pa.array(
                            [zlib.compress(_planes(times[b:e], "<u4"), 1) for b, e in zip(cuts, ends)], pa.binary()
                        ),
                    }
                )

    def answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, keys, times, shard = [], [], [], 0
        for batch in rows:
            shard = batch["shard"][0].as_py()
            for chunk, k, t in zip(*(batch[c].to_pylist() for c in ("chunk", "keys", "times"))):
                who.append(chunk)
                keys.append(_unpacked(k))
                times.append(_numbers(zlib.decompress(t), "<u4"))
        wanted, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, np.concatenate(times), len(wanted)).astype(np.int64)
        names, seen = wanted + shard * width, total > 0
        order = names & 3
        own = [np.flatnonzero(order == k) for k in range(4)]
        kept = [at[seen[at]] for at in own]
        blob = levels_blob(
            wanted[kept[1]], total[kept[1]], [(names[kept[k]], codes_of(total[kept[k]], n)) for k in (2, 3)]
        )
        words, counts, deeper = levels_over(keep_file(folder, f"round{turn}-{shard:08d}", blob))
        # an absent word has the last place, and no count
        found = np.zeros(len(names), dtype=np.int64)
        found[own[1]] = np.append(counts, 0)[words.find(wanted[own[1]])]
        for k, stored in zip((2, 3), deeper):
            found[own[k]] = masses(stored.find(names[own[k]]), n)
        word = (order == 1) & (found > 0) & (names != _node(np.int64(START), 1))
        cuts = np.cumsum([0, *(len(k) for k in keys)])
        blobs = [zlib.compress(_planes(found[back[b:e]]), 1) for b, e in zip(cuts[:-1], cuts[1:])]
        for at in range(0, len(who), 512):
            some = slice(at, at + 512)
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(who[some], pa.int64()),
                    "shard": pa.array([shard] * len(who[some]), pa.int64()),
                    "counts": pa.array(blobs[some], pa.binary()),
                    "n": pa.array([None] * len(who[some]), pa.int64()),
                    "v": pa.array([None] * len(who[some]), pa.int64()),
                }
            )
        # words are counted in the first round; in others their nodes stand without counts
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([-1], pa.int64()),
                "shard": pa.array([shard], pa.int64()),
                "counts": pa.array([None], pa.binary()),
                "n": pa.array([int(found[word].sum())], pa.int64()),
                "v": pa.array([int(word.sum())], pa.int64()),
            }
        )

    asked = cut.mapInArrow(ask, "chunk long, shard long, keys binary, times binary")
    answers = asked.groupBy("shard").applyInArrow(answer, "chunk long, shard long, counts binary, n long, v long")
    # the shuffle holds most of the disk that the query takes, and nothing reads it again
    conf = cut.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return written(answers, "counts")
    finally:
        conf.set(CLEANUP, before)


def probabilities(counts: np.ndarray, before: np.ndarray, pairs: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each place the probability of its word alone and in its context. counts: of word,
    pair and triple; before: of the word before; pairs: of the pair before, -1 without.
    Those of pairs and triples are what their codes stand for."""
    one = (counts[0] + 1) / (n + v + 1)
    two = (counts[1] + PRIOR * one) / (before + PRIOR)
    three = (counts[2] + PRIOR * two) / (np.maximum(pairs, 0) + PRIOR)
    return one, np.where(pairs < 0, two, three)


def score(docs: DataFrame, keep: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. The levels
    stay in the folder ``keep``; without one, those of a round are removed when all that is
    asked of them is answered and written."""
    size = docs.select(F.sum(F.octet_length(text_of()))).first()[0] or 0
    cut = chunks(docs)
    shards = max(SHARDS, -(-size // SHARD_BYTES))
    hot, learnt = hot_words(cut), cut.select(F.sum("learnt")).first()[0] or 0
    answers = []
    for turn in range(len(ROUNDS)):
        folder = keep or shared_folder(docs.sparkSession, "trie")
        answers.append(node_answers(cut, shards, turn, hot, learnt, folder))
        if not keep:
            remove_folder(folder)
    sums = answers[0].where("chunk = -1").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, own = [{} for _ in ROUNDS], None
        for batch in rows:
            columns = ("turn", "shard", "counts", "rows", "ids", "leads", "sizes", "words", "codes")
            for turn, shard, blob, *texts in zip(*(batch[c].to_pylist() for c in columns)):
                if turn is None:
                    own = texts
                else:
                    parts[turn][shard] = _numbers(zlib.decompress(blob))
        of, ids, leads, sizes, words, codes = own
        every, inside, piece = _asked(_words(words, codes), np.array(sizes), np.array(leads), hot, shards)
        counts = np.empty(every.shape, dtype=np.int64)
        for turn, found in enumerate(parts):
            _, back, mine = _distinct(every, turn)
            # shards are ranges, so their answers follow each other as the nodes do
            said = np.concatenate([found[s] for s in sorted(found)]) if found else back
            counts[mine] = said[back]
        at = np.flatnonzero(inside)
        place = _places(np.array(sizes))[1][at]
        here, before = counts[:, at], counts[0][at - 1]
        one, whole = probabilities(here, before, np.where(place > 1, counts[1][at - 1], -1), n, v)

        def summed(x: np.ndarray) -> np.ndarray:
            return np.bincount(piece[at], x, len(ids))

        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array(of, pa.int64()),
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array([not trains(d) for d in ids], pa.bool_()),
                "n_tokens": summed(np.ones(len(at))).astype(np.int64),
                "n_known": summed(here[0] > 0).astype(np.int64),
                "base": summed(np.log10(one)),
                "model": summed(np.log10(whole)),
            }
        )

    together = cut.drop("often", "times", "learnt")
    for turn, found in enumerate(answers):
        replies = found.where("chunk >= 0").select("chunk", F.lit(turn).alias("turn"), "shard", "counts")
        together = together.unionByName(replies, allowMissingColumns=True)
    out = together.groupBy("chunk").applyInArrow(
        scored, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"
    )
    # one row for each piece of a document
    return out.groupBy("row", "doc_id", "held_out").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("model").alias("score"),
    ).drop("row")
