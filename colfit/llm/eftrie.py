"""An n-gram language model in an Elias-Fano trie, and the scores it gives.

Level one is the vocabulary: the sorted 64-bit hashes of the training words with their
counts; a word's id is its place.  Level two holds the bigrams in order of (word, next
word) as a monotone sequence, with monotone pointers from each word to its first bigram.
Level three holds the trigrams under their first bigram's place; the last word is not an
id but its rank among the words that follow the middle word, so it takes few bits, and a
lookup first finds (middle, last) on level two and then searches that rank.  Pointers
and levels are partitioned Elias-Fano sequences.

Probabilities are interpolated by absolute discounting, the unigrams by adding 0.1 to
every count, and stored, like the back-off weights, as a one-byte logarithm.  All n-grams
of the training texts are stored, those that occur once too.

The levels are files of the shared checkpoint folder, in shards, which every worker
memory-maps; nothing of the model passes the driver or is broadcast.  Level two is dealt
by first word; level three by ranges of bigrams that occur a bounded number of times
together, so a frequent first word is spread over several.  The task that merges a shard's
n-grams writes it; files are named by shard and written anew if a task is run again.  The
hashes are 64 bits wide: two of a billion words share one in about three of a hundred
corpora, and would then be counted as one word.

Texts are looked up some megabytes at a time: their distinct words, then the distinct pairs
of those, then the distinct pairs of pairs, each once and in the order of the stored levels.

Results by case: a null or empty text is its end token alone; a word that no training
text has gets the probability left for unknown words, together with all others; rows
that repeat an id are texts of their own; without any training text every word is
unknown; an empty table gives no rows; a text of any length is scored whole, its tokens
being one array; only ``doc_id`` and ``text`` are read, whatever other columns are called.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.llm.common import cut, map_batches, remainder_of
from colfit.llm.monotone import MonotoneSequence
from colfit.llm.words import hashes, slices, split
from colfit.session import shared_folder

FOLDS = 10
ADDED = 0.1
DISCOUNT = 0.75
#: Training tokens to a shard of the trie, and distinct words to one of the vocabulary.
SHARD_TOKENS = 3_000_000
SHARD_WORDS = 4_000_000
#: Tokens whose n-grams a task merges before it passes them on.
MERGED_TOKENS = 3_000_000
#: Bytes of text, and tokens, looked up at once, or one text if it is longer.
BYTES_AT_ONCE = 4_000_000
TOKENS_AT_ONCE = 1 << 20
#: One byte stores a base-10 logarithm from 0 down to this.
LOWEST_LOG = -10.0
#: Bytes below which an array is read, not mapped; a process may map only so many files.
LEAST_MAPPED = 1 << 16
#: Stands for the end of a text among the hashes of words.
END = np.uint64(0xD1B54A32D192ED03)


class Sizes(NamedTuple):
    """What every worker must know of a model."""

    folder: str
    words: tuple[int, ...]  # in each shard of the vocabulary
    tokens: int
    texts: int
    shards: int
    bigrams: tuple[int, ...] = ()  # in each shard of level two
    ranges: tuple[int, ...] = ()  # first bigram of each shard of level three


def _code(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(log10 / LOWEST_LOG * 255), 0, 255).astype(np.uint8)


_VALUES = np.arange(256) * (LOWEST_LOG / 255)


def _value(code: np.ndarray) -> np.ndarray:
    return _VALUES[code]


def _runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each key of a sorted array and where it stands."""
    if len(sorted_keys):
        edges = [0, *(np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1).tolist(), len(sorted_keys)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(sorted_keys[a]), slice(a, b)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' lower-cased words and ends, and each text's number of them."""
    words = split(texts, lower=True)
    ended = np.insert(hashes(words), words.before[1:], END)
    return ended, np.diff(words.before) + 1


class Files:
    """Arrays in the shared folder; those of a remote one are mapped from a copy."""

    def __init__(self, folder: str):
        self.fs, self.path = pa.fs.FileSystem.from_uri(folder if ":" in folder else os.path.abspath(folder))

    def save(self, name: str, **arrays: np.ndarray) -> None:
        for key, array in arrays.items():
            final = f"{self.path}/{name}.{key}.npy"
            draft = f"{final}.{uuid.uuid4().hex}"
            with self.fs.open_output_stream(draft) as out:
                out.write(_npy(array))
            self.fs.move(draft, final)

    def load(self, name: str, key: str) -> np.ndarray:
        path = f"{self.path}/{name}.{key}.npy"
        if not isinstance(self.fs, pa.fs.LocalFileSystem):
            with self.fs.open_input_stream(path) as source, tempfile.NamedTemporaryFile(suffix=".npy") as out:
                while part := source.read(1 << 24):
                    out.write(part)
                out.flush()
                return np.load(out.name, mmap_mode="r").view(np.ndarray)  # stays mapped when its name goes
        return np.load(path, mmap_mode="r" if os.path.getsize(path) >= LEAST_MAPPED else None).view(np.ndarray)

    def save_sequence(self, name: str, values: np.ndarray) -> None:
        built = MonotoneSequence.build(values)
        arrays = {k: getattr(built, k) for k in MonotoneSequence.NAMES}
        self.save(name, length=np.array([built.length]), **arrays)

    def load_sequence(self, name: str) -> MonotoneSequence:
        length = int(self.load(name, "length")[0])
        return MonotoneSequence(length, *(self.load(name, k) for k in MonotoneSequence.NAMES))


def _npy(array: np.ndarray) -> bytes:
    out = pa.BufferOutputStream()
    np.lib.format.write_array(_Sink(out), np.ascontiguousarray(array))
    return out.getvalue()


class _Sink:
    def __init__(self, out: pa.BufferOutputStream):
        self.write = out.write


class Vocabulary:
    """Ids and counts of words, by the sorted hashes."""

    def __init__(self, sizes: Sizes):
        files = Files(sizes.folder)
        self.hashes = [files.load(f"words-{i}", "hash") for i in range(len(sizes.words))]
        self.counts = [files.load(f"words-{i}", "count") for i in range(len(sizes.words))]
        self.starts = np.concatenate(([0], np.cumsum(sizes.words))).astype(np.int64)
        self.size = int(self.starts[-1])
        self.unknown = self.size + 1
        self.begin = self.size

    def ids(self, distinct: np.ndarray) -> np.ndarray:
        """Ids of distinct hashes."""
        shard = _shard_of_hash(distinct, len(self.hashes))
        ids = np.full(len(distinct), self.unknown, np.int64)
        for k in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == k)
            table = self.hashes[k]
            if not len(table):
                continue
            order = mine[np.argsort(distinct[mine])]  # neighbours are found together
            at = np.minimum(np.searchsorted(table, distinct[order]), len(table) - 1)
            hit = table[at] == distinct[order]
            ids[order[hit]] = self.starts[k] + at[hit]
        return ids

    def count(self, ids: np.ndarray) -> np.ndarray:
        """Training occurrences; none for an unknown word."""
        out = np.zeros(len(ids), np.int64)
        for k, counts in enumerate(self.counts):
            mine = (ids >= self.starts[k]) & (ids < self.starts[k + 1])
            out[mine] = counts[ids[mine] - self.starts[k]]
        return out


def _shard_of_hash(hashes: np.ndarray, shards: int) -> np.ndarray:
    bits = (shards - 1).bit_length()
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """``hash, count`` of all tokens, as signed numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, counts = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["hash", "count"])

        for batch in batches:
            for part in slices(batch.column("text")):
                codes, distinct = pd.factorize(tokens(part)[0])
                held.append((distinct, np.bincount(codes, minlength=len(distinct))))
                if sum(len(h[0]) for h in held) > MERGED_TOKENS:
                    yield flush()
        if held:
            yield flush()

    counted = map_batches(texts.select("text"), count, "hash bigint, count bigint")
    return counted.groupBy("hash").agg(F.sum("count").alias("count"))


def _by_shard(rows: DataFrame, shards: int, keys: list[str], write, schema: str) -> DataFrame:
    """Run ``write(shard, table)`` once for each ``shard`` on all its rows, sorted by keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and held[0].column("shard")[0].as_py() != shard[a]:
                    yield write(held[0].column("shard")[0].as_py(), pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield write(held[0].column("shard")[0].as_py(), pa.Table.from_batches(held))

    sorted_rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", *keys)
    return map_batches(sorted_rows, run, schema)


def _shard_counts(rows: DataFrame, shards: int) -> list[int]:
    found = dict(tuple(r) for r in rows.collect())
    return [found.get(k, 0) for k in range(shards)]


def _done(shard: int, count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([count], pa.int64())], ["shard", "count"])


DONE = "shard int, count bigint"


def _pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys by their differences, byte by byte, and counts, both compressed."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return tuple(
        bytes(pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True))
        for x in (planes, counts.astype(np.uint32))
    )


def _unpack(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(keys, n * 8, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    diffs = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return np.cumsum(diffs, dtype=np.uint64), np.frombuffer(pa.decompress(counts, n * 4, codec="zstd", asbytes=True), np.uint32)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, int)
    return keys[starts], np.add.reduceat(counts, starts, dtype=np.int64) if len(starts) else counts


def _write_grams(texts: DataFrame, sizes: Sizes, shards: int, keys_of, write, schema: str) -> DataFrame:
    """Count n-grams and hand each shard's sorted keys and counts to ``write``, once.

    ``keys_of(model, ids)`` gives a key for each n-gram and ``shard_of`` below its shard and
    place there.  A task merges its own n-grams and sends the sorted keys, packed, to their
    shard, where they are merged again and written.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = trie(sizes)

        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            part, keys = keys_of(model, keys)
            by_part = np.argsort(part, kind="stable")  # keys stay sorted within a part
            part, keys, counts = part[by_part], keys[by_part], counts[by_part]
            edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
            rows = [
                (int(part[a]), int(b - a), *_pack(keys[a:b], counts[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True)
            ]
            columns = zip(*rows, strict=True)
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "n", "keys", "counts"]
            )

        held, n = [], 0
        for part in token_ids(batches, model.vocabulary):
            keys = model.trigram_keys(part) if sizes.bigrams else model.bigram_keys(part)
            if len(keys):
                held.append(keys)
                n += len(keys)
            if n > MERGED_TOKENS:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None

        def flush() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            held.clear()
            keys, counts = _summed(keys, counts)  # those before are let go
            return write(last, keys, counts.astype(np.int64, copy=False))

        for batch in batches:
            for part, n, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None and part != last:
                    yield flush()
                last = part
                held.append(_unpack(n, *packed))
        if held:
            yield flush()

    packed = map_batches(texts.select("text"), split, "part int, n bigint, keys binary, counts binary")
    dealt = packed.repartition(shards, "part").sortWithinPartitions("part")
    return map_batches(dealt, merge, schema)


class Part(NamedTuple):
    """Some whole texts end to end."""

    words: np.ndarray  # distinct ids in order, the mark of the beginning among them
    codes: np.ndarray  # each token's place among those
    lengths: np.ndarray  # each text's number of tokens


def token_ids(batches: Iterator[pa.RecordBatch], known: Vocabulary) -> Iterator[Part]:
    """Texts in parts of bounded size; a text longer than a part is a part of its own."""
    for batch in batches:
        for part in slices(batch.column("text"), BYTES_AT_ONCE):
            found, lengths = tokens(part)
            codes, distinct = pd.factorize(found)
            words, place = np.unique(np.append(known.ids(distinct), known.begin), return_inverse=True)
            codes = place[codes]
            ends = np.cumsum(lengths)
            at = 0
            while at < len(lengths):
                base = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, base + TOKENS_AT_ONCE, "right")))
                yield Part(words, codes[base : ends[to - 1]], lengths[at:to])
                at = to


class Pairs(NamedTuple):
    """The distinct pairs of a word, or the beginning, and the next of some texts.

    They are in the order of the stored bigrams: by shard, first word and second word.
    """

    of: np.ndarray  # each token's pair, of which it is the second word
    first: np.ndarray  # places among the part's words
    second: np.ndarray
    place: np.ndarray  # of the bigram over all shards, -1 if it is not stored
    rank: np.ndarray  # among the bigrams of the first word, or -1
    context: np.ndarray  # whether it is stored and a token may follow


class Trie:
    """The levels of a model as far as they are written."""

    def __init__(self, sizes: Sizes):
        self.sizes = sizes
        self.vocabulary = vocabulary(sizes)
        self.v = np.int64(self.vocabulary.size)
        self.end = int(self.vocabulary.ids(np.array([END]))[0])
        files = self.files = Files(sizes.folder)
        shards = range(len(sizes.bigrams))
        self.bigrams = [files.load_sequence(f"bigrams-{k}") for k in shards]
        self.pointers = [files.load_sequence(f"pointers-{k}") for k in shards]
        self.starts = np.concatenate(([0], np.cumsum(sizes.bigrams))).astype(np.int64)

    def load_scores(self) -> None:
        shards = range(len(self.sizes.bigrams))
        self.word_backoff = [self.files.load(f"codes-{k}", "backoff") for k in shards]
        self.bigram_log = [self.files.load(f"codes-{k}", "log") for k in shards]
        shards = range(len(self.sizes.ranges))
        self.trigrams = [self.files.load_sequence(f"trigrams-{k}") for k in shards]
        self.bases = [self.files.load_sequence(f"bases-{k}") for k in shards]
        self.bigram_backoff = [self.files.load(f"context-{k}", "backoff") for k in shards]
        self.trigram_log = [self.files.load(f"context-{k}", "log") for k in shards]

    def _parts(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each shard and where it stands; small numbers are sorted in linear time."""
        small = shard.astype(np.uint16) if len(self.sizes.ranges) + self.sizes.shards < 1 << 16 else shard
        order = np.argsort(small, kind="stable")
        for k, run in _runs(shard[order]):
            yield k, order[run]

    def before(self, part: Part) -> np.ndarray:
        """Place of the word before each token; at the start of a text the mark of the beginning."""
        begin, end = np.searchsorted(part.words, [self.vocabulary.begin, self.end])
        previous = np.empty_like(part.codes)
        previous[1:] = np.where(part.codes[:-1] == end, begin, part.codes[:-1])
        previous[:1] = begin
        return previous

    def bigram_keys(self, part: Part) -> np.ndarray:
        """Of every token of training texts: id before times words plus its own."""
        return ((part.words * self.v)[self.before(part)] + part.words[part.codes]).astype(np.uint64)

    def pairs(self, part: Part) -> Pairs:
        """Each distinct pair is looked up once, in order, so that neighbours are found together."""
        words, n, shards = part.words, len(part.words), self.sizes.shards
        ordered = np.lexsort((words, words % shards))
        turn = np.empty_like(ordered)
        turn[ordered] = np.arange(n)
        keys, of = np.unique(turn[self.before(part)] * n + part.codes, return_inverse=True)
        first, second = ordered[keys // n], keys % n
        place, rank = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
        known = np.flatnonzero((words[first] <= self.v) & (words[second] < self.v))
        a = words[first[known]]
        local = a // shards * self.v + words[second[known]]
        for k, run in _runs(a % shards):
            found = self.bigrams[k].find(local[run])
            place[known[run]] = np.where(found >= 0, found + self.starts[k], -1)
        stored = np.flatnonzero(place >= 0)
        a = words[first[stored]]
        heads = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else stored
        starts = np.repeat(self.first_bigram(a[heads]), np.diff(np.append(heads, len(a))))
        rank[stored] = place[stored] - starts
        return Pairs(of, first, second, place, rank, (place >= 0) & (words[second] != self.end))

    def first_bigram(self, a: np.ndarray) -> np.ndarray:
        """Place of the first bigram of each word."""
        out = np.empty(len(a), np.int64)
        for k, mine in self._parts(a % self.sizes.shards):
            out[mine] = self.starts[k] + self.pointers[k].access(a[mine] // self.sizes.shards)
        return out

    def followers(self, a: np.ndarray) -> np.ndarray:
        """Number of bigrams of each word."""
        out = np.empty(len(a), np.int64)
        for k, mine in self._parts(a % self.sizes.shards):
            local = a[mine] // self.sizes.shards
            out[mine] = self.pointers[k].access(local + 1) - self.pointers[k].access(local)
        return out

    def bigram_shards(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each bigram key, and its value there."""
        first, second = keys // np.uint64(self.v), keys % np.uint64(self.v)
        shards = np.uint64(self.sizes.shards)
        return (first % shards).astype(np.int64), first // shards * np.uint64(self.v) + second

    def trigram_shards(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each trigram key, and the key with the bigram's place counted there."""
        ranges = np.array(self.sizes.ranges, np.int64)
        shard = np.searchsorted(ranges, (keys // np.uint64(self.v + 1)).astype(np.int64), "right") - 1
        return shard, keys - ranges[shard].astype(np.uint64) * np.uint64(self.v + 1)

    def trigram_keys(self, part: Part) -> np.ndarray:
        """Of every token whose two bigrams are stored: place of the first, rank in the second."""
        pairs = self.pairs(part)
        both = np.flatnonzero(pairs.context[pairs.of[:-1]] & (pairs.place >= 0)[pairs.of[1:]]) + 1
        upper = pairs.place.astype(np.uint64) * np.uint64(self.v + 1)
        return upper[pairs.of[both - 1]] + pairs.rank[pairs.of[both]].astype(np.uint64)

    def unigram_log(self, count: np.ndarray) -> np.ndarray:
        total = self.sizes.tokens + ADDED * (self.vocabulary.size + 1)
        return np.log10((count + ADDED) / total)

    def _bigram_codes(self, values: np.ndarray, arrays: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        """What the values are for the codes of these bigrams."""
        shard = np.searchsorted(self.starts, place, "right") - 1
        out = np.empty(len(place), np.uint8)
        for k, mine in self._parts(shard):
            out[mine] = arrays[k][place[mine] - self.starts[k]]
        return values[out]

    def logs(self, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Base-10 logarithm of each token's probability, that of the base, and its count."""
        words, codes = part.words, part.codes
        word_count = self.vocabulary.count(words)
        word_log = self.unigram_log(word_count)
        base, count = word_log[codes], word_count[codes]
        if not len(self.bigrams) or not len(codes):
            return base, base, count
        pairs = self.pairs(part)
        # Bigram, or the word's back-off before the unigram.
        backoff = np.zeros(len(words))
        known = np.flatnonzero(words <= self.v)
        for k, mine in self._parts(words[known] % self.sizes.shards):
            at = known[mine]
            backoff[at] = _value(self.word_backoff[k][words[at] // self.sizes.shards])
        lower = word_log[pairs.second] + backoff[pairs.first]
        stored = np.flatnonzero(pairs.place >= 0)
        lower[stored] = self._bigram_codes(_VALUES, self.bigram_log, pairs.place[stored])
        # Trigram, or the bigram's back-off before that.
        ranges = np.array(self.sizes.ranges, np.int64)
        shard = np.searchsorted(ranges, pairs.place, "right") - 1
        context = np.zeros(len(pairs.place))
        at = np.flatnonzero(pairs.context)
        for k, run in _runs(shard[at]):
            context[at[run]] = _value(self.bigram_backoff[k][pairs.place[at[run]] - ranges[k]])
        out = lower[pairs.of]
        out[1:] += context[pairs.of[:-1]]
        both = np.flatnonzero(pairs.context[pairs.of[:-1]] & (pairs.place >= 0)[pairs.of[1:]]) + 1
        n = len(pairs.place)
        keys, inverse = np.unique(pairs.of[both - 1] * n + pairs.of[both], return_inverse=True)
        first, rank = keys // n, pairs.rank[keys % n]
        logs = np.full(len(keys), np.nan)
        for k, run in _runs(shard[first]):
            parents = first[run]
            heads = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
            bases = self.bases[k].access(pairs.place[parents[heads]] - ranges[k])
            found = self.trigrams[k].find(np.repeat(bases, np.diff(np.append(heads, len(parents)))) + rank[run])
            hit = np.flatnonzero(found >= 0)
            logs[run.start + hit] = _value(self.trigram_log[k][found[hit]])
        logs = logs[inverse]
        hit = np.flatnonzero(~np.isnan(logs))
        out[both[hit]] = logs[hit]
        return out, base, count


_vocabularies: dict[str, tuple[str, Vocabulary]] = {}


def vocabulary(sizes: Sizes) -> Vocabulary:
    held = _vocabularies.get("last")
    if held is None or held[0] != sizes.folder:
        held = _vocabularies["last"] = (sizes.folder, Vocabulary(sizes))
    return held[1]


_tries: dict[str, tuple[Sizes, Trie]] = {}


def trie(sizes: Sizes, scores: bool = False) -> Trie:
    """The mapped model, one per worker; an older one is let go."""
    held = _tries.get("trie")
    if held is None or held[0] != sizes:
        held = _tries["trie"] = (sizes, Trie(sizes))
    if scores and not hasattr(held[1], "trigrams"):
        held[1].load_scores()
    return held[1]


def new_folder(spark: SparkSession) -> str:
    """A name in the shared folder that no other model has."""
    return f"{shared_folder(spark).rstrip('/')}/ngrams-{uuid.uuid4().hex}"


def learn(texts: DataFrame, folder: str) -> Sizes:
    """Count, smooth and write the model of all texts to a folder that all executors see."""
    files = Files(folder)
    files.fs.create_dir(files.path, recursive=True)
    n_texts = texts.count()

    # Level one.
    words = cut(word_counts(texts))
    distinct, total = words.agg(F.count("*"), F.sum("count")).first()
    parts = 1
    while parts * SHARD_WORDS < distinct:
        parts *= 2
    bits = (parts - 1).bit_length()
    shard = F.shiftrightunsigned("hash", 64 - bits).cast("int") if bits else F.lit(0)
    unsigned = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))  # sorts as the unsigned number

    def write_words(k: int, table: pa.Table) -> pa.RecordBatch:
        hashes = table.column("hash").to_numpy().view(np.uint64)
        Files(folder).save(f"words-{k}", hash=hashes, count=table.column("count").to_numpy())
        return _done(k, len(hashes))

    written = _by_shard(words.withColumn("shard", shard).withColumn("sorted", unsigned), parts, ["sorted"], write_words, DONE)
    counts = _shard_counts(written, parts)
    for k in (k for k, n in enumerate(counts) if not n):
        files.save(f"words-{k}", hash=np.empty(0, np.uint64), count=np.empty(0, np.int64))
    shards = max(1, -(-(total or 0) // SHARD_TOKENS))
    sizes = Sizes(folder, tuple(counts), total or 0, n_texts, shards)
    v = sum(counts)
    if not v:
        return sizes

    if (v + 1) ** 2 >= 1 << 63:
        raise OverflowError(f"{v} words are too many for keys of 63 bits")

    # Level two: shard k has the words whose id leaves k when divided by the shards.
    def write_pairs(k: int, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = write_level_two(sizes, k, values.view(np.int64), counts)
        return pa.RecordBatch.from_arrays(
            [*_done(k, len(values)).columns, pa.array([cuts], pa.list_(pa.int64()))], ["shard", "count", "cuts"]
        )

    written = _write_grams(texts, sizes, shards, Trie.bigram_shards, write_pairs, f"{DONE}, cuts array<bigint>").collect()
    pairs = {r["shard"]: r for r in written}  # a row per shard
    for k in range(shards):
        if k not in pairs:
            write_level_two(sizes, k, np.empty(0, np.int64), np.empty(0, np.int64))
    counts = [pairs[k]["count"] if k in pairs else 0 for k in range(shards)]
    starts = np.concatenate(([0], np.cumsum(counts))).tolist()
    ranges = [starts[k] + at for k in range(shards) if k in pairs for at in pairs[k]["cuts"]]
    sizes = sizes._replace(bigrams=tuple(counts), ranges=tuple(ranges))
    if (starts[-1] + 1) * (v + 1) >= 1 << 63:
        raise OverflowError(f"{starts[-1]} bigrams of {v} words are too many for keys of 63 bits")

    # Level three: shard k has the trigrams under the bigrams of range k.
    def write_triples(k: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        write_level_three(sizes, k, keys.view(np.int64), counts)
        return _done(k, len(keys))

    triples = _write_grams(texts, sizes, len(ranges), Trie.trigram_shards, write_triples, DONE)
    for k in (k for k, n in enumerate(_shard_counts(triples, len(ranges))) if not n):
        write_level_three(sizes, k, np.empty(0, np.int64), np.empty(0, np.int64))
    return sizes


def write_level_two(sizes: Sizes, k: int, values: np.ndarray, counts: np.ndarray) -> list[int]:
    """Write a shard; returns where ranges of its bigrams begin for level three.

    A range's bigrams occur ``SHARD_TOKENS`` times together, but for its last, or it is one.
    """
    model = trie(sizes)
    v, words = model.v, model.vocabulary
    parents = np.arange(k, v + 1, sizes.shards)  # all words and the mark of the beginning
    local, last = values // v, values % v
    first = np.searchsorted(local, np.arange(len(parents) + 1))
    occurrences = words.count(parents)
    occurrences[parents == v] = sizes.texts
    kept = np.bincount(local, counts - DISCOUNT, len(parents))
    left = 1 - np.divide(kept, occurrences, out=np.zeros(len(parents)), where=occurrences > 0)
    unigram = 10 ** model.unigram_log(words.count(last))
    probability = (counts - DISCOUNT) / np.maximum(occurrences, 1)[local] + left[local] * unigram
    files = model.files
    files.save_sequence(f"bigrams-{k}", values)
    files.save_sequence(f"pointers-{k}", first)
    files.save(f"codes-{k}", log=_code(np.log10(probability)), backoff=_code(np.log10(np.maximum(left, 1e-12))))
    files.save(f"counts-{k}", count=counts)
    turn = (np.cumsum(counts) - counts) // SHARD_TOKENS
    return np.flatnonzero(np.concatenate(([True], turn[1:] != turn[:-1]))).tolist() if len(counts) else []


def write_level_three(sizes: Sizes, k: int, keys: np.ndarray, counts: np.ndarray) -> None:
    model = trie(sizes)
    place, rank = keys // (model.v + 1), keys % (model.v + 1)
    shard = int(np.searchsorted(model.starts, sizes.ranges[k], "right")) - 1
    end = min([model.starts[shard + 1], *sizes.ranges[k + 1 : k + 2]])
    own = slice(sizes.ranges[k] - int(model.starts[shard]), int(end - model.starts[shard]))
    middle = model.bigrams[shard].decode(own.start, own.stop) % model.v  # the last word of each bigram
    follow = np.zeros(len(middle), np.int64)
    inner = middle != model.end  # nothing follows the end
    words, code = np.unique(middle[inner], return_inverse=True)
    follow[inner] = model.followers(words)[code]
    bases = np.concatenate(([0], np.cumsum(follow)))
    contexts = model.files.load(f"counts-{shard}", "count")[own]
    kept = np.bincount(place, counts - DISCOUNT, len(middle))
    left = 1 - kept / contexts if len(middle) else kept
    starts = np.zeros(len(middle), np.int64)
    starts[inner] = model.first_bigram(words)[code]
    logs = [model.files.load(f"codes-{s}", "log") for s in range(sizes.shards)]
    lower = model._bigram_codes(10**_VALUES, logs, starts[place] + rank)
    probability = (counts - DISCOUNT) / contexts[place] + left[place] * lower
    files = model.files
    files.save_sequence(f"trigrams-{k}", bases[place] + rank)
    files.save_sequence(f"bases-{k}", bases)
    files.save(f"context-{k}", backoff=_code(np.log10(np.maximum(left, 1e-12))), log=_code(np.log10(probability)))


def score(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = trie(sizes, True)
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for part in token_ids([batch], model.vocabulary):
                starts = np.concatenate(([0], np.cumsum(part.lengths)[:-1]))
                logs, base, count = model.logs(part)
                values = (
                    part.lengths,
                    np.add.reduceat((count > 0).astype(np.int64), starts),
                    np.add.reduceat(base, starts),
                    np.add.reduceat(logs, starts),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(np.concatenate(c)) for c in columns)],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def held_out(doc_id: Column) -> Column:
    return remainder_of(doc_id, FOLDS) == 0


def learn_and_score(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, score all, delete the model's files."""
    folder = new_folder(docs.sparkSession)
    try:
        sizes = learn(docs.where(~held_out(F.col("doc_id"))), folder)
        scored = cut(score(docs, sizes))
    finally:
        files = Files(folder)
        files.fs.delete_dir(files.path)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(sizes.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
