"""Packing token sequences by lexical retrieval.

A document's ids end with the id 1.  Every whole window of it is a sequence of its own;
what remains, shorter than a window, is packed with the remainders of documents like it.
How many remainders of the whole corpus have a term, and their mean length, are counted
first; BM25 weighs by these.  Remainders are sorted by their rarest terms that another one
has too, so that those which share what tells most lie together, wherever they came from,
and equal keys, however many, spread over consecutive shards.  A shard holds a bounded
number of remainders and a BM25 index of all their ids.  Each window starts with a seed;
the index returns the unused neighbours of the seed, best first, and they fill the window.
The last one is cut where the window ends and its rest is the next seed, so only the last
window of a task is padded.  A neighbour that shares none of a seed's rarest terms may be
in another shard, where the seed does not find it.

Results by case: a null text counts as empty; an empty text is the one id 1; a text of
any length is cut into windows, so no row grows with it but by its windows' checksums;
rows that repeat an id are packed each on its own; of equal scores the first in the order
of the sort is nearer, of equal keys the smaller id comes first; an empty table gives no
rows; only ``doc_id`` and ``text`` are read, whatever other columns are called.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colfit.llm.common import cut, map_batches
from colfit.llm.words import hashes, slices, split
from colfit.operators.stats import added_up

WINDOW = 2048
END_ID = 1
#: Remainders in a shard of the index.
SHARD_ROWS = 1000
#: Terms by which remainders are sorted, and bits of a term's place among all by rarity.
RAREST = 3
RARITY_BITS = 21
#: Remainders in a task, many shards.
TASK_ROWS = 20_000
#: Words, and parts of words, whose ids a worker remembers before it forgets old ones.
MOST_WORDS = 1_200_000
MOST_PARTS = 200_000
#: BM25 constants.
K1 = 1.2
B = 0.75

PIECES = (
    "doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


# Words of printable ASCII and Latin letters only; what they are split into does not
# depend on the Unicode version.
_LATIN = re.compile("[!-~\u00a1-\u012f]+")
# Fixed value: how the tokenizer splits lower-cased text into the parts that it merges.
_PART = re.compile(
    "\\n|'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|[\\d\u00b2\u00b3\u00b9\u00bc-\u00be]|(?:[^\\w\\s]|_)+"
)


class Remembered:
    """A dictionary of bounded size that forgets what was not used for long."""

    def __init__(self, most: int):
        self.most = most
        self.new: dict = {}
        self.old: dict = {}

    def recall(self, keys: Iterable) -> tuple[dict, list]:
        """The values of the keys that are known, and the other keys."""
        if len(self.new) > self.most:
            self.new, self.old = {}, self.new
        known, missing = {}, []
        for key in keys:
            value = self.new.get(key)
            if value is None:
                value = self.old.get(key)
                if value is None:
                    missing.append(key)
                    continue
                self.new[key] = value
            known[key] = value
        return known, missing


class WordEncoder:
    """Ids of whole texts for a tokenizer that drops white space.

    Such a tokenizer never merges over white space, so a text's ids are its words' ids
    end to end; words end at ASCII white space.  Nor does it merge over the parts into
    which it splits a word, so each distinct part of Latin words is encoded by the
    library once, many at a time; other words are encoded whole.

    All words of a batch are found at once by their 64-bit hashes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a part
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        special = self.tokenizer.get_added_tokens_decoder().values()
        if not all(t.content.startswith("<|") for t in special):
            raise ValueError("special strings must begin with <|")
        self.parts = Remembered(MOST_PARTS)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)  # of the words, sorted
        self.entry = np.empty(0, np.int64)  # of each hash
        self.start = np.zeros(1 << 16, np.int64)  # of each entry's ids
        self.size = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, self.kind)
        self.used = 0

    def _remember(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        """Hashes in order, and their words' ids."""
        data = np.frombuffer(b"".join(ids), self.kind)
        sizes = np.array([len(x) for x in ids], np.int64) // np.dtype(self.kind).itemsize
        at, n = len(self.entry), len(hashes)
        while at + n > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        while self.used + len(data) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.start[at : at + n] = self.used + np.cumsum(sizes) - sizes
        self.size[at : at + n] = sizes
        self.flat[self.used : self.used + len(data)] = data
        self.used += len(data)
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.entry = np.insert(self.entry, place, np.arange(at, at + n))

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        texts = [w.decode() for w in words]
        # "<|" begins the special strings, which are tokens of their own.
        latin = [w for w, t in zip(words, texts, strict=True) if _LATIN.fullmatch(t) and "<|" not in t]
        if len(latin) < len(words):
            for word in set(words) - set(latin):
                ids = self.tokenizer.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids
                out[word] = np.array(ids, self.kind).tobytes()
            texts = [w.decode() for w in latin]
        # The parts of all words at once, with a line feed after each word.
        parts = _PART.findall("\n".join([*texts, ""]).lower())
        distinct = set(parts)
        distinct.discard("\n")
        known, missing = self.parts.recall(distinct)
        new = self._encode_parts(missing)
        self.parts.new.update(new)
        known.update(new)
        known["\n"] = None
        word: list[bytes] = []
        done = iter(latin)
        for ids in map(known.__getitem__, parts):
            if ids is None:
                out[next(done)] = word[0] if len(word) == 1 else b"".join(word)
                word = []
            else:
                word.append(ids)
        return out

    def _encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """Each part is one when alone, and just its last token ends it."""
        out: dict[str, bytes] = {}
        size = np.dtype(self.kind).itemsize
        for at in range(0, len(parts), 2000):
            some = parts[at : at + 2000]
            ids = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ids = np.array(ids, self.kind)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * size
            if len(ends) != len(some):
                raise ValueError("the tokenizer splits parts that were one")
            data, places = ids.tobytes(), [0, *ends.tolist()]
            out.update(zip(some, [data[a:b] for a, b in zip(places, places[1:], strict=False)], strict=True))
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, and the end id."""
        words = split(texts)
        codes, distinct = pd.factorize(hashes(words))
        if len(self.entry) > MOST_WORDS:
            self._forget()
        order = np.argsort(distinct)
        keys = distinct[order]
        if not len(self.entry):
            unknown = np.arange(len(keys))
        else:
            at = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
            unknown = np.flatnonzero(self.hashes[at] != keys)
        if len(unknown):
            place = np.empty(len(keys), np.int64)
            place[codes[::-1]] = np.arange(len(codes))[::-1]  # where each word is first
            new = [words.word(p) for p in place[order[unknown]].tolist()]
            ids = self._encode_words(new)
            self._remember(keys[unknown], [ids[w] for w in new])
        found = np.empty(len(keys), np.int64)
        found[order] = self.entry[np.searchsorted(self.hashes, keys)] if len(keys) else 0
        entry = found[codes]
        size = self.size[entry]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.start[entry] - (ends - size), size) + np.arange(total)]
        bounds = np.concatenate(([0], ends))[words.before]  # of the texts' ids
        end = np.array([END_ID], self.kind)
        return [np.concatenate((flat[a:b], end)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """``doc_id, doc_tokens, whole, rest``: checksums of the whole windows, ids of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                part = batch.slice(at, len(texts))
                at += len(texts)
                columns: list[list] = [[], [], []]
                for ids in encode.encode(texts):
                    full = len(ids) // window
                    rest = ids[full * window :]
                    whole = [_crc(ids[i * window : (i + 1) * window]) for i in range(full)]
                    values = (len(ids), whole, rest.tobytes())
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "doc_tokens", "whole", "rest"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"),
        run,
        f"doc_id {kind}, doc_tokens bigint, whole array<bigint>, rest binary",
    )


class Corpus(NamedTuple):
    """What all remainders say: each term's BM25 weight and place by rarity, and the mean length."""

    idf: np.ndarray
    rarity: np.ndarray
    mean: float


def _together(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some pieces, none empty, and where each piece starts."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    return np.concatenate(pieces), np.cumsum(lengths) - lengths


def corpus(rows: DataFrame, kind: type, size: int) -> Corpus:
    """Counted over the remainders of ``rows(rest)``; the vocabulary's size bounds what is sent."""

    def total(batch: pa.RecordBatch) -> np.ndarray:
        pieces = [np.frombuffer(r, kind) for r in batch.column(0).to_pylist() if r]
        sums = np.zeros(size + 2)
        for at in range(0, len(pieces), 500):
            flat, starts = _together(pieces[at : at + 500])
            of = np.repeat(np.arange(len(starts), dtype=np.uint32), np.diff(np.append(starts, len(flat))))
            key = np.sort(of * np.uint32(size) + flat)  # 500 vocabularies fit 32 bits
            sums[:size] += np.bincount(key[np.append(True, key[1:] != key[:-1])] % np.uint32(size), minlength=size)
        sums[size:] = len(pieces), sum(map(len, pieces))
        return sums

    sums = added_up(rows.select("rest"), total)
    if sums is None:
        sums = np.zeros(size + 2)
    df, n = sums[:size], sums[size]
    # A term in half the remainders or more tells nothing; its weight is zero.
    idf = np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0.0)
    shared = np.where(df > 1, df, np.inf)  # one that no other has brings nothing together
    rarity = np.empty(size, np.int32)
    rarity[np.argsort(shared, kind="stable")] = np.arange(size)
    none = (1 << RARITY_BITS) - 1
    if size > none:
        raise ValueError(f"a vocabulary of {size} does not fit {RARITY_BITS} bits")
    return Corpus(idf, np.where((df > 1) & (idf > 0), rarity, none), float(sums[size + 1] / max(n, 1)))


def sort_keys(pieces: list[np.ndarray], known: Corpus) -> np.ndarray:
    """Of each piece: its rarest shared terms, rarest first, as one number."""
    none = (1 << RARITY_BITS) - 1
    out = np.full(len(pieces), (1 << RARITY_BITS * RAREST) - 1)
    some = np.flatnonzero([len(p) for p in pieces])
    if not len(some):
        return out
    flat, starts = _together([pieces[i] for i in some.tolist()])
    rank, lengths = known.rarity[flat], np.diff(np.append(starts, len(flat)))
    key = np.zeros(len(some), np.int64)
    for _ in range(RAREST):
        least = np.minimum.reduceat(rank, starts)
        key = (key << RARITY_BITS) | least
        rank = np.where(rank == np.repeat(least, lengths), none, rank)
    out[some] = key
    return out


def keyed(rows: DataFrame, known: Corpus, kind: type) -> DataFrame:
    """The rows of ``encoded`` with ``signature``, by which remainders are sorted."""
    send = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                pieces = [np.frombuffer(r, kind) for r in part.column("rest").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sort_keys(pieces, send.value))], [*part.schema.names, "signature"]
                )

    return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField("signature", T.LongType())]))


class Index:
    """A BM25 inverted index of the ids of a shard's remainders, weighed by the whole corpus."""

    def __init__(self, pieces: list[np.ndarray], known: Corpus):
        n = len(pieces)
        lengths = np.array([len(p) for p in pieces], np.float64)
        terms, counts, of = [], [], []
        for i, piece in enumerate(pieces):
            t, c = np.unique(piece, return_counts=True)
            terms.append(t)
            counts.append(c)
            of.append(np.full(len(t), i))
        self.own = terms
        all_terms, all_counts, all_of = map(np.concatenate, (terms, counts, of))
        order = np.argsort(all_terms, kind="stable")
        all_terms, self.of = all_terms[order].astype(np.int64), all_of[order]
        tf = all_counts[order].astype(np.float64)
        norm = K1 * (1 - B + B * lengths / max(known.mean, 1.0))
        self.score = known.idf[all_terms] * tf * (K1 + 1) / (tf + norm[self.of])
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(all_terms))))
        self.telling = known.idf > 0
        self.n = n

    def neighbours(self, seed: int) -> np.ndarray:
        """All pieces, best first; ties and strangers in the shard's order."""
        terms = self.own[seed]
        terms = terms[self.telling[terms]].astype(np.int64)
        if not len(terms):
            return np.arange(self.n)
        starts, sizes = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        total = np.bincount(self.of[at], self.score[at], self.n)
        return np.argsort(-total, kind="stable")


def pack_shard(pieces: list[np.ndarray], window: int, known: Corpus) -> Iterator[tuple[int, int, int, int, int]]:
    """``piece, start, length, sequence, offset``: every id of every piece once."""
    index = Index(pieces, known)
    free = np.ones(len(pieces), bool)
    sequence, space = 0, window
    carried: tuple[int, int] | None = None  # a piece cut by the last window, and where
    first = 0
    while carried or free.any():
        if carried:
            seed, start = carried
        else:
            while not free[first]:
                first += 1
            seed, start = first, 0
        carried = None
        free[seed] = False
        queue = iter(())
        piece = seed
        ranked = None
        while True:
            length = min(len(pieces[piece]) - start, space)
            yield piece, start, length, sequence, window - space
            space -= length
            if start + length < len(pieces[piece]):
                carried = (piece, start + length)
            if not space:
                break
            if ranked is None:
                ranked = index.neighbours(seed)
                queue = iter(ranked[free[ranked]].tolist())
            piece, start = next(queue, -1), 0
            if piece < 0:
                return
            free[piece] = False
        sequence, space = sequence + 1, window


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(encoded(docs, path, window))
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    own = encoder(path)
    known = corpus(rows, own.kind, len(own.ends))
    send = docs.sparkSession.sparkContext.broadcast(known)
    dealt = keyed(rows, known, own.kind).repartitionByRange(tasks, "signature", "doc_id").sortWithinPartitions("signature", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_kind, known = encoder(path).kind, send.value
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        held: list[tuple] = []  # id, tokens of the document, start of the remainder, its ids
        id_type = None

        def pack_held(last: bool) -> None:
            """Pack the shard; unless it is the last, an unfilled window's pieces stay."""
            nonlocal sequence
            shard = held.copy()
            held.clear()
            window_pieces: list[tuple] = []
            for i, start, length, k, offset in pack_shard([r[3] for r in shard], window, known):
                doc_id, n, at, ids = shard[i]
                window_pieces.append((doc_id, n, at + start, ids[start : start + length], sequence + k, offset))
                if offset + length == window:
                    write(window_pieces)
                    window_pieces = []
            if last:
                write(window_pieces)
            else:
                held.extend(p[:4] for p in window_pieces)
            filled = sum(len(r[3]) for r in shard) // window
            sequence += filled + bool(last)

        def write(pieces: list[tuple]) -> None:
            for doc_id, n, at, ids, k, offset in pieces:
                out.append((doc_id, at, len(ids), _crc(ids), n, k, offset))

        def take() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 7
            out.clear()
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            kinds = [id_type, *[pa.int64()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            for row in batch.to_pylist():
                for i, crc in enumerate(row["whole"]):
                    out.append((row["doc_id"], i * window, window, crc, row["doc_tokens"], sequence, 0))
                    sequence += 1
                if row["rest"]:
                    ids = np.frombuffer(row["rest"], ids_kind)
                    held.append((row["doc_id"], row["doc_tokens"], len(row["whole"]) * window, ids))
                if len(held) >= SHARD_ROWS:
                    pack_held(False)
            yield take()
        if held:
            pack_held(True)
            yield take()

    return map_batches(dealt, run, PIECES.format(kind=kind))
