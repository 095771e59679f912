"""Byte-level byte-pair encoding and decoding of whole texts.

Pieces are located by ``pretoken`` for many texts at once.  Each distinct piece is merged
once, lowest rank first and leftmost of equals, and remembered; a text's ids are the
pieces' ids laid end to end.  Beside the ids every token keeps the byte at which it starts
in its text: decoding copies each token's bytes to that place, and any run of tokens is a
slice of the text.

Results by case: a null text counts as empty; an empty text has no ids; special strings
are ordinary text; rows that repeat an id are rows of their own; an empty table gives no
rows; columns other than ``doc_id`` and ``text`` are not read, whatever their names; a very
long text is encoded whole by one task, whose memory grows with the longest text, and a
very long piece by a heap, in time n log n.  There are no ties: equal merges are taken
from the left, as the library does.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from colfit.llm.common import map_batches
from colfit.llm.pretoken import piece_starts
from colfit.llm.words import slices

#: Pieces remembered by a worker; when there are more, those not seen since the last time
#: are forgotten.
MOST_PIECES = 300_000
#: Longer pieces are encoded but not remembered.
LONGEST_REMEMBERED = 64
#: Bytes from which a piece is merged by a heap.
HEAP_BYTES = 200
#: Ids turned into decimal text at once.
IDS_AT_ONCE = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks, which are the ids, of a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merged(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a piece."""
    if data in ranks:
        return [data]
    if len(data) >= HEAP_BYTES:
        return _merged_by_heap(data, ranks)
    parts = [data[i : i + 1] for i in range(len(data))]
    none = len(ranks) + 1_000_000_000
    rank = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while rank:
        least = min(rank)
        if least == none:
            break
        at = rank.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del rank[at]
        if at:
            rank[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(rank):
            rank[at] = ranks.get(parts[at] + parts[at + 1], none)
    return parts


def _merged_by_heap(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same for a long piece: a heap of possible merges over a linked list of tokens."""
    n = len(data)
    end = list(range(1, n + 1))  # of the token that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
    heapify(heap)

    def offer(left: int) -> None:
        middle = end[left]
        if middle < n and (r := ranks.get(data[left : end[middle]])) is not None:
            heappush(heap, (r, left, end[middle]))

    while heap:
        _, left, right = heappop(heap)
        middle = end[left]
        if not middle or middle >= n or end[middle] != right:
            continue  # one of the two has been merged since
        end[left], end[middle] = right, 0
        if right < n:
            before[right] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [data[i : end[i]] for i in range(n) if end[i]]


class Memory:
    """What pieces of text yield, as bytes, computed once while it is remembered."""

    def __init__(self, compute):
        self.compute = compute
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, pieces: list[str]) -> list[bytes]:
        found = list(map(self.known.get, pieces))
        if None in found:
            for i, value in enumerate(found):
                if value is None:
                    found[i] = self._miss(pieces[i])
        if len(self.known) > MOST_PIECES:
            self.known, self.old = {}, self.known
        return found

    def _miss(self, piece: str) -> bytes:
        value = self.known.get(piece)  # met earlier in the same list
        if value is None:
            value = self.old.get(piece)
            if value is None:
                value = self.compute(piece)
            if len(piece) <= LONGEST_REMEMBERED:
                self.known[piece] = value
        return value


def joined(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts as one, its code points, and where each text ends in them."""
    text = "".join(texts)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return text, points, np.cumsum([len(t) for t in texts], dtype=np.int64)


def cut_at(text: str, starts: np.ndarray) -> list[str]:
    places = starts.tolist()
    return [text[a:b] for a, b in zip(places, [*places[1:], len(text)], strict=False)]


def bytes_before(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes before each code point, and of all."""
    sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))


class Codec:
    """Encodes and decodes with a rank file; one per worker, so that its pieces serve all tasks."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.pieces = Memory(lambda piece: np.array([ranks[t] for t in merged(piece.encode(), ranks)], "<i4").tobytes())
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        self.place = np.cumsum(self.length) - self.length
        self.pool = np.zeros(int(self.length.sum()), np.uint8)
        for token, rank in ranks.items():
            self.pool[self.place[rank] : self.place[rank] + len(token)] = np.frombuffer(token, np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, tokens before each text and of all, each token's first byte in its text."""
        text, points, ends = joined(texts)
        starts = piece_starts(points, ends)
        found = self.pieces.look_up(cut_at(text, starts))
        ids = np.frombuffer(b"".join(found), "<i4")
        until = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)))
        tokens = until[np.searchsorted(starts, np.concatenate(([0], ends)))]
        lengths = self.length[ids]
        place = np.cumsum(lengths) - lengths
        size = bytes_before(points)[np.concatenate(([0], ends))]
        return ids, tokens, place - np.repeat(size[:-1], np.diff(tokens))

    def decode(self, ids: np.ndarray, tokens: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the texts laid end to end, and the bytes before each and of all.

        Takes what ``encode`` gives.
        """
        lengths = self.length[ids]
        until = np.concatenate(([0], np.cumsum(lengths)))
        size = until[tokens]
        out = np.empty(int(until[-1]), np.uint8)
        first = place + np.repeat(size[:-1], np.diff(tokens))  # where each token goes
        within = np.arange(len(out)) - np.repeat(until[:-1], lengths)
        out[np.repeat(first, lengths) + within] = self.pool[np.repeat(self.place[ids], lengths) + within]
        return out, size


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _list_array(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, starts`` of every whole text: token ids, and the byte at which each starts.

    ``path`` is the rank file, in the same place on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts, at = batch.column("text"), 0
            for part in slices(texts):
                ids, tokens, place = own.encode(pc.fill_null(part, "").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), _list_array(ids, tokens), _list_array(place, tokens)],
                    ["doc_id", "ids", "starts"],
                )
                at += len(part)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids array<int>, starts array<int>")


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    tokens = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[tokens[0] : tokens[-1]], tokens - tokens[0]


def _row_slices(batch: pa.RecordBatch, tokens: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a bounded number of tokens, or one row of more."""
    ends = batch.column("ids").offsets.to_numpy().astype(np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + tokens, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _decoded(batches: Iterator[pa.RecordBatch], path: str):
    own = codec(path)
    for batch in batches:
        for part in _row_slices(batch):
            ids, tokens = _lists(part, "ids")
            place, _ = _lists(part, "starts")
            yield part, ids, tokens, *own.decode(ids, tokens, place)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, data``: the bytes of each text that ``encode`` has encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _, data, size in _decoded(batches, path):
            values = [data[a:b].tobytes() for a, b in zip(size.tolist(), size[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.binary())], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids", "starts"), run, f"doc_id {kind}, data binary")


def _ids_digest(ids: np.ndarray) -> str:
    digest = hashlib.sha256()
    for at in range(0, len(ids), IDS_AT_ONCE):
        decimal = " ".join(map(str, ids[at : at + IDS_AT_ONCE].tolist()))
        digest.update((" " + decimal if at else decimal).encode())
    return digest.hexdigest()


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``encode`` gives, decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, tokens, data, size in _decoded(batches, path):
            bounds = list(zip(tokens.tolist(), tokens[1:].tolist(), strict=False))
            spans = zip(size.tolist(), size[1:].tolist(), strict=False)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(tokens)),
                    pa.array([_ids_digest(ids[a:b]) for a, b in bounds], pa.string()),
                    pa.array([hashlib.sha256(data[a:b].tobytes()).hexdigest() for a, b in spans], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(
        encoded.select("doc_id", "ids", "starts"),
        run,
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
