"""Token counts of every prefix of a text by dynamic programming.

For byte-pair encoding, the encoding of a word's prefix ends in exactly one token t for
which the encoding of what comes before t ends in a token that t may follow.  So one
left-to-right pass finds the last token, and with it the token count, of every prefix:

    count(i) = count(i - length(t)) + 1

A token may follow another if merging their joined bytes gives back the two.  Words are
the pieces in which the tokenizer itself splits a text before it merges; the pass runs
once per distinct word, and a text's counts are the words' counts laid end to end.

Stored per text is the change of the count from each prefix to the next, one signed byte
per code point.  Their sum up to a place answers what a truncation there costs, and the
longest prefix within a budget is found without encoding again.

Results by case: a null text counts as empty; an empty text has no token and no prefix;
the special string, which the tokenizer takes as one token, counts as one where it ends
and as ordinary text before; rows that repeat an id are rows of their own; there are no ties,
as just one last token is right; a text of any length is counted whole, a byte for each code
point; an empty table gives no rows; only ``doc_id`` and ``text`` are read, whatever other
columns are called.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from colfit.llm.common import map_batches

LIMIT = 512
#: Words remembered by a worker; when there are more those not seen since the last
#: time are forgotten.
MOST_WORDS = 300_000

# The Unicode white space characters.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Coarse pieces whose borders are always borders between words.
_PIECE = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
# Fixed value: how a byte-level tokenizer splits text, here only used where every
# character is Latin, for which all Unicode versions agree.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LATIN_END = "\u0250"
#: Words that are one only when complete; a shorter prefix is a quote and a letter.
_SPLIT_UNTIL_WHOLE = {"'re", "'ve", "'ll"}


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Counts for a byte-level byte-pair tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        # Of each token: the rank of the merge that forms it, and its two parts.
        self.formed = {bytes([b]): -1 for b in range(256)}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for (a, b), rank in self.ranks.items():
            if a + b not in self.formed:
                self.formed[a + b], self.parts[a + b] = rank, (a, b)
        tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in self.ranks}
        self.longest = max(map(len, tokens))
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_pattern = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.tokens = {t for t in tokens if self._merged(t) == [t]}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}

    def _merged(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            rank, at = min((ranks.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, a: bytes, b: bytes) -> bool:
        """Whether no merge across the border comes before those that form a and b.

        The formation of the two is undone, latest merge first; at every step the
        tokens at the border must not merge earlier than the step undone.
        """
        known = self.follows.get((a, b))
        if known is not None:
            return known
        ranks, formed, parts = self.ranks, self.formed, self.parts
        x, y, limit = a, b, 1 << 60
        while True:
            if ranks.get((x, y), limit) < limit:
                known = False
                break
            left, right = formed[x], formed[y]
            if left < 0 and right < 0:
                known = True
                break
            if left > right:
                limit, x = left, parts[x][1]
            else:  # of equal merges the one further left, here across the border, is first
                limit, y = right + 1, parts[y][0]
        if len(self.follows) > 1_000_000:
            self.follows.clear()
        self.follows[a, b] = known
        return known

    def _counts(self, data: bytes) -> list[int]:
        """The token count of every byte prefix of a word."""
        tokens, longest = self.tokens, self.longest
        known, may_follow = self.follows.get, self._may_follow
        last: list[bytes] = [b""]
        counts = [0]
        start = 0
        for end in range(1, len(data) + 1):
            # Just one start is right; that of the prefix before is the likeliest.
            for start in (start, *range(end - longest if end > longest else 0, end)):
                token = data[start:end]
                if token in tokens:
                    if not start:
                        break
                    follows = known((last[start], token))
                    if follows or (follows is None and may_follow(last[start], token)):
                        break
            else:
                raise ValueError(f"no token ends {data[:end]!r}")
            last.append(token)
            counts.append(counts[start] + 1)
        return counts

    def _changes(self, word: str) -> bytes:
        """Of a word: the change of the count at each character."""
        changes = self.words.get(word)
        if changes is None:
            changes = self.old_words.get(word)
            if changes is not None:
                self.words[word] = changes
                return changes
            data = word.encode()
            counts = self._counts(data)
            if word in _SPLIT_UNTIL_WHOLE:
                counts[2] = counts[1] + 1
            if len(data) != len(word):  # keep the counts where characters end
                counts = [c for c, byte in zip(counts, data, strict=False) if byte & 0xC0 != 0x80] + counts[-1:]
            changes = bytes([(b - a) & 255 for a, b in zip(counts, counts[1:], strict=False)])
            if len(self.words) > MOST_WORDS:
                self.words, self.old_words = {}, self.words
            self.words[word] = changes
        return changes

    def _piece(self, piece: str) -> bytes:
        known = self.old_pieces.get(piece)
        if known is not None:
            self.pieces[piece] = known
            return known
        if piece.isascii() or max(piece) < _LATIN_END:
            words = _WORD.findall(piece)
        else:
            words = [piece[a:b] for _, (a, b) in self.split(piece)]
        known = b"".join(map(self._changes, words))
        self.pieces[piece] = known
        return known

    def _plain(self, text: str) -> bytes:
        if len(self.pieces) > MOST_WORDS:
            self.pieces, self.old_pieces = {}, self.pieces
        get, miss = self.pieces.get, self._piece
        pieces = _PIECE.findall(text)
        out = [get(p) or miss(p) for p in pieces]
        if not _TWO_BLANKS.search(text):
            return b"".join(out)
        for i, piece in enumerate(pieces[:-1]):
            if _in_run(piece, pieces[i + 1]):
                # A run of white space is one word in every prefix that ends in it, but
                # gives its last character to what follows.
                run = piece + pieces[i + 1][0]
                whole = sum(np.frombuffer(self._changes(run), np.int8).tolist())
                before = sum(np.frombuffer(out[i], np.int8).tolist())
                then = np.frombuffer(out[i + 1], np.int8).astype(np.int16)
                shift = whole - before - then[0]
                then[0] += shift
                if len(then) > 1:
                    then[1] -= shift
                    out[i + 1] = then.astype(np.int8).tobytes()
                else:  # a single white space character; the piece after it takes the rest
                    after = np.frombuffer(out[i + 2], np.int8).astype(np.int16)
                    after[0] -= shift
                    out[i + 1], out[i + 2] = then.astype(np.int8).tobytes(), after.astype(np.int8).tobytes()
        return b"".join(out)

    def changes(self, text: str) -> bytes:
        """The change of the token count at each code point of a text."""
        if not self.special_pattern or "<" not in text:
            return self._plain(text)
        out, at = [], 0
        for match in self.special_pattern.finditer(text):
            part = text[at : match.end()]
            ordinary = np.frombuffer(self._plain(part), np.int8).astype(np.int64)
            body = len(part) - len(match[0])
            alone = int(np.frombuffer(self._plain(part[:body]), np.int8).sum(dtype=np.int64))
            ordinary[-1] = alone + 1 - ordinary[:-1].sum()
            out.append(ordinary.astype(np.int8).tobytes())
            at = match.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)


_BLANK = re.compile(f"[{_SPACE}]+")


_TWO_BLANKS = re.compile(f"[{_SPACE}][{_SPACE}]")


def _in_run(piece: str, following: str) -> bool:
    return bool(_BLANK.fullmatch(piece) and _BLANK.match(following))


def count_at(changes: bytes, characters: int) -> int:
    """Tokens of the prefix of so many characters."""
    return int(np.frombuffer(changes, np.int8)[:characters].sum(dtype=np.int64))


def longest_within(changes: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most so many tokens."""
    counts = np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One per worker, so that its words serve all its tasks."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, changes`` of every whole text.

    ``path`` is the tokenizer's file, in the same place on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            changes = [count.changes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([count_at(c, len(c)) for c in changes], pa.int64()),
                    pa.array(changes, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "changes"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, changes binary"
    )
