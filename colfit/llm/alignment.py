"""Which tokens of two tokenizers cover the same bytes, and how often over a corpus.

A byte-level tokenizer A and a sentence-piece tokenizer B cut the same bytes, a blank and
the text, in two ways.  Their token ends are two rising lists, and merging them yields the
overlaps: every end that is consumed closes one, but an end that both have closes a single
one and with it a group.  The merge of a batch of texts is one long path; binary searches
on its diagonals (merge path, ends of A first among equals) cut it into pieces of equal
work that know nothing of each other.  Each emits its overlaps; a common end whose two
sides fall into two pieces is seen from both, so that groups are stitched where pieces
meet.

Both tokenizers encode pieces that nothing joins with their neighbours, A's by its splitting
pattern, B's from a blank after something else to the next.  Distinct pieces are encoded
once by their libraries and remembered.

A pair of ids counts the documents in which it is linked.  Counts are one aggregate over
every document's distinct pairs.  Back with the documents go the most frequent pairs as a
broadcast of at most ``BROADCAST_PAIRS`` rows; occurrences of all others, none of which can
be frequent then, are joined by shuffle.

Results by case: a null or empty text, and one whose joined tokens of either side differ
from its bytes (B takes U+2581 for a blank), has no tokens, zeros and the empty string;
special strings are ordinary text; of pairs with the same count all are an id's best; rows
that repeat an id are documents of their own; an empty table gives no rows; of the input
only ``doc_id`` and ``text`` are read, whatever else there is; a very long text is aligned
whole by one task, in pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colfit.llm.bytebpe import Memory, cut_at, joined
from colfit.llm.common import cut, map_batches
from colfit.llm.prefixcounts import _byte_letters
from colfit.llm.pretoken import piece_starts
from colfit.llm.words import slices

#: Ends merged by one piece of the path.
PIECE_ENDS = 65_536
#: Bytes of text aligned at once, or one text if it is longer.
TEXT_BYTES = 500_000
#: Most pairs that are broadcast, 17 bytes each.
BROADCAST_PAIRS = 4_000_000
#: Classes of counts for each doubling.
COUNT_CLASSES = 8

BLANK = "▁"


def splits(a: np.ndarray, b: np.ndarray, step: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of the merge of two rising lists start and end, in each list.

    Of equal values that of ``a`` comes first.  Every piece but the last has ``step``.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        ahead = open_.copy()  # the value of a is among those before the diagonal
        ahead[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low = np.where(ahead, middle + 1, low)
        high = np.where(open_ & ~ahead, middle, high)
    return low, diagonal - low


def overlaps(a: np.ndarray, b: np.ndarray, step: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens as places in A and B, and the places of tokens that end together.

    ``a`` and ``b`` are the tokens' ends, of which the last are equal.
    """
    of_a, of_b = splits(a, b, step)
    left, right, close_a, close_b = [], [], [], []
    for i, to_i, j, to_j in zip(of_a, of_a[1:], of_b, of_b[1:], strict=False):
        own_a, own_b = np.arange(i, to_i), np.arange(j, to_j)
        ends_a, ends_b = a[i:to_i], b[j:to_j]
        meets = j + np.searchsorted(ends_b, ends_a)  # the token of B open where one of A ends
        left.append(own_a)
        right.append(meets)
        # Its end may be the first of the next piece.
        both = b[meets] == ends_a
        close_a.append(own_a[both])
        close_b.append(meets[both])
        before = i + np.searchsorted(ends_a, ends_b)
        alone = np.ones(len(own_b), bool)
        inside = before < to_i
        alone[inside] = a[before[inside]] != ends_b[inside]
        if len(own_b) and i and a[i - 1] == ends_b[0]:
            alone[0] = False  # closed by the piece before
        left.append(before[alone])
        right.append(own_b[alone])
    if not left:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in (left, right, close_a, close_b))


class Aligner:
    """The two tokenizers; one per worker, so that the pieces it knows serve all tasks."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        with open(a_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.bytes_a = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if all(c in letters for c in token)}
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        entries = [self.b.id_to_piece(i) for i in range(self.n_b)]
        if any(BLANK in e.lstrip(BLANK) for e in entries):
            raise ValueError("a piece with a blank inside joins what is encoded apart")
        self.bytes_b = {
            i: bytes([int(e[3:5], 16)]) if self.b.is_byte(i) else e.replace(BLANK, " ").encode() for i, e in enumerate(entries)
        }
        self.blank = self.b.piece_to_id(BLANK)
        self.length_a, self.length_b = (
            np.array([len(known.get(i, b"")) for i in range(n)], np.int64)
            for known, n in ((self.bytes_a, self.n_a), (self.bytes_b, self.n_b))
        )
        self.pieces, self.units = Memory(self._piece), Memory(self._unit)
        decimal = [str(i).encode() for i in range(max(self.n_a, self.n_b))]
        self.digits = np.array([len(d) for d in decimal], np.int64)
        self.width = int(self.digits.max()) + 1
        self.pool = np.frombuffer(b"".join(d.ljust(self.width) for d in decimal), np.uint8)

    def _checked(self, ids: list[int], known: dict[int, bytes], text: str) -> bytes:
        """The ids, or -1 if their bytes are not the text's."""
        same = b"".join(known.get(i, b"") for i in ids) == text.encode()
        return np.array(ids if same else [-1], "<i4").tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._checked(self.a.encode(piece, add_special_tokens=False).ids, self.bytes_a, piece)

    def _unit(self, unit: str) -> bytes:
        ids = [self.blank] if unit == " " else self.b.encode(unit[1:], num_threads=1)
        return self._checked(ids, self.bytes_b, unit)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B: ids, and tokens before each text and of all; -1 where bytes differ.

        A blank is put before every text.
        """
        text, points, ends = joined([" " + t for t in texts])
        blank = points == 32
        unit = blank.copy()
        unit[1:] &= ~blank[:-1]
        bounds = np.concatenate(([0], ends))
        unit[bounds[:-1]] = True
        out = []
        for memory, starts in ((self.pieces, piece_starts(points, ends)), (self.units, np.flatnonzero(unit))):
            found = memory.look_up(cut_at(text, starts))
            until = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)))
            out.append((np.frombuffer(b"".join(found), "<i4"), until[np.searchsorted(starts, bounds)]))
        return out

    def group_texts(self, a: np.ndarray, b: np.ndarray, close_a: np.ndarray, close_b: np.ndarray, tokens: np.ndarray) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``; ``tokens`` are those of both sides up to each text."""
        order = np.empty(len(a) + len(b), np.int64)
        sign = np.full(len(order), ord(","), np.uint8)
        for ids, closes, before, mark in (
            (a, close_a, np.concatenate(([0], close_b[:-1] + 1)), "|"),
            (b, close_b, close_a + 1, ";"),
        ):
            last = np.zeros(len(ids), bool)
            last[closes] = True
            place = np.arange(len(ids)) + before[np.cumsum(last) - last]
            order[place] = ids
            sign[place[closes]] = ord(mark)
        size = self.digits[order] + 1
        ends = np.cumsum(size)
        within = np.arange(ends[-1]) - np.repeat(ends - size, size)
        out = self.pool[np.repeat(order * self.width, size) + within]
        out[ends - 1] = sign
        bounds = np.concatenate(([0], ends))[tokens].tolist()
        return [out[x : y - 1].tobytes() for x, y in zip(bounds, bounds[1:], strict=False)]

    def align(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """The columns of ``align`` below, for some texts."""
        n = len(texts)
        out: dict = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {"groups": [b""] * n, "pairs": np.empty(0, np.int64), "times": np.empty(0, np.int64), "n_pairs": np.zeros(n, np.int64)}
        given = np.array([i for i, t in enumerate(texts) if t], np.int64)
        if not len(given):
            return out
        (a, tokens_a), (b, tokens_b) = self.encode([texts[i] for i in given.tolist()])
        good = np.ones(len(given), bool)
        for ids, tokens in ((a, tokens_a), (b, tokens_b)):
            good[np.searchsorted(tokens, np.flatnonzero(ids < 0), "right") - 1] = False
        count_a, count_b = np.diff(tokens_a), np.diff(tokens_b)
        if not good.all():
            a, b = a[np.repeat(good, count_a)], b[np.repeat(good, count_b)]
            given, count_a, count_b = given[good], count_a[good], count_b[good]
            if not len(given):
                return out
        left, right, close_a, close_b = overlaps(np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]))
        until_a = np.concatenate(([0], np.cumsum(count_a)))
        groups = np.diff(np.searchsorted(close_a, until_a))
        out["n_a"][given], out["n_b"][given], out["n_groups"][given] = count_a, count_b, groups
        out["n_links"][given] = count_a + count_b - groups
        both = np.concatenate(([0], np.cumsum(count_a + count_b)))
        for i, text in zip(given.tolist(), self.group_texts(a, b, close_a, close_b, both), strict=True):
            out["groups"][i] = text
        of = np.repeat(given, count_a)[left]
        all_pairs = self.n_a * self.n_b
        key = of * all_pairs + a[left].astype(np.int64) * self.n_b + b[right]
        key, out["times"] = np.unique(key, return_counts=True)
        out["pairs"], out["n_pairs"] = key % all_pairs, np.bincount(key // all_pairs, minlength=n)
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times`` of every whole text.

    ``groups`` has the ids of both sides, group by group, as ``a1,a2|b1;a3|b2,b3``.
    ``pairs`` are the distinct linked ids, A's times the size of B's vocabulary plus B's, and
    ``times`` how often each is linked in the text.  The paths are in the same place on every
    worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            at = 0
            for part in slices(batch.column("text"), TEXT_BYTES):
                found = own.align(part.to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(found["n_pairs"]))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(part)),
                        *(pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "n_links")),
                        pa.array(found["groups"], pa.binary()).cast(pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(found["pairs"])),
                        pa.ListArray.from_arrays(offsets, pa.array(found["times"].astype(np.int32))),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )
                at += len(part)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"),
        run,
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups string, pairs array<bigint>, times array<int>",
    )


def count_pairs(aligned: DataFrame, n_b: int) -> DataFrame:
    """``pair, n, best``: documents in which each pair is linked, and if no pair of its A id has more."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    of_a = Window.partitionBy(F.floor(F.col("pair") / n_b))  # no longer than B's vocabulary
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_a))


def _frequent(counts: DataFrame, most: int) -> int:
    """The least count from which pairs are broadcast, so that they are ``most`` at most."""
    step = F.floor(F.log2("n") * COUNT_CLASSES).cast("int")
    classes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("n")).collect()
    total, least = 0, 1 << 62
    for row in sorted(classes, key=lambda r: -r["step"]):
        total += row["pairs"]
        if total > most:
            break
        least = row["n"]
    return least


def align_and_count(docs: DataFrame, a_path: str, b_path: str, most: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document: what ``align`` counts, ``n_best``, ``count_sum`` and the groups' digest."""
    n_b = aligner(a_path, b_path).n_b
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    sizes = ["n_a", "n_b", "n_groups", "n_links"]
    aligned = cut(align(docs, a_path, b_path).select("doc_id", *sizes, digest, "pairs", "times"))
    aligned = aligned.withColumn("row", F.monotonically_increasing_id())
    counts = cut(count_pairs(aligned, n_b))
    least = _frequent(counts, most)
    frequent = counts.where(F.col("n") >= least).toArrow()
    keys = frequent.column("pair").to_numpy()
    order = np.argsort(keys)
    best = frequent.column("best").to_numpy().astype(bool)[order]
    send = docs.sparkSession.sparkContext.broadcast((keys[order], frequent.column("n").to_numpy()[order], best))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = send.value
        for batch in batches:
            column = batch.column("pairs")
            bounds = column.offsets.to_numpy().astype(np.int64)
            pairs = column.values.to_numpy()[bounds[0] : bounds[-1]]
            times = batch.column("times")
            times = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()].astype(np.int64)
            bounds = bounds - bounds[0]
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            total = np.zeros((2, len(pairs) + 1), np.int64)
            if len(keys):
                np.cumsum(np.where(known & best[at], times, 0), out=total[0, 1:])
                np.cumsum(np.where(known, times * n[at], 0), out=total[1, 1:])
            rest = np.concatenate(([0], np.cumsum(~known)))[bounds].astype(np.int32)
            names = ["doc_id", "row", *sizes, "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    *(pa.array(np.diff(t[bounds])) for t in total),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(pairs[~known])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~known].astype(np.int32))),
                ],
                [*names, "n_best", "count_sum", "pairs", "times"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_batches(
        aligned,
        score,
        f"doc_id {kind}, row bigint, {', '.join(f'{c} bigint' for c in sizes)}, groups_sha256 string, "
        "n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>",
    )
    result = ["doc_id", *sizes, "n_best", "count_sum", "groups_sha256"]
    rare = counts.where(F.col("n") < least)
    if rare.isEmpty():
        return scored.select(*result)
    scored = cut(scored)
    met = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("met")).select(
        "row", F.col("met.pairs").alias("pair"), F.col("met.times").alias("times")
    )
    more = (
        met.join(rare, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    return (
        scored.join(more, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
        .select(*result)
    )
