"""Spelling variants: words one edit apart, found with bit-sliced position indexes.

An index holds a bit per vocabulary word for every position and letter: is that letter at
that position?  A query word is read letter by letter while 64 words a machine word are
followed at once, those without an error so far (Z) and those with one, by what the error
was: S a letter replaced, I one more in the vocabulary word, D one less.  With M(p) the
bits of the letter just read at position p and i its own position,

    S = S & M(i) | Z & ~M(i)      I = (I | Z) & M(i + 1)      D = D & M(i - 1) | Z
    Z = Z & M(i)

A whole vocabulary in one index would be compared with itself.  An edit lies in one of
``PARTS`` parts of the shorter word, though, and the others are equal, so a word stands
under its letters less one part, as itself and as a word of one letter more.  Indexes are
built for the words of such a key only.  A pair may share several keys; it counts in the
part in which its common beginning ends, which the Z of that place tells.

Keys with more than ``TILE_WORDS`` words are cut into tiles, and every two tiles are a unit
of work, so no task holds all words of a hot key.

Results by case: a null text has no words; a null id is empty where it is hashed; a word's
best of several equally frequent near words is the least in code-point order; rows that
repeat an id count again; an empty table gives no rows; only ``doc_id`` and ``text`` are
read, whatever else there is; a very long word is indexed in windows of positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.llm.common import attach, cut, id_text, map_batches

# Fixed values of the contract.
SMUDGE = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3
FORM_RATIO = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "a-zÀ-ÿ"

PARTS = 3
#: Words of a key that are compared as one unit.
TILE_WORDS = 4096
#: Rows of keys that a task gets on average.
TASK_ROWS = 200_000
#: Rows, letters, index cells and machine words taken at once.
ROWS_AT_ONCE = 50_000
LETTERS_AT_ONCE = 2_000_000
CELLS_AT_ONCE = 2_000_000
LANES_AT_ONCE = 200_000
#: Rounds after which following forms is taken to have failed; chains double at every step.
MOST_ROUNDS = 64


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the words that are long and frequent enough, some spoilt by one letter."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0))
    run = docs.select(id_text(F.col("doc_id")).alias("id"), F.explode(runs).alias("run"))
    hashed = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    gone = (F.col("h") % F.char_length("run")).cast("int")
    spoilt = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.char_length("run")))
    word = F.when(F.col("h") % SMUDGE == 0, spoilt).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.char_length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))


def bounds(length: int) -> list[int]:
    """Where the parts of a word of so many letters begin, and its end."""
    return [part * length // PARTS for part in range(PARTS + 1)]


def _keys(words: DataFrame) -> DataFrame:
    """``length, part, rest, word, n`` for each part, as itself and as one letter more than ``length``."""

    def key(part: int, more: int) -> Column:
        length = F.char_length("word") - more
        start, end = (F.floor(length * p / PARTS).cast("int") for p in (part, part + 1))
        rest = F.concat(
            F.substring("word", F.lit(1), start), F.lit("\0"), F.substring("word", end + 1 + more, F.char_length("word"))
        )
        return F.struct(length.alias("length"), F.lit(part).alias("part"), rest.alias("rest"))

    keys = F.explode(F.array(*[key(part, more) for part in range(PARTS) for more in (0, 1)])).alias("key")
    return words.select(keys, "word", "n").select("key.length", "key.part", "key.rest", "word", "n")


def _units(words: DataFrame) -> DataFrame:
    """``length, part, unit, word, n, asks, answers``: the keys, hot ones cut into pairs of tiles."""
    name = ["length", "part", "rest"]
    keys = _keys(words)
    tiles = F.ceil(F.count("*") / TILE_WORDS).cast("int").alias("tiles")
    hot = cut(keys.groupBy(*name).agg(tiles).where("tiles > 1"))
    tiled = attach(keys, hot, name, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    others = F.sequence(F.lit(0), F.col("tiles") - 1)

    def unit(i: Column, j: Column, asks: bool, answers: bool) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"), F.lit(answers).alias("answers"))

    several = F.concat(F.transform(others, lambda j: unit(own, j, True, False)), F.transform(others, lambda i: unit(i, own, False, True)))
    zero = F.lit(0)
    met = F.explode(F.when(F.col("tiles") > 1, several).otherwise(F.array(unit(zero, zero, True, True)))).alias("met")
    # Units whose hashes collide are compared as one, which finds no other pairs.
    return tiled.select(*name, "word", "n", met).select(
        "length", "part", F.xxhash64(*name, "met.i", "met.j").alias("unit"), "word", "n", "met.asks", "met.answers"
    )


class _Index:
    """Bits of words by position and letter, in windows of positions."""

    def __init__(self, codes: np.ndarray, alphabet: int):
        self.codes, self.alphabet = codes, alphabet
        self.lanes = -(-len(codes) // 64)
        self.width = max(4, CELLS_AT_ONCE // (self.lanes * alphabet))
        self.bit = np.uint64(1) << (np.arange(len(codes)) % 64).astype(np.uint64)
        self.low = self.high = 0

    def bits(self, lane: np.ndarray, position: int, letter: np.ndarray) -> np.ndarray:
        """Of each lane: the words with the letter at the position."""
        if not self.low <= position < self.high:
            self.low = max(0, position - 1)  # the places around a letter are asked for together
            self.high = min(self.low + self.width, max(self.codes.shape[1], position + 1))
            part = self.codes[:, self.low : self.high]
            word, place = np.nonzero(part)
            cell = ((word // 64) * (self.high - self.low) + place) * self.alphabet + part[word, place]
            self.table = np.zeros(self.lanes * (self.high - self.low) * self.alphabet, np.uint64)
            np.add.at(self.table, cell, self.bit[word])  # every word has its own bit
        return self.table[(lane * (self.high - self.low) + position - self.low) * self.alphabet + letter]


def _codes(words: list[str], width: int) -> tuple[np.ndarray, int]:
    """Letters as small numbers, 0 past a word's end, and how many numbers there are."""
    points = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
    present = np.zeros(int(points.max()) + 1, bool)
    present[points] = True
    present[0] = True
    number = np.cumsum(present) - 1
    return number[points].astype(np.int32), int(number[-1]) + 1


def near_pairs(
    length: int, part: int, unit: np.ndarray, words: list[str], asks: np.ndarray, answers: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of words one edit apart, that ask and that answer, in rows sorted by unit.

    The words have ``length`` letters or one more; two of the latter are not compared, nor
    pairs whose edit isn't in the given part.
    """
    size = np.array([len(w) for w in words])
    codes, alphabet = _codes(words, length + 1)
    limits = bounds(length)
    members = np.flatnonzero(answers)
    index = _Index(codes[members], alphabet)
    of_size = np.zeros((2, index.lanes), np.uint64)  # words of each length
    np.add.at(of_size, (size[members] - length, np.arange(len(members)) // 64), index.bit)
    found = []
    for more in (0, 1):
        asking = np.flatnonzero(asks & (size == length + more))
        start, end = (np.searchsorted(unit[members], unit[asking], side) for side in ("left", "right"))
        asking, start, end = (x[end > start] for x in (asking, start, end))
        lanes = (end - 1) // 64 - start // 64 + 1
        until = np.cumsum(lanes)
        at = 0
        while at < len(asking):
            base = until[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(until, base + LANES_AT_ONCE, "right")))
            n = lanes[at:to]
            row = np.repeat(np.arange(at, to), n)
            lane = start[row] // 64 + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            near = _one_error(index, codes[asking[row]], lane, length, part, more, limits, of_size)
            # Only words of the same unit, which may begin and end inside a lane.
            low, high = np.maximum(start[row] - lane * 64, 0), np.minimum(end[row] - lane * 64, 64)
            ones = np.uint64(0xFFFFFFFFFFFFFFFF)
            near &= (ones << low.astype(np.uint64)) & (ones >> (64 - high).astype(np.uint64))
            hit = np.flatnonzero(near)
            bits = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, bit = np.nonzero(bits)
            found.append((asking[row[hit[i]]], members[lane[hit[i]] * 64 + bit]))
            at = to
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = (np.concatenate(x) for x in zip(*found, strict=True))
    return left, right


def _one_error(index, letters, lane, length, part, more, limits, of_size) -> np.ndarray:
    """Of each asking word and lane: the words at one error whose common beginning ends in the part."""
    zero = of_size[0, lane] | of_size[1, lane]
    replaced, added, left_out = (np.zeros(len(lane), np.uint64) for _ in range(3))
    starts = ends = zero
    for i in range(length + more):
        if i == limits[part]:
            starts = zero
        if i == limits[part + 1]:
            ends = zero
        letter = letters[:, i]
        if more:
            left_out = (left_out & index.bits(lane, i - 1, letter) if i else left_out) | zero
            zero = zero & index.bits(lane, i, letter)
        else:
            here = index.bits(lane, i, letter)
            replaced = (replaced & here) | (zero & ~here)
            added = (added | zero) & index.bits(lane, i + 1, letter)
            zero = zero & here
    if more:
        near = left_out & of_size[0, lane]
    else:
        near = (replaced & of_size[0, lane]) | ((added | zero) & of_size[1, lane])
    return near & starts & (~ends if part < PARTS - 1 else near)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one length and part, whole units, of bounded size but for one unit."""
    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            step = batch.slice(at, ROWS_AT_ONCE)
            at += step.num_rows
            held.append(step)
            rows += step.num_rows
            if rows >= ROWS_AT_ONCE:
                parts, rest = _whole(pa.Table.from_batches(held), False)
                yield from parts
                held, rows = rest.to_batches(), rest.num_rows
    if held:
        yield from _whole(pa.Table.from_batches(held), True)[0]


def _whole(table: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
    """The table cut by length, part and size where units end, and its unfinished unit."""
    length, part, unit = (table.column(c).to_numpy() for c in ("length", "part", "unit"))
    new_group = (length[1:] != length[:-1]) | (part[1:] != part[:-1])
    new_unit = np.flatnonzero(new_group | (unit[1:] != unit[:-1])) + 1
    stop = table.num_rows if last else (int(new_unit[-1]) if len(new_unit) else 0)
    cuts = [0, *(np.flatnonzero(new_group) + 1).tolist(), stop]
    out = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        high = min(high, stop)
        while low < high:
            most = max(1, min(ROWS_AT_ONCE, LETTERS_AT_ONCE // (int(length[low]) + 1)))
            to = high
            if high - low > most:  # end with a unit
                ends = new_unit[(new_unit > low) & (new_unit <= high)]
                fits = ends[ends <= low + most]
                to = int(fits[-1]) if len(fits) else int(ends[0]) if len(ends) else high
            out.append(table.slice(low, to - low))
            low = to
    return out, table.slice(stop)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: near words of ``words(word, n)``, and the most frequent of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            unit = table.column("unit").to_numpy()
            apart = np.concatenate(([True], unit[1:] != unit[:-1]))
            alone = apart & np.concatenate((apart[1:], [True]))
            table = table.filter(pa.array(~alone))
            if not table.num_rows:
                continue
            unit, n = table.column("unit").to_numpy(), table.column("n").to_numpy()
            number = np.cumsum(np.concatenate(([True], unit[1:] != unit[:-1])))
            word = table.column("word").combine_chunks()
            asks, answers = (table.column(c).to_numpy() for c in ("asks", "answers"))
            length, part = table.column("length")[0].as_py(), table.column("part")[0].as_py()
            left, right = near_pairs(length, part, number, word.to_pylist(), asks, answers)
            if not len(left):
                continue
            # Rows of a unit are in code-point order, so the first of equals is the least.
            order = np.lexsort((right, -n[right], left))
            left, right = left[order], right[order]
            first = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1])))
            yield pa.RecordBatch.from_arrays(
                [
                    word.take(pa.array(left[first])),
                    pa.array(np.diff(np.append(first, len(left)))),
                    pa.array(n[right[first]]),
                    word.take(pa.array(right[first])),
                ],
                ["word", "n_near", "best_n", "best"],
            )

    rows = _units(words)
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, -(-words.count() * 2 * PARTS // TASK_ROWS))
    dealt = rows.repartition(tasks, "length", "part", "unit").sortWithinPartitions("length", "part", "unit", "word")
    found = map_batches(dealt, run, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: the last form, each round doubling the steps taken."""
    current = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(MOST_ROUNDS):
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(attach(current, further, ["root"], "left"))
        if moved.where("next IS NOT NULL").isEmpty():
            return current
        current = moved.select("word", F.coalesce("next", "root").alias("root"))
    raise RuntimeError(f"forms not settled after {MOST_ROUNDS} rounds")


def variants(docs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every long and frequent word of the documents.

    A word's form is its most frequent near word if that is at least twice as frequent; its
    root is where following forms ends, itself if it has none.
    """
    words = cut(word_counts(docs))
    near = words.join(near_words(words), "word", "left")
    better = F.col("best_n") >= FORM_RATIO * F.col("n")
    formed = cut(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(better, F.col("best")).alias("form"),
            F.when(better, F.col("best_n")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    return attach(formed, roots, ["word"], "left").withColumn("root", F.coalesce("root", "word"))


def variants_sql() -> str:
    """The same in DuckDB: deletions of every word meet in a table."""

    def entry(value: int) -> int:  # of the checksum's table, by its rule
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        return value

    entries = ", ".join(str(entry(i)) for i in range(256))
    digest = (
        "xor(4294967295::UBIGINT, list_reduce(bytes, lambda c, b: "
        f"xor(c >> 8, ([{entries}]::UBIGINT[])[(xor(c, b) & 255::UBIGINT)::BIGINT + 1]), 4294967295::UBIGINT))"
    )
    return f"""WITH RECURSIVE runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[{LETTERS}]+')) AS run FROM documents),
    counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS times FROM runs
        WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
    spelt AS (SELECT run, times, flatten(list_transform(string_split(id || ':' || run, ''), lambda x:
        CASE WHEN unicode(x) < 128 THEN [unicode(x)::UBIGINT] ELSE [195::UBIGINT, (unicode(x) - 64)::UBIGINT] END)) AS bytes FROM counted),
    hashed AS (SELECT run, times, ({digest})::BIGINT AS h FROM spelt),
    spoilt AS (SELECT times, CASE WHEN h % {SMUDGE} = 0
        THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
    words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spoilt
        WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(times) >= {LEAST_COUNT}),
    gaps AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM
        (SELECT word, unnest(range(length(word))) AS i FROM words)),
    near AS (SELECT a.word AS word, b.word AS other FROM gaps a JOIN gaps b USING (i, rest) WHERE a.word <> b.word
        UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.rest
        UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.rest),
    ranked AS (SELECT near.word, other, w.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) AS place
        FROM near JOIN words w ON w.word = near.other),
    formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN other_n >= {FORM_RATIO} * n THEN other END AS form,
        CASE WHEN other_n >= {FORM_RATIO} * n THEN other_n END AS form_n
        FROM words LEFT JOIN ranked ON ranked.word = words.word AND place = 1),
    follow AS (SELECT word, word AS last FROM formed
        UNION ALL SELECT follow.word, f.form FROM follow JOIN formed f ON f.word = follow.last WHERE f.form IS NOT NULL)
    SELECT formed.word, n, n_near, form, form_n, last AS root FROM formed JOIN follow ON follow.word = formed.word
        WHERE last IN (SELECT word FROM formed WHERE form IS NULL)"""
