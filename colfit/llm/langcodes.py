"""Language identification by error-correcting output codes.

Each language has a codeword, a row of a Hadamard matrix, and each bit of the codewords
a binary classifier: naive Bayes on character n-grams, of the languages that have the
bit against those that don't.  The classifiers' margins on a text are decoded against
all codewords by exponential loss; the nearest codeword is the prediction and its share
among all the score.  A prediction is ambiguous if the bits in which the two nearest
codewords differ do not clearly speak for the nearest; unlike the score, that does not
shrink with the number of languages.

Learning is one aggregate over all training rows: counts per language and hashed
n-gram.  A model is a table of languages times n-gram buckets, bounded by both.

Results by case: a text that is null or has no letter is ``und`` with score 0 and
ambiguous (letters are the code points of Unicode's letter categories; numerals like a
half or a Roman eight are none); a row without language teaches nothing; without any
training row every text is ``und``; of equally near codewords that of the first language by
name is taken, and the text is ambiguous; a text of any length is read whole, in parts; rows
that repeat an id are predicted each on its own; an empty table gives no rows; all columns
of the input come back inside ``doc``, whatever they are called.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colfit.llm.common import map_batches, remainder_of

UNKNOWN = "und"
FOLDS = 5
#: Hashed n-grams: all runs of this many bytes of the lower-cased letters and blanks.
GRAM_BYTES = 3
BUCKET_BITS = 15
SMOOTHING = 0.5
#: Margins are multiplied by this before decoding; they are a mean per n-gram.
SHARPNESS = 12.0
#: The margin between the two nearest codewords, of the weight of the bits in which they
#: differ (1 if all of it speaks for the nearest), below which a text is ambiguous.
AMBIGUOUS = 0.5
#: Bounds the model: so many languages have 511 classifiers, 67 MB of weights.
MOST_LANGUAGES = 250
#: Bytes hashed at once.
BYTES_AT_ONCE = 1 << 22


_NOT_WORDS = re.compile(r"[\W\d_]+")


@cache
def _numerals() -> np.ndarray:
    """Of every code point: is it no digit but a numeral that counts as part of a word, like a half?"""
    found = np.zeros(sys.maxunicode + 1, bool)
    found[[c for c in range(len(found)) if chr(c).isalnum() and unicodedata.category(chr(c)) in ("Nl", "No")]] = True
    return found


def letters_of(text: str | None) -> str:
    """The lower-cased letters, blanks for all else between them."""
    letters = _NOT_WORDS.sub(" ", (text or "").lower()).strip()
    if not letters.isascii() and _numerals()[np.frombuffer(letters.encode("utf-32-le"), "<u4")].any():
        letters = " ".join("".join(" " if _numerals()[ord(c)] else c for c in letters).split())
    return letters


def _buckets(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the whole text's n-grams, in parts of bounded size."""
    letters = letters_of(text)
    if not letters:
        return
    data = np.frombuffer(f" {letters} ".encode(), np.uint8)
    for at in range(0, len(data) - GRAM_BYTES + 1, BYTES_AT_ONCE):
        part = data[at : at + BYTES_AT_ONCE + GRAM_BYTES - 1].astype(np.uint32)
        code = part[: len(part) - GRAM_BYTES + 1].copy()
        for i in range(1, GRAM_BYTES):
            code = (code << np.uint32(8)) | part[i : len(part) - GRAM_BYTES + 1 + i]
        yield (code * np.uint32(2654435769)) >> np.uint32(32 - BUCKET_BITS)


def _histogram(text: str | None) -> np.ndarray | None:
    total = None
    for part in _buckets(text):
        count = np.bincount(part, minlength=1 << BUCKET_BITS)
        total = count if total is None else total + count
    return total


def codewords(n: int) -> np.ndarray:
    """n rows of a Hadamard matrix, of +1 and -1, without columns that tell nothing."""
    size = 8
    while size < 2 * n:
        size *= 2
    matrix = np.ones((1, 1), np.int8)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    rows = matrix[1 : n + 1] if n < size else matrix
    useful: dict[bytes, np.ndarray] = {}
    for column in rows.T:
        if abs(int(column.sum())) < n:
            column = column * column[0]  # a column and its negative ask the same
            useful.setdefault(column.tobytes(), column)
    return np.array(list(useful.values()), np.int8).reshape(len(useful), n).T


class Model:
    """Binary classifiers and codewords of the learned languages."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.codes = codewords(len(languages)).astype(np.float64)
        share = counts + SMOOTHING
        share /= share.sum(axis=1, keepdims=True)
        weights = []
        for bit in self.codes.T:
            # Languages count alike, however much text each has.
            ones, zeros = share[bit > 0].mean(axis=0), share[bit < 0].mean(axis=0)
            weights.append(np.log(ones) - np.log(zeros))
        self.weights = np.array(weights, np.float32).reshape(len(weights), 1 << BUCKET_BITS).T

    def margins(self, histogram: np.ndarray) -> np.ndarray:
        """Of each classifier: how clearly the text has its bit."""
        seen = np.flatnonzero(histogram)
        return np.clip(histogram[seen] @ self.weights[seen] / histogram.sum() * SHARPNESS, -30, 30)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether it is ambiguous."""
        histogram = _histogram(text) if self.languages else None
        if histogram is None:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        return self.decoded(self.margins(histogram))

    def decoded(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """The nearest codeword's language, its share among all, and whether another is as near."""
        weight = np.abs(margins) / max(np.abs(margins).sum(), 1e-12)  # unsure bits say less
        loss = (weight * np.exp(-self.codes * margins / 4)).sum(axis=1)
        relative = -np.log(loss)
        shown = np.exp(2 * (relative - relative.max()))
        best = int(np.argmax(shown))
        score = float(shown[best] / shown.sum())
        shown[best] = -1
        apart = self.codes[best] != self.codes[int(np.argmax(shown))]
        apart_weight = max(np.abs(margins[apart]).sum(), 1e-12)
        margin = float((self.codes[best] * margins)[apart].sum() / apart_weight)
        return self.languages[best], score, margin < AMBIGUOUS


def learn(training: DataFrame) -> Model:
    """From ``text`` and ``lang`` of all rows that have both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if (histogram := _histogram(text)) is not None:
                    totals[lang] = totals[lang] + histogram if lang in totals else histogram
        for lang, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())],
                ["lang", "bucket", "count"],
            )

    labelled = training.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counted = map_batches(labelled, count, "lang string, bucket int, count bigint")
    # A number for each language and bucket, as arrays; one row more than may be tells of too many.
    most = MOST_LANGUAGES << BUCKET_BITS
    summed = counted.groupBy("lang", "bucket").agg(F.sum("count").alias("count")).limit(most + 1).toArrow()
    found = summed.column("lang").combine_chunks().dictionary_encode()
    names = found.dictionary.to_pylist()
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    order = np.argsort(np.array(names, object)) if names else np.empty(0, np.int64)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    counts = np.zeros((len(names), 1 << BUCKET_BITS))
    counts[place[found.indices.to_numpy()], summed.column("bucket").to_numpy()] = summed.column("count").to_numpy()
    return Model([names[i] for i in order.tolist()], counts)


def identify(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Per row: ``doc, held_out, lang_pred, score, ambiguous``; doc is the row as it came."""
    held_out = remainder_of(F.col("doc_id"), folds) == 0
    model = learn(docs.where(~held_out))
    send = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("doc").field("text").to_pylist()
            found = [send.value.predict(t) for t in texts]
            lang, score, ambiguous = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(ambiguous, pa.bool_()),
                ],
                [*batch.schema.names, "lang_pred", "score", "ambiguous"],
            )

    rows = docs.select(F.struct("*").alias("doc"), held_out.alias("held_out"))
    schema = (
        T.StructType(list(rows.schema.fields))
        .add("lang_pred", "string")
        .add("score", "double")
        .add("ambiguous", "boolean")
    )
    return map_batches(rows, predict, schema)
