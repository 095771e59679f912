"""Where byte-level tokenizers split a text, found without a regular expression.

The splitting pattern is a finite automaton.  Every code point gets a symbol from arrays:
its class from a table of all code points, and what follows it from the same array moved
by one or two places.  Each symbol is a function from the automaton's states to its
states.  Composing functions is associative and, with few states, only a few hundred
functions can arise, so they are numbered and their compositions kept in a table.  A scan
over the numbers then gives the state before every code point, for many texts at once:
parts of the array are composed side by side, then the parts' products, then both
together.  A border stands where state and symbol say so.

Results by case: an empty text has no piece; white space at a text's end is one piece;
pieces never cross texts; a text of any length is one array.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols: the classes, quotes that open a contraction of one or two letters, a blank
# before what it is joined to, other white space before something else, and white space
# before white space or the end.  Those of a text's first code point come after them.
QUOTE_1, QUOTE_2, JOINED, ALONE, RUN = 3, 4, 5, 6, 7
SYMBOLS = 8
# States: what the code point before belongs to.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, AFTER_BLANK, ONE_TO_COME, TWO_TO_COME = range(8)
STATES = 8
# What may follow the quote of a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Numbers composed one after the other in each of the parts that are composed side by side.
PART = 128


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a piece starts, by state and symbol."""
    opens = [IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_TO_COME, TWO_TO_COME, AFTER_BLANK, FRESH, IN_SPACE]
    following = np.tile(np.array(opens), (STATES, 1))
    starts = np.ones((STATES, SYMBOLS), bool)
    goes_on = {
        IN_LETTERS: {LETTER: IN_LETTERS},
        IN_NUMBERS: {NUMBER: IN_NUMBERS},
        # In a run of other characters a quote is one of them.
        IN_OTHER: {s: IN_OTHER for s in (OTHER, QUOTE_1, QUOTE_2)},
        IN_SPACE: {RUN: IN_SPACE},
        AFTER_BLANK: {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, **{s: IN_OTHER for s in (OTHER, QUOTE_1, QUOTE_2)}},
        ONE_TO_COME: {s: FRESH for s in range(SYMBOLS)},
        TWO_TO_COME: {s: ONE_TO_COME for s in range(SYMBOLS)},
    }
    for state, symbols in goes_on.items():
        for symbol, then in symbols.items():
            following[state, symbol], starts[state, symbol] = then, False
    return following, starts


class Functions:
    """All functions of states that compositions of symbols yield, by number; 0 is the identity."""

    def __init__(self, following: np.ndarray):
        identity = tuple(range(STATES))
        symbols = [tuple(following[:, s].tolist()) for s in range(SYMBOLS)]
        symbols += [(f[FRESH],) * STATES for f in symbols]  # whatever came before
        number = {identity: 0}
        waiting = [identity]
        while waiting:
            f = waiting.pop()
            for g in symbols:
                h = tuple(g[x] for x in f)
                if h not in number:
                    number[h] = len(number)
                    waiting.append(h)
        self.n = len(number)
        self.of_symbol = np.array([number[s] for s in symbols], np.int32)
        self.image = np.array(list(number), np.int8)
        self.then = np.array([number[tuple(self.image[g][self.image[f]].tolist())] for f in range(self.n) for g in range(self.n)], np.int32)

    def products(self, functions: np.ndarray) -> np.ndarray:
        """Of each place: the composition of all functions up to it."""
        n = len(functions)
        if n <= PART:
            out, held = np.empty(n, np.int32), 0
            for i, f in enumerate(functions.tolist()):
                out[i] = held = self.then[held * self.n + f]
            return out
        parts = -(-n // PART)
        table = np.zeros(parts * PART, np.int32)
        table[:n] = functions
        table = np.ascontiguousarray(table.reshape(parts, PART).T)
        for i in range(1, PART):  # all parts side by side
            table[i] = self.then.take(table[i - 1] * self.n + table[i])
        before = np.concatenate((np.zeros(1, np.int32), self.products(table[-1])[:-1]))
        return self.then.take(before * self.n + table).T.reshape(-1)[:n]


@cache
def _machine() -> tuple[Functions, np.ndarray]:
    following, starts = _automaton()
    return Functions(following), starts


@cache
def classes() -> np.ndarray:
    """The class of every code point, read off once from the library that knows the pattern.

    A library keeps, of its input, what its pattern matches; so all code points go through
    it once for letters, numbers and white space, in its version of Unicode.
    """
    import tiktoken

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], "<u4")
    text = points.tobytes().decode("utf-32-le")
    ranks = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        library = tiktoken.Encoding(f"class {kind}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found = bytes(library.encode_ordinary(text)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return table


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each code point; ``ends`` are where non-empty texts end."""
    kind = classes()[points]
    last = ends - 1
    solid_next = np.zeros(len(points), bool)
    solid_next[:-1] = kind[1:] != SPACE
    solid_next[last] = False
    symbol = kind.astype(np.int32)
    space = kind == SPACE
    symbol[space] = np.where(solid_next[space], np.where(points[space] == 32, JOINED, ALONE), RUN)
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        padded = np.concatenate((points, np.zeros(2, points.dtype)))
        room = ends[np.searchsorted(ends, quotes, "right")] - quotes - 1  # code points left in the text
        for letters in CONTRACTIONS:
            found = room >= len(letters)
            for i, c in enumerate(letters):
                found &= padded[quotes + 1 + i] == ord(c)
            symbol[quotes[found]] = QUOTE_1 if len(letters) == 1 else QUOTE_2
    symbol[np.concatenate(([0], ends[:-1]))] += SYMBOLS
    return symbol


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces start in the joined code points of texts that end at ``ends``.

    ``ends`` rises; equal ones are empty texts.
    """
    if not len(points):
        return np.empty(0, np.int64)
    ends = np.unique(ends[ends > 0])
    functions, starts = _machine()
    symbol = _symbols(points, ends)
    after = functions.image[functions.products(functions.of_symbol[symbol]), FRESH]
    before = np.concatenate(([FRESH], after[:-1]))
    first = symbol >= SYMBOLS
    symbol[first] -= SYMBOLS
    return np.flatnonzero(starts[before, symbol] | first)
