"""Random draws without a generator's state: each is a function of a seed, a stream and a counter.

The words are those of Threefry 2x32 with 20 rounds, a published counter-based generator that needs only additions
modulo 2**32, rotations and exclusive ors. So the same draw is made by a column expression in the JVM, by numpy over
arrays, and by SQL, for any row on its own, in any order, on any executor. Uniform numbers have 52 bits and lie strictly
between 0 and 1; normal ones come from them by a rational approximation of the inverse (relative error below 1.2e-9).
"""

from __future__ import annotations

from math import prod

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The published rotations, rounds and parity word of the generator.
ROTATIONS = (13, 15, 26, 6, 17, 29, 16, 24)
ROUNDS = 20
PARITY = 0x1BD11BDA
WORD = 0xFFFFFFFF
# The published coefficients of the inverse normal distribution, and where its tails begin.
MIDDLE_UP = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
MIDDLE_DOWN = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
TAIL_UP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
TAIL_DOWN = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
TAIL = 0.02425
BITS = 52


def _long(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("long")


def _word(x: Column) -> Column:
    return x.bitwiseAND(F.lit(WORD).cast("long"))


def _folded(seed: Column | int, counter: Column | int, stream: Column | int, finish) -> Column:
    """finish of both words: an aggregate over the rounds, so no expression is repeated in another."""
    seed, counter, stream = _long(seed), _long(counter), _long(stream)
    first, second = _word(seed), _word(F.shiftright(seed, 32))
    keys = F.array(first, second, first.bitwiseXOR(second).bitwiseXOR(F.lit(PARITY).cast("long")))
    turns = F.array(*(F.lit(r) for r in ROTATIONS))

    def step(s: Column, i: Column) -> Column:
        turn, total = F.get(turns, i % len(ROTATIONS)), _word(s["a"] + s["b"])
        turned = _word(F.call_function("shiftleft", s["b"], turn).bitwiseOR(F.call_function("shiftright", s["b"], F.lit(32) - turn)))
        mixed = turned.bitwiseXOR(total)
        at = (i + 1) / 4
        at = at.cast("int")
        injects = (i + 1) % 4 == 0
        return F.struct(
            F.when(injects, _word(total + F.get(keys, at % 3))).otherwise(total).alias("a"),
            F.when(injects, _word(mixed + F.get(keys, (at + 1) % 3) + at)).otherwise(mixed).alias("b"),
        )

    start = F.struct(_word(_word(counter) + first).alias("a"), _word(_word(stream) + second).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, finish)


def words(seed: Column | int, counter: Column | int, stream: Column | int = 0) -> Column:
    """The two words of a draw as a struct of longs a and b."""
    return _folded(seed, counter, stream, lambda s: s)


def uniform(seed: Column | int, counter: Column | int, stream: Column | int = 0) -> Column:
    """A double strictly between 0 and 1."""
    unused = 32 - BITS // 2

    def joined(s: Column) -> Column:
        high, low = F.shiftright(s["a"], unused), F.shiftright(s["b"], unused)
        return ((high * F.lit(1 << (BITS // 2)) + low).cast("double") + 0.5) * F.lit(2.0**-BITS)

    return _folded(seed, counter, stream, joined)


def between(low: float, high: float, u: Column) -> Column:
    """A uniform number between two bounds."""
    return F.lit(low) + F.lit(high - low) * u


def _horner(x, coefficients, lit=lambda c: c):
    total = lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + lit(c)
    return total


def inverse_normal(p: Column) -> Column:
    """The number below which a standard normal one lies with probability p."""

    def tail(q: Column) -> Column:
        root = F.sqrt(F.lit(-2.0) * F.ln(q))
        return _horner(root, TAIL_UP, F.lit) / _horner(root, TAIL_DOWN, F.lit)

    gap = p - F.lit(0.5)
    square = gap * gap
    middle = _horner(square, MIDDLE_UP, F.lit) * gap / _horner(square, MIDDLE_DOWN, F.lit)
    return F.when(p < TAIL, tail(p)).when(p > 1.0 - TAIL, -tail(F.lit(1.0) - p)).otherwise(middle)


def normals(seed: Column | int, n: Column | int, stream: Column | int = 0) -> Column:
    """An array of n standard normal numbers, of the counters from 0."""
    size = F.lit(n) if isinstance(n, int) else n
    places = F.when(size > 0, F.sequence(F.lit(0).cast("long"), size.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.transform(places, lambda i: uniform(seed, i, stream)), inverse_normal)


def noisy(values: Column, sigma: float, seed: Column | int, stream: Column | int = 0) -> Column:
    """Pixels of 0 to 255 with normal noise, added as 32-bit floats, clipped and cut to whole numbers."""
    noise = F.transform(normals(seed, F.size(values), stream), lambda z: (z * F.lit(sigma)).cast("float"))
    return F.zip_with(values, noise, lambda x, z: F.floor(F.greatest(F.lit(0.0).cast("float"), F.least(F.lit(255.0).cast("float"), x.cast("float") + z))).cast("int"))


# --- the same in numpy ----------------------------------------------------------------------------------------------


def word_arrays(seed: int | np.ndarray, counters: np.ndarray, stream: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Both words of each counter, of one seed or of one for each counter."""
    mask, half = np.uint64(WORD), np.uint64(32)
    if isinstance(seed, int):
        seed = np.uint64(seed & (1 << 64) - 1)
    seed = seed.astype(np.uint64)
    first, second = seed & mask, seed >> half
    keys = (first, second, first ^ second ^ np.uint64(PARITY))
    a = ((np.asarray(counters).astype(np.uint64) & mask) + first) & mask
    b = np.broadcast_to((np.uint64(stream & WORD) + second) & mask, a.shape)
    for i in range(ROUNDS):
        turn = ROTATIONS[i % len(ROTATIONS)]
        a = (a + b) & mask
        b = (((b << np.uint64(turn)) | (b >> np.uint64(32 - turn))) & mask) ^ a
        if i % 4 == 3:
            at = (i + 1) // 4
            a, b = (a + keys[at % 3]) & mask, (b + keys[(at + 1) % 3] + np.uint64(at)) & mask
    return a, b


def uniforms(seed: int, counters: np.ndarray, stream: int = 0) -> np.ndarray:
    a, b = word_arrays(seed, counters, stream)
    unused = np.uint64(32 - BITS // 2)
    return (((a >> unused) << np.uint64(BITS // 2)) + (b >> unused)).astype(float) * 2.0**-BITS + 2.0 ** -(BITS + 1)


def inverse_normals(p: np.ndarray) -> np.ndarray:
    gap = p - 0.5
    square = gap * gap
    out = _horner(square, MIDDLE_UP) * gap / _horner(square, MIDDLE_DOWN)
    for side, sign, q in ((p < TAIL, 1.0, p), (p > 1.0 - TAIL, -1.0, 1.0 - p)):
        root = np.sqrt(-2.0 * np.log(q[side]))
        out[side] = sign * (_horner(root, TAIL_UP) / _horner(root, TAIL_DOWN))
    return out


class Stream:
    """Draws of one seed and stream, one counter after the other, with the methods that image kernels ask of a generator."""

    def __init__(self, seed: int, stream: int = 0):
        self.seed, self.stream, self.at = int(seed), stream, 0

    def _next(self, n: int) -> np.ndarray:
        self.at += n
        return uniforms(self.seed, np.arange(self.at - n, self.at), self.stream)

    def random(self) -> float:
        return float(self._next(1)[0])

    def uniform(self, low: float, high: float) -> float:
        return low + (high - low) * self.random()

    def normal(self, mean: float, sigma: float, shape: tuple[int, ...]) -> np.ndarray:
        return (mean + sigma * inverse_normals(self._next(prod(shape)))).reshape(shape)


# --- the same in SQL ------------------------------------------------------------------------------------------------


def words_sql(source: str, seed: str, counter: str, stream: str = "0") -> str:
    """SQL: the rows of a table expression with both words, a and b, of a draw each."""
    keys = f"SELECT *, ({seed})::BIGINT & {WORD} AS k0, (({seed})::BIGINT >> 32) & {WORD} AS k1, ({counter})::BIGINT & {WORD} AS c0, ({stream})::BIGINT & {WORD} AS c1 FROM {source}"
    out = f"SELECT *, xor(xor(k0, k1), {PARITY}) AS k2, (c0 + k0) & {WORD} AS a, (c1 + k1) & {WORD} AS b FROM ({keys})"
    for i in range(ROUNDS):
        turn, at = ROTATIONS[i % len(ROTATIONS)], (i + 1) // 4
        out = f"SELECT * REPLACE ((a + b) & {WORD} AS a, xor(((b << {turn}) | (b >> {32 - turn})) & {WORD}, (a + b) & {WORD}) AS b) FROM ({out})"
        if i % 4 == 3:
            out = f"SELECT * REPLACE ((a + k{at % 3}) & {WORD} AS a, (b + k{(at + 1) % 3} + {at}) & {WORD} AS b) FROM ({out})"
    return out


def uniform_sql(a: str = "a", b: str = "b") -> str:
    unused = 32 - BITS // 2
    return f"(((({a} >> {unused}) * {1 << (BITS // 2)} + ({b} >> {unused}))::DOUBLE + '0.5'::DOUBLE) * '{2.0**-BITS!r}'::DOUBLE)"


def inverse_normal_sql(p: str) -> str:
    def lit(c: float) -> str:
        return f"'{c!r}'::DOUBLE"

    def horner(x: str, coefficients: tuple[float, ...]) -> str:
        total = lit(coefficients[0])
        for c in coefficients[1:]:
            total = f"({total} * {x} + {lit(c)})"
        return total

    def tail(q: str) -> str:
        root = f"sqrt({lit(-2.0)} * ln({q}))"
        return f"({horner(root, TAIL_UP)} / {horner(root, TAIL_DOWN)})"

    gap = f"({p} - {lit(0.5)})"
    square = f"({gap} * {gap})"
    middle = f"({horner(square, MIDDLE_UP)} * {gap} / {horner(square, MIDDLE_DOWN)})"
    return f"CASE WHEN {p} < {lit(TAIL)} THEN {tail(p)} WHEN {p} > {lit(1.0 - TAIL)} THEN -{tail(f'({lit(1.0)} - {p})')} ELSE {middle} END"
