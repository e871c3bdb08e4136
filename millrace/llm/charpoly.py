"""Exact characteristic polynomials of whole-number symmetric matrices, their real roots, and null vectors.

The polynomial is computed modulo many primes (Hessenberg form, then the recurrence of its leading
minors), one prime at a time in Spark tasks, and put together by the Chinese remainder theorem.
As the matrix is symmetric all roots are real, so by Descartes' rule the sign changes of the
polynomial moved by t count the roots above t exactly, repeated ones as often; bisection on a grid finer
than the wanted digits isolates them. Eigenvectors come from inverse iteration in decimal
arithmetic of as many digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PRIME_BITS = 31
ROOT_BITS = 100  # digits of a root, in bits
DECIMAL_DIGITS = 90
GAP_BITS = 60  # roots closer than so many bits count as one, and share a basis


def _is_prime(n: int) -> bool:
    odd = n - 1
    twos = (odd & -odd).bit_length() - 1
    odd >>= twos
    for a in (2, 3, 5, 7):  # these decide all numbers below 3 * 10**9
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(product: int) -> list[int]:
    """The largest primes below 2**31 whose product is above the number."""
    out, n, have = [], (1 << PRIME_BITS) - 1, 1
    while have <= product:
        if _is_prime(n):
            out.append(n)
            have *= n
        n -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo a prime below 2**31, constant term first."""
    h = np.array(matrix % p, np.int64)
    d = len(h)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        at = m + int(below[0])
        if at != m:
            h[[at, m]] = h[[m, at]]
            h[:, [at, m]] = h[:, [m, at]]
        times = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - times[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * times % p).sum(axis=1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, np.int64)
        new[1:] = minors[k - 1, :-1]
        new = (new - h[k - 1, k - 1] * minors[k - 1]) % p
        # What column k adds from each row above, times the entries below the diagonal between them.
        factors, chain = np.zeros(k, np.int64), 1
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            factors[i] = int(h[i, k - 1]) * chain % p
        minors[k] = (new - (factors[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), constant term first, for a positive semidefinite whole-number matrix."""
    d, trace = len(matrix), int(np.trace(matrix))
    # The sums of products of k roots are largest when all roots are equal.
    bound = max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    moduli = primes(2 * bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_mod(matrix, p).tolist() for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "c"])

    rows = spark.createDataFrame([(p,) for p in moduli], "p bigint").repartition(min(len(moduli), 64))
    by = dict(rows.mapInArrow(residues, "p bigint, c array<bigint>").collect())
    whole = math.prod(moduli)
    out = [0] * (d + 1)
    for p in moduli:
        rest = whole // p
        part = rest * pow(rest, -1, p)
        for k, c in enumerate(by[p]):
            out[k] += part * c
    return [c - whole if (c := total % whole) > whole // 2 else c for total in out]


def roots_above(polynomial: list[int], t: int) -> int:
    """How many roots lie above t, for a polynomial whose roots are all real."""
    moved = polynomial[::-1]
    d = len(moved) - 1
    for i in range(d if t else 0):
        for k in range(1, d - i + 1):
            moved[k] += t * moved[k - 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], count: int) -> tuple[list[int], int]:
    """(grid numbers g, s): the largest positive roots r, falling, with g <= r * 2**s < g + 1 or just below, each of ``ROOT_BITS`` bits or more."""
    d = len(polynomial) - 1
    count = min(count, roots_above(polynomial, 0))
    top = max(-polynomial[d - 1], 1) if d else 1  # the sum of the roots
    shift = max(0, ROOT_BITS - top.bit_length())
    while count:
        scaled = [c << shift * (d - k) for k, c in enumerate(polynomial)]
        seen: dict[int, int] = {}

        def above(t: int) -> int:
            if t not in seen:
                seen[t] = roots_above(scaled, t)
            return seen[t]

        found = []
        for i in range(count):
            lo = max((t for t, n in seen.items() if n > i), default=0)
            hi = min((t for t, n in seen.items() if n <= i), default=(top << shift) + 1)
            while hi - lo > 1:
                middle = (lo + hi) // 2
                lo, hi = (middle, hi) if above(middle) > i else (lo, middle)
            found.append(lo)
        missing = ROOT_BITS - found[-1].bit_length()
        if missing <= 0:
            return found, shift
        shift += missing
    return [], 0


def eigenvectors(matrix: np.ndarray, roots: list[int], shift: int) -> list[list[float]]:
    """Unit vectors to double precision for falling roots on the grid of ``largest_roots``; the largest entry is positive.

    Vectors of roots that count as one are made orthogonal.
    """
    d = len(matrix)
    found: list[list[Decimal]] = []
    with localcontext(Context(prec=DECIMAL_DIGITS)):
        whole = [[Decimal(int(v)) for v in row] for row in matrix]
        for number, g in enumerate(roots):
            # Half a grid step beside the root's cell: never an exact root, so the system can be solved.
            root = (Decimal(2 * g + 1) / 2) / (Decimal(2) ** shift)
            lower, order = _decomposed(whole, root)
            same = [found[j] for j in range(number) if abs(roots[j] - g).bit_length() <= g.bit_length() - GAP_BITS]
            v = _unit([Decimal(1 + (7 + 13 * number) * (i + 1) ** 2 % 101) for i in range(d)], same)
            for _ in range(50):
                new = _unit(_solved(lower, order, v), same)
                sign = 1 if sum(a * b for a, b in zip(new, v)) >= 0 else -1
                moved = max(abs(a * sign - b) for a, b in zip(new, v))
                v = [a * sign for a in new]
                if moved < Decimal(10) ** -25:
                    break
            found.append(v)
        turned = [[float(a) for a in v] for v in found]
    return [[a if max(v, key=abs) > 0 else -a for a in v] for v in turned]


def _unit(v: list[Decimal], beside: list[list[Decimal]]) -> list[Decimal]:
    for _ in range(2):  # the second turn removes what rounding left
        for w in beside:
            along = sum(a * b for a, b in zip(v, w))
            v = [a - along * b for a, b in zip(v, w)]
        size = sum(a * a for a in v).sqrt()
        v = [a / size for a in v]
    return v


def _decomposed(whole: list[list[Decimal]], root: Decimal) -> tuple[list[list[Decimal]], list[int]]:
    """Triangular factors of matrix - root in one table, and the order of the rows."""
    a = [[v - root if i == j else v for j, v in enumerate(row)] for i, row in enumerate(whole)]
    order = list(range(len(a)))
    least = max(abs(v) for row in a for v in row) * Decimal(10) ** (5 - DECIMAL_DIGITS) or Decimal(1)
    for k in range(len(a)):
        at = max(range(k, len(a)), key=lambda i: abs(a[i][k]))
        a[k], a[at], order[k], order[at] = a[at], a[k], order[at], order[k]
        if abs(a[k][k]) < least:
            a[k][k] = least
        for i in range(k + 1, len(a)):
            if a[i][k]:
                times = a[i][k] / a[k][k]
                a[i] = [*a[i][:k], times, *(x - times * y for x, y in zip(a[i][k + 1 :], a[k][k + 1 :]))]
    return a, order


def _solved(lower: list[list[Decimal]], order: list[int], v: list[Decimal]) -> list[Decimal]:
    d = len(lower)
    x = [v[i] for i in order]
    for i in range(d):
        x[i] -= sum((lower[i][j] * x[j] for j in range(i)), Decimal(0))
    for i in range(d - 1, -1, -1):
        x[i] = (x[i] - sum((lower[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / lower[i][i]
    return x
