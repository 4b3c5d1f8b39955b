"""Exact random counts as column expressions: hypergeometric and binomial, by inversion.

A count is found from one uniform number by walking outward from the mode: mode,
mode + 1, mode - 1, mode + 2, ..  Neighbouring probabilities follow from their
ratio, so no factorial is needed; a first walk adds up the weights, a second takes
them from ``u`` times their sum until it is used up.  The state is a few numbers,
and a walk has about 9 standard deviations of steps on each side; what lies beyond
weighs less than the resolution of ``u``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Resolution of a uniform number: 13 hex digits.
RESOLUTION = 1 << 52


def uniform_sql(*parts: str) -> str:
    """A number in [0, 1) from the SHA-256 of the parts, joined by colons; any SQL engine can repeat it."""
    text = ", ':', ".join(f"CAST({p} AS STRING)" for p in parts)
    return f"(CAST(conv(substring(sha2(concat({text}), 256), 1, 13), 16, 10) AS DOUBLE) / {RESOLUTION}.0D)"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _walk(law: str, low: str, high: str, mode: str, deviation: str, up: str, down: str, u: str) -> str:
    """``up`` and ``down`` are the ratios of the weights at ``x + 1`` and ``x - 1`` to the one at ``x``; they are 0 at the support's ends.

    ``a`` and ``b`` are the weights of the places that the next step visits.
    """
    higher, lower = (f"(s.{w} * {r})" for w, r in (("a", up.replace("{x}", "(m.mode + i)")), ("b", down.replace("{x}", "(m.mode - i)"))))
    start = f"'a', {up.replace('{x}', 'm.mode')}, 'b', {down.replace('{x}', 'm.mode')}"
    weight = f"""aggregate(steps, named_struct('sum', 1.0D, {start}),
                 (s, i) -> named_struct('sum', s.sum + s.a + s.b, 'a', {higher}, 'b', {lower}), s -> s.sum)"""
    return let("q", law, let("m", f"""named_struct('mode', greatest({low}, least({high}, {mode})), 'far', least({high} - {low}, CAST(9 * {deviation} + 12 AS BIGINT)))""",
             let("steps", "CASE WHEN m.far > 0 THEN sequence(1L, m.far) ELSE CAST(array() AS ARRAY<BIGINT>) END", f"""
      aggregate(steps, named_struct('left', {u} * {weight} - 1.0D, 'x', m.mode, {start}),
        (s, i) -> CASE WHEN s.left < 0 THEN s
                       WHEN s.left < s.a THEN named_struct('left', -1.0D, 'x', m.mode + i, 'a', s.a, 'b', s.b)
                       WHEN s.left < s.a + s.b THEN named_struct('left', -1.0D, 'x', m.mode - i, 'a', s.a, 'b', s.b)
                       ELSE named_struct('left', s.left - s.a - s.b, 'x', s.x, 'a', {higher}, 'b', {lower}) END,
        s -> s.x)""")))


def hypergeometric_sql(total: str, good: str, drawn: str, u: str) -> str:
    """How many of ``drawn`` rows, taken from ``total`` without replacement, are among the ``good`` ones."""
    law = f"named_struct('n', CAST({total} AS DOUBLE), 'g', CAST({good} AS DOUBLE), 'd', CAST({drawn} AS DOUBLE))"
    return _walk(
        law, "CAST(greatest(0, q.d + q.g - q.n) AS BIGINT)", "CAST(least(q.g, q.d) AS BIGINT)", "CAST(floor((q.d + 1) * (q.g + 1) / (q.n + 2)) AS BIGINT)",
        "sqrt(q.d * q.g / greatest(q.n, 1) * (q.n - q.g) / greatest(q.n, 1) * (q.n - q.d) / greatest(q.n - 1, 1))",
        "((q.g - {x}) * (q.d - {x}) / (({x} + 1) * (q.n - q.g - q.d + {x} + 1)))",
        "({x} * (q.n - q.g - q.d + {x}) / ((q.g - {x} + 1) * (q.d - {x} + 1)))", u)


def binomial_sql(draws: str, good: str, total: str, u: str) -> str:
    """How many of ``draws`` rows, taken from ``total`` with replacement, are among the ``good`` ones."""
    law = f"named_struct('d', CAST({draws} AS DOUBLE), 'g', CAST({good} AS DOUBLE), 'r', CAST({total} AS DOUBLE) - {good}, 'n', CAST({total} AS DOUBLE))"
    return _walk(
        law, "0L", "CAST(q.d AS BIGINT)", "CAST(floor((q.d + 1) * q.g / greatest(q.n, 1)) AS BIGINT)",
        "sqrt(q.d * q.g / greatest(q.n, 1) * q.r / greatest(q.n, 1))",
        "((q.d - {x}) * q.g / (({x} + 1) * greatest(q.r, 1e-300D)))",
        "({x} * q.r / ((q.d - {x} + 1) * greatest(q.g, 1e-300D)))", u)


def hypergeometric(total: str, good: str, drawn: str, *key: str) -> Column:
    """``hypergeometric_sql`` of columns, drawn for the key given by SQL expressions."""
    return F.expr(hypergeometric_sql(total, good, drawn, uniform_sql(*key)))


def _descent(start: str, replace: bool, pair: bool, *key: str) -> str:
    """Halve the ranks of ``start`` (low, size, held, k, h) until one is left, or for a ``pair`` until k and k + 1 part.

    ``held`` sampled rows lie in the range; ``h`` is their number in its lower
    half where the pair parts, else -1.
    """
    u = uniform_sql(*key, "s.low", "s.size")
    half = "(s.size div 2)"
    count = binomial_sql("s.held", half, "s.size", u) if replace else hypergeometric_sql("s.size", half, "s.held", u)
    lower = f"named_struct('low', s.low, 'size', {half}, 'held', t, 'k', s.k, 'h', -1L)"
    upper = f"named_struct('low', s.low + {half}, 'size', s.size - {half}, 'held', s.held - t, 'k', s.k - t, 'h', -1L)"
    parted = "WHEN s.k = t THEN named_struct('low', s.low, 'size', s.size, 'held', s.held, 'k', s.k, 'h', t)" if pair else ""
    return f"""aggregate(sequence(1, 63), {start},
        (s, level) -> CASE WHEN s.size <= 1 OR s.h >= 0 THEN s ELSE {let('t', count, f'CASE {parted} WHEN s.k <= t THEN {lower} ELSE {upper} END')} END)"""


def _range(low: str, size: str, held: str, k: str) -> str:
    return f"named_struct('low', CAST({low} AS BIGINT), 'size', CAST({size} AS BIGINT), 'held', CAST({held} AS BIGINT), 'k', CAST({k} AS BIGINT), 'h', -1L)"


def sample_rank(total: str, drawn: str, k: str, replace: bool, *key: str) -> Column:
    """The rank (from 1) in a population of ``total`` rows of the ``k``-th smallest of ``drawn`` sampled ones.

    The ranks are halved again and again; at each half the number of sampled
    rows in its lower part is one hypergeometric (with replacement: binomial)
    count, drawn for the key and the range, so all ``k`` of a key see one
    sample.  About the base-2 logarithm of ``total`` counts are drawn.
    """
    return F.expr(f"{_descent(_range('0', total, drawn, k), replace, False, *key)}.low + 1")


def sample_middle_ranks(total: str, drawn: str, replace: bool, *key: str) -> Column:
    """Array of the one or two ranks that the median of such a sample needs, as ``sample_rank`` gives them.

    Two ranks share their way down to where they part.
    """
    one = f"{_descent(_range('0', total, drawn, f'({drawn} + 1) div 2'), replace, False, *key)}.low + 1"
    below = _descent(_range("z.low", "z.size div 2", "z.h", "z.h"), replace, False, *key)
    above = _descent(_range("z.low + z.size div 2", "z.size - z.size div 2", "z.held - z.h", "1"), replace, False, *key)
    two = let("z", _descent(_range("0", total, drawn, f"{drawn} div 2"), replace, True, *key),
              f"CASE WHEN z.h < 0 THEN array(z.low + 1, z.low + 1) ELSE array({below}.low + 1, {above}.low + 1) END")
    return F.expr(f"CASE WHEN {drawn} % 2 = 1 THEN array({one}) ELSE {two} END")
