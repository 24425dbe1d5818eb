"""Building blocks of SQL expressions. Everything they produce runs inside the JVM.

Helpers for scalar features return SQL text for ``selectExpr`` and ``F.expr``; a whole feature list
is then one projection that Spark analyses once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts: str) -> str:
    """Microseconds since the epoch; also accepts zone-less timestamps (read as session time)."""
    return f"unix_micros(cast({ts} as timestamp))"


def floor_to(us: str, width: str | int) -> str:
    """Start of the time slot of ``width`` microseconds that holds ``us`` (also before 1970)."""
    return f"({us} - pmod({us}, cast({width} as bigint)))"


def slots(first: str, last: str, width: str | int) -> str:
    """Array of the starts of all time slots touched by [first, last]."""
    return f"sequence({floor_to(first, width)}, {floor_to(last, width)}, cast({width} as bigint))"


def or_zero(value: str) -> str:
    return f"coalesce(cast({value} as double), 0D)"


def ratio(numerator: str, denominator: str) -> str:
    """Quotient as double; 0 where the denominator is 0 or either side is null."""
    return or_zero(f"try_divide(cast({numerator} as double), cast({denominator} as double))")


def clamp01(value: str) -> str:
    return f"greatest(0D, least(1D, {value}))"


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def hash32(*parts: str) -> str:
    """First 32 bits of md5 over the parts joined by '|', as a bigint in [0, 2^32)."""
    text = f"md5(concat_ws('|', {', '.join(parts)}))"
    return f"cast(conv(substring({text}, 1, 8), 16, 10) as bigint)"


def uniform(*parts: str) -> str:
    """A double in (0, 1) that depends on the parts only, so on no partitioning or task order."""
    return f"(({hash32(*parts)} + 0.5D) / 4294967296D)"


def code_to_name(code: str, names_to_codes: dict[str, int]) -> str:
    pairs = ", ".join(f"{number}, '{name}'" for name, number in names_to_codes.items())
    return f"try_element_at(map({pairs}), cast({code} as int))"


def name_to_code(name: str, names_to_codes: dict[str, int]) -> str:
    pairs = ", ".join(f"'{key}', {number}" for key, number in names_to_codes.items())
    return f"try_element_at(map({pairs}), {name})"
