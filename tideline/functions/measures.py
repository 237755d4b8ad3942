"""Rounded aggregates that do not depend on how the rows were partitioned.

A sum of doubles changes in its last digits with the order of the additions, and a
rounded result can flip with it. So every double is first a whole number of units, cut into
three limbs of 21 bits, which add up exactly in longs, in any order, for 2**42 rows a
group. A row costs arithmetic of doubles and longs; decimals occur once a group.

A value below 2**33 is the nearest multiple of ``10**-scale``. A larger one is taken as the
double it is, in units of its window, a range of nine binary exponents; NaN and the
infinities have a window that counts them. Rows are first added up by group and
windows, which is one row a group unless it has such values; then the windows of a group
are added in their order. No row is treated by what else its group holds.

The mean is the exact sum divided by the count, to nine places, then rounded to the
published digits; where a group has values of 2**33 and more the sum ends as a double. Whole
numbers are cut alike for the mean, and add up as longs, with Spark's overflow error, for
the sum.

Expressions are SQL text over generated names: building hundreds of column objects takes
the driver longer than a small summary takes the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

BITS = 21
LIMBS = ("_high", "_middle", "_low")
#: Binary exponent from which a value counts in a window, and exponents of a window.
WIDE, WINDOW = 33, 9
#: The window of what is not finite, which counts NaN, infinity and its negative by limb.
ODD = 127

#: The names a declaration may use.
AGGREGATIONS = ("avg", "sum", "max")


def is_binary_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def rounded(total: str, divisor: str | None, digits: int) -> str:
    """A decimal, divided if it is a mean, half up to the published digits."""
    return f"double(round({total if divisor is None else f'{total} / {divisor}'}, {digits}))"


@dataclass(frozen=True)
class WholeNumber:
    """A column of whole numbers, cut into limbs."""

    index: int

    def _name(self, part: str) -> str:
        return f"{part}_{self.index}"

    @property
    def limb_names(self) -> list[str]:
        return [self._name(name) for name in LIMBS]

    def steps(self, value: str) -> list[dict[str, str]]:
        """Columns a row gets one step after the other; those of the last are summed up."""
        return [{}, {self._name("_whole"): f"bigint({value})"}]

    def limbs(self) -> list[str]:
        whole, mask = self._name("_whole"), f"{(1 << BITS) - 1}L"
        cut = (
            f"shiftright({whole}, {2 * BITS})",
            f"shiftright({whole}, {BITS}) & {mask}",
            f"{whole} & {mask}",
        )
        return [f"sum({c}) AS {name}" for name, c in zip(self.limb_names, cut, strict=True)]

    def total(self, scale: int = 0) -> str:
        """The exact sum as a decimal, from summed limbs."""
        unit = Decimal(1).scaleb(-scale)
        terms = (
            f"CAST({name} AS DECIMAL(20,0)) * {unit * (1 << k * BITS):f}BD"
            for name, k in zip(self.limb_names, (2, 1, 0), strict=True)
        )
        return f"CAST({' + '.join(terms)} AS DECIMAL(38,9))"


@dataclass(frozen=True)
class Double(WholeNumber):
    """A column of doubles as whole numbers of units, and the window that says which."""

    scale: int

    @property
    def window(self) -> str:
        return self._name("_window")

    def steps(self, value: str) -> list[dict[str, str]]:
        ones, tenth = self._name("_ones"), 10**self.scale
        near, finite = f"abs({value}) < {2.0**WIDE!r}D", f"abs({value}) < double('inf')"
        # One bit more than a double has below the window: the logarithm may be rounded.
        window = f"floor((log2(abs({value})) - {WIDE}) / {WINDOW}) + 1"
        return [
            {ones: f"floor({value})"},
            {
                self._name("_whole"): f"""CASE
                    WHEN {near} THEN {ones} * {tenth}L + floor(({value} - {ones}) * {tenth}D + 0.5D)
                    WHEN {finite} THEN
                      floor({value} / pow(2D, ({window} - 1) * {WINDOW} + {WIDE - 53}))
                    WHEN isnan({value}) THEN 1L
                    WHEN {value} > 0 THEN {1 << BITS}L
                    WHEN {value} < 0 THEN {1 << 2 * BITS}L END""",
                self.window: f"""tinyint(CASE WHEN {near} OR {value} IS NULL THEN 0
                    WHEN {finite} THEN {window} ELSE {ODD} END)""",
            },
        ]

    def split(self) -> list[str]:
        """The sums of one window: exact ones if it is that below 2**33, else a double."""
        high, middle, low = (f"double({name})" for name in self.limb_names)
        units = f"({high} * {2.0 ** (2 * BITS)!r}D + ({middle} * {2.0**BITS!r}D + {low}))"
        wide = f"""CASE WHEN {self.window} = 0 THEN NULL
            WHEN {self.window} < {ODD}
              THEN {units} * pow(2D, ({self.window} - 1) * {WINDOW} + {WIDE - 53})
            WHEN {low} > 0 OR ({middle} > 0 AND {high} > 0) THEN double('nan')
            WHEN {middle} > 0 THEN double('inf') ELSE double('-inf') END"""
        near = [f"CASE WHEN {self.window} = 0 THEN {n} END AS {n}" for n in self.limb_names]
        return [*near, f"{wide} AS {self.wide}"]

    @property
    def wide(self) -> str:
        return self._name("_wide")
