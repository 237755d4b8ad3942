"""Declared summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.measures import Double, WholeNumber, is_binary_float, rounded
from tideline.specs import GoldSpec, Measure


class _Source:
    """A column that measures read: its value, and how it is cut if it has to be."""

    def __init__(self, name: str, index: int, kind: T.DataType, spec: GoldSpec) -> None:
        self.name, self.value, self.count = name, f"_value_{index}", f"_count_{index}"
        self.max, self.sum = f"_max_{index}", f"_sum_{index}"
        self.wanted = {m.aggregation for m in spec.measures.values() if m.source_column == name}
        self.cut: WholeNumber | None = None
        if is_binary_float(kind) or not isinstance(kind, T.NumericType):
            self.cut = Double(index, spec.scale) if self.wanted - {"max"} else None
        elif isinstance(kind, T.IntegralType) and "avg" in self.wanted:
            self.cut = WholeNumber(index)

    @property
    def read(self) -> str:
        return f"double({self.value})" if isinstance(self.cut, Double) else self.value

    def own_sum(self, aggregation: str) -> bool:
        """Whether Spark's sum is exact: that of decimals, and of whole numbers as longs."""
        return self.cut is None or (aggregation == "sum" and not isinstance(self.cut, Double))

    def aggregates(self) -> list[str]:
        found = [f"count({self.value}) AS {self.count}"]
        if "max" in self.wanted:
            found.append(f"max({self.value}) AS {self.max}")
        if any(self.own_sum(a) for a in self.wanted - {"max"}):
            found.append(f"sum({self.value}) AS {self.sum}")
        return found + (self.cut.limbs() if self.cut else [])

    def again(self) -> list[str]:
        """The same over rows that are sums already."""
        found = [f"sum({self.count}) AS {self.count}"]
        if "max" in self.wanted:
            found.append(f"max({self.max}) AS {self.max}")
        if any(self.own_sum(a) for a in self.wanted - {"max"}):
            found.append(f"sum({self.sum}) AS {self.sum}")
        names = self.cut.limb_names if self.cut else []
        if isinstance(self.cut, Double):
            names = [*names, self.cut.wide]
        return found + [f"sum({n}) AS {n}" for n in names]

    def split(self) -> list[str]:
        """The columns of ``aggregates``, with the sums of a window told apart."""
        found = [text.rpartition(" ")[2] for text in self.aggregates()]
        if isinstance(self.cut, Double):
            found = [name for name in found if name not in self.cut.limb_names] + self.cut.split()
        return found

    def published(self, m: Measure, spec: GoldSpec) -> str:
        if m.aggregation == "max":
            return f"round({self.max}, {spec.digits})"
        divisor = f"nullif({self.count}, 0)" if m.aggregation == "avg" else None
        if self.own_sum(m.aggregation):
            if divisor is None:
                return f"round({self.sum}, {spec.digits})"
            return rounded(self.sum, divisor, spec.digits)
        if not isinstance(self.cut, Double):
            return rounded(self.cut.total(), divisor, spec.digits)
        total, wide = self.cut.total(spec.scale), self.cut.wide
        both = rounded(f"(coalesce(double({total}), 0D) + {wide})", divisor, spec.digits)
        exact = rounded(total, divisor, spec.digits)
        return f"CASE WHEN {wide} IS NULL THEN {exact} ELSE {both} END"


def aggregate(silver: DataFrame, spec: GoldSpec) -> DataFrame:
    """Group by the declared keys and compute every declared measure.

    Rows are added up by group and windows (see ``functions.measures``), by hash on both
    sides of a shuffle that carries one partial row per task and group; a second, smaller
    one brings the windows of a group together, of which there is one unless values of 2**33
    and more occur.
    """
    names = dict.fromkeys(m.source_column for m in spec.measures.values())
    sources = {
        name: _Source(name, i, silver.schema[name].dataType, spec) for i, name in enumerate(names)
    }
    rows = silver.select(
        *spec.keys, *(F.col(name).alias(source.value) for name, source in sources.items())
    )
    cut = [source for source in sources.values() if source.cut]
    windows = [s.cut.window for s in cut if isinstance(s.cut, Double)]
    for step in zip(*(s.cut.steps(s.read) for s in cut), strict=True):
        added = [f"{text} AS {name}" for part in step for name, text in part.items()]
        rows = rows.selectExpr("*", *added)
    first = [text for source in sources.values() for text in source.aggregates()]
    sums = rows.groupBy(*spec.keys, *windows).agg(*map(F.expr, first))
    if windows:
        again = [text for source in sources.values() for text in source.again()]
        split = [text for source in sources.values() for text in source.split()]
        # Doubles are added in the order of the windows, which is the same in every run.
        sums = (
            sums.repartition(*spec.keys)
            .sortWithinPartitions(*spec.keys, *windows)
            .select(*spec.keys, *map(F.expr, split))
            .groupBy(*spec.keys)
            .agg(*map(F.expr, again))
        )
    return sums.select(
        *spec.keys,
        *(
            F.expr(sources[m.source_column].published(m, spec)).alias(output)
            for output, m in spec.measures.items()
        ),
    )
