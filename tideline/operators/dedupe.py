"""Keep one row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedupe_latest(
    df: DataFrame,
    key: Sequence[str],
    version: Sequence[Column | str] = (),
    copies: str | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """The newest row of every key.

    Rows compare by ``version``, then by all their other columns, so rows that
    still tie are equal and the survivor does not depend on the partitioning.
    Columns without an order (maps, variants) compare by their JSON text. NULL keys
    are equal to each other. ``copies`` names an optional column with the number
    of rows the key had. ``carried`` columns are known for one row of a key at most and
    are taken from it, whichever row is the newest.

    It is an aggregate, so every task keeps one row per key before the shuffle
    and a key that holds a large part of the table costs one row per task. Spark
    sorts by key for a struct-valued maximum, which is cheap on flattened records:
    they come as runs that are sorted already.
    """
    own = [name for name in df.columns if name not in {*key, *carried}]
    first = [v for v in version if isinstance(v, str) and v in own]
    ordered = [
        F.col(v) if isinstance(v, str) else v.alias(f"_version_{i}")
        for i, v in enumerate(version)
        if not isinstance(v, str) or v in own
    ]
    rest = [name for name in own if name not in first]
    if all(_orderable(df.schema[name].dataType) for name in own):
        newest = F.max(F.struct(*ordered, *rest))
    else:
        texts = [
            F.col(n) if _orderable(df.schema[n].dataType) else F.to_json(n).alias(f"_text_{n}")
            for n in rest
        ]
        newest = F.max_by(F.struct(*own), F.struct(*ordered, *texts))
    measures = [newest.alias("_newest")]
    measures += [F.any_value(F.col(name), F.lit(True)).alias(name) for name in carried]
    if copies:
        measures.append(F.count(F.lit(1)).alias(copies))
    winners = df.groupBy(*key).agg(*measures)
    return winners.select(
        *(
            F.col(name)
            if name in {*key, *carried}
            else F.col("_newest")[name].alias(name)
            for name in df.columns
        ),
        *([copies] if copies else []),
    )


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys alone, once each."""
    return df.select(*key).distinct()
