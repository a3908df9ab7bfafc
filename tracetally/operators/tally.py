"""Exact distinct counts of several columns in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tally(
    rows: DataFrame,
    by: Mapping[str, Column],
    distinct: Mapping[str, str | Mapping[str, Column | None]],
    sums: Mapping[str, Column] | None = None,
    largest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Group ``rows`` and count distinct values of several columns exactly.

    ``by``        result name -> key; empty for one overall row.
    ``distinct``  column -> result name, or column -> {result name: condition or None}, where a
                  value counts for every condition that holds on at least one of its rows.
    ``sums``      result name -> number to add up (NULL if a group has only NULLs).
    ``largest``   result name -> string whose greatest value is wanted.

    NULLs are not counted but keep their group alive. Several ``count_distinct`` in one ``agg``
    would make a copy of every row per expression, with all columns in the key, and a string
    maximum would turn the aggregation into sorts. Here each row gives one slim
    (key, slot, value) record per counted *column*: conditions on the same column share it as
    flags, and sums ride on the first slot, so name the column with the fewest values first.
    The records collapse before the shuffle, which spreads by value, so neither a few periods nor
    one hot key or value gathers rows in one task; only per-key counts meet in the second shuffle.
    """
    sums, largest = dict(sums or {}), dict(largest or {})
    slots: list[tuple[Column, list[Column]]] = []
    counts: dict[str, Column] = {}
    labels: dict[str, Column] = {}

    def in_slot(slot: int) -> Column:
        return F.when(F.col("_slot") == slot, F.col("_value"))

    for column, results in distinct.items():
        slot, value, flags = len(slots), F.col(column).cast("string"), []
        wanted = {results: None} if isinstance(results, str) else dict(results)
        ((name, condition), *others) = wanted.items()
        if condition is not None and not others:
            # A lone condition can blank the other values instead of travelling as a flag.
            value, wanted = F.when(condition, value), {name: None}
        for name, condition in wanted.items():
            if condition is None:
                counts[name] = F.count(in_slot(slot))
            else:
                counts[name] = F.count(F.when(F.col(f"_flag{len(flags)}"), in_slot(slot)))
                flags.append(condition)
        slots.append((value, flags))
    for name, text in largest.items():
        labels[name] = in_slot(len(slots))
        slots.append((text, []))

    # Keys, values, flags and numbers are worked out once per row, before the row is multiplied.
    flat = rows.select(
        *[key.alias(name) for name, key in by.items()],
        *[value.alias(f"_value{s}") for s, (value, _) in enumerate(slots)],
        *[flag.alias(f"_flag{s}_{i}") for s, (_, fs) in enumerate(slots) for i, flag in enumerate(fs)],
        *[number.cast("bigint").alias(name) for name, number in sums.items()],
    )
    width = max(len(flags) for _, flags in slots)
    records = [
        F.struct(
            F.lit(s).cast("tinyint").alias("_slot"),
            F.col(f"_value{s}").alias("_value"),
            *[
                (F.col(f"_flag{s}_{i}") if i < len(flags) else F.lit(None).cast("boolean"))
                .alias(f"_flag{i}")
                for i in range(width)
            ],
            *[
                (F.col(name) if s == 0 else F.lit(None).cast("bigint")).alias(name)
                for name in sums
            ],
        )
        for s, (_, flags) in enumerate(slots)
    ]
    values = flat.select(*by, F.inline(F.array(*records)))
    # NULLs count nowhere; those of the first slot stay, for its sums and to keep the group.
    values = values.where((F.col("_slot") == 0) | F.col("_value").isNotNull())
    carried = [F.max(f"_flag{i}").alias(f"_flag{i}") for i in range(width)]
    carried += [F.sum(name).alias(name) for name in sums]
    # The first shuffle: one record per key, column and value.
    values = values.groupBy(*by, "_slot", "_value").agg(*carried) if carried else values.distinct()

    totals = [count.alias(name) for name, count in counts.items()]
    totals += [F.sum(name).alias(name) for name in sums]
    if not labels:
        return values.groupBy(*by).agg(*totals)
    # A hash aggregate cannot keep a string maximum, so that waits until few rows are left.
    few = values.groupBy(*by, *[c.alias(name) for name, c in labels.items()]).agg(*totals)
    return few.groupBy(*by).agg(
        *[F.max(name).alias(name) for name in labels],
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        *[F.sum(name).alias(name) for name in sums],
    )
