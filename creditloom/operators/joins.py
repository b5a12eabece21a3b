"""Left joins of per-key tables to the applicant table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_features(app: DataFrame, *tables: DataFrame | None, key: str, check_keys: bool = False) -> DataFrame:
    """Left-join each table on ``key``; ``None`` is skipped and unmatched applicants get nulls.

    The tables hold one row per key, as the aggregation leaves them, already partitioned by the
    join key: each costs no further shuffle, and the applicant side is shuffled once for all joins.
    No broadcast is asked for; Spark broadcasts a side only below its size limit. ``check_keys``
    proves the one-row rule with a job per table.
    """
    for table in tables:
        if table is None:
            continue
        if check_keys and not table.groupBy(key).count().filter("count > 1").isEmpty():
            raise ValueError(f"more than one row per {key}")
        clash = (set(app.columns) & set(table.columns)) - {key}
        if clash:
            raise ValueError(f"columns on both sides: {sorted(clash)}")
        app = app.join(table, key, "left")
    return app


def columns_added(before: DataFrame, after: DataFrame) -> int:
    """How many columns a join or a feature step added."""
    return len(after.columns) - len(before.columns)


def history_coverage(app: DataFrame, children: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Per child table: applicants, how many have no row in it, and their share."""
    marks = {
        name: child.groupBy(key).agg(F.lit(True).alias(f"_has_{i}"))
        for i, (name, child) in enumerate(children.items())
    }
    joined = join_features(app.select(key), *marks.values(), key=key)
    counts = joined.agg(
        F.count(F.lit(1)).alias("applicants"),
        *[F.count_if(F.col(f"_has_{i}").isNull()).alias(f"_none_{i}") for i in range(len(marks))],
    )
    entry = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("child"), F.col(f"_none_{i}").alias("without_history"))
                for i, name in enumerate(marks)
            ]
        )
    )
    return counts.select("applicants", entry.alias("e")).select(
        "e.child",
        "applicants",
        "e.without_history",
        F.try_divide(F.col("e.without_history").cast("double"), F.col("applicants").cast("double")).alias(
            "share"
        ),
    )
