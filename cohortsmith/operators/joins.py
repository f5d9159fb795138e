"""The prefix (LIKE 'x%') join as an equi join.

No join here carries a broadcast hint: Spark broadcasts a side when its size in bytes is under
``spark.sql.autoBroadcastJoinThreshold``, by its statistics or, with AQE, as measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_join(events: DataFrame, code_col: str, prefixes: DataFrame, prefix_col: str) -> DataFrame:
    """``events JOIN prefixes ON events.code LIKE prefix || '%'`` as an equi join.

    A LIKE condition forces a nested-loop join.  Instead each event is expanded to its
    prefixes of the lengths that occur in the prefix table (a handful), and joined on
    equality, which plans as a hash join.  Only the distinct prefix lengths reach the
    driver (bounded by the longest code).
    """
    lengths = sorted(r[0] for r in prefixes.select(F.length(prefix_col)).distinct().collect()
                     if r[0] is not None)
    arr = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    code = F.col(code_col)
    # only lengths up to the code's own length, so a short code is not matched twice
    expanded = events.withColumn("_prefix", F.explode(F.transform(
        F.filter(arr, lambda n: n <= F.length(code)), lambda n: F.substring(code, 1, n))))
    return expanded.join(prefixes, expanded["_prefix"] == prefixes[prefix_col]).drop("_prefix")
