"""Rule quality over event time, on batch or streaming tables (an addition of ours).

Matching and predicting are stateless projections and run unchanged on streams; this is the one operator with state:
one counter pair per rule and window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.functions.premise import quoted
from premisa.operators.matching import _rules, matching_ids
from premisa.roles import label_text


def rule_drift(
    df: DataFrame, ruleset, label: str, ts: str, window: str = "1 day", watermark: str | None = None
) -> DataFrame:
    """(window_start, rule_id, p, n, precision); with a watermark late windows are closed and dropped."""
    rules = _rules(ruleset)
    # Event time must be an instant: zone-less timestamps are read in the session's zone.
    df = df.withColumn(ts, quoted(ts).cast("timestamp"))
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    concluded = F.element_at(F.array(*[F.lit(r.label) for r in rules]), F.col("rule_id"))
    hits = df.select(
        quoted(ts).alias("ts"), label_text(df, label).alias("y"), F.explode(matching_ids(df, rules)).alias("rule_id")
    )
    right = F.coalesce(F.col("y") == concluded, F.lit(False))
    counts = hits.groupBy(F.window("ts", window).alias("w"), "rule_id").agg(
        F.count(F.when(right, 1)).alias("p"), F.count(F.when(~right, 1)).alias("n")
    )
    return counts.select(
        F.col("w.start").alias("window_start"), "rule_id", "p", "n", (F.col("p") / (F.col("p") + F.col("n"))).alias("precision")
    )
