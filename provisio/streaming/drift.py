"""Windowed score drift: stability index of each closed event-time window against a base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from provisio.functions.semantics import bin_index
from provisio.operators.metrics import PSI_FLOOR, bin_shares, decile_edges, psi_alert


def fit_base(base: DataFrame, c: str, n: int = 10) -> tuple[list[float], dict[int, int]]:
    edges = decile_edges(base, c, n)
    return edges, bin_shares(base, c, edges)


def window_bin_counts(stream: DataFrame, edges: Sequence[float], value: str, ts: str = "ts",
                      window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Rows per (window, score bin): a few counters of state per open window.

    Rows later than the watermark are dropped, and a window is emitted once, when it closes.
    """
    return (
        stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).filter(F.col(value).isNotNull())
        .groupBy(F.window(ts, window).alias("w"), bin_index(value, edges[1:-1]).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def window_psi(counts: DataFrame, base: dict[int, int]) -> DataFrame:
    """Stability index per window; bins without rows take part with the floor share."""
    total = float(sum(base.values()))
    n = F.sum("n").cast("double")

    def part(b: int) -> Column:
        expected = F.lit(max(base[b] / total, PSI_FLOOR))
        seen = F.greatest(F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("n"))), F.lit(0)) / n, F.lit(PSI_FLOOR))
        return (seen - expected) * F.log(seen / expected)

    parts = [part(b) for b in sorted(base)]
    psi = sum(parts[1:], parts[0])
    return (
        counts.groupBy("w").agg(F.sum("n").alias("row_count"), psi.alias("psi"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "row_count", "psi")
        .withColumn("alert", psi_alert(F.col("psi")))
    )


def drift_stream(stream: DataFrame, edges: Sequence[float], base: dict[int, int], value: str, path: str,
                 checkpoint: str, ts: str = "ts", window: str = "1 day", late: str = "1 hour") -> StreamingQuery:
    """Write the index of closed windows. All bins of a window close in the same batch; each
    batch has its own folder, so a repeated batch replaces what it wrote before."""
    def write(batch: DataFrame, batch_id: int) -> None:
        window_psi(batch, base).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    counts = window_bin_counts(stream, edges, value, ts, window, late)
    return (
        counts.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
