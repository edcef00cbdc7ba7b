"""The decision table on a stream of subscriber snapshots.

Cleaning, feature rules, scorecard scoring (stream-static broadcast joins
against the fitted weights), reason codes, valuation and the intervention
policy are all per-row projections, so the same operators run unchanged
under Structured Streaming. Nothing here keeps state. The portfolio-level
steps (thresholds, quantile segments, capacity routing) need the whole
table and stay batch jobs over the sink's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import RetentionPolicy
from ..operators.scorecard import Scorecard
from ..plans import jobs as J


def decision_stream(raw_stream: DataFrame, model: Scorecard,
                    policy: RetentionPolicy = RetentionPolicy(), profile: str = "v2") -> DataFrame:
    """Streaming DataFrame of decision rows for incoming raw subscriber rows."""
    eng = J.labeled(raw_stream, profile)
    sc = J.scored(eng, model, test_only=False)
    return J.decision_table(sc, policy)


def start_to_table(stream: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append decision rows to a Parquet table; the checkpoint folder (shared
    storage) makes the query restartable after a driver or executor loss."""
    w = (stream.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
