"""The per-row decision projection under Structured Streaming equals batch."""

import tempfile

from pyspark.sql import functions as F

from retentio.plans import jobs as J
from retentio.sources import fixture
from retentio.streaming.live_scoring import decision_stream, start_to_table

from .conftest import SF_SMALL


def test_stream_matches_batch(spark):
    raw = fixture.subscribers(spark, SF_SMALL)
    lab = J.labeled(raw)
    model = J.fit_models(lab)
    src = tempfile.mkdtemp(prefix="retentio-stream-src-", dir="/tmp")
    raw.write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(raw.schema).parquet(src + "/in")
    out, ckpt = src + "/out", src + "/ckpt"
    q = start_to_table(decision_stream(stream, model), out, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = J.decision_table(J.scored(lab, model, test_only=False))
    cols = ["customerID", "churn_prob", "reason_1", "intervention_type", "should_intervene"]
    g = sorted(tuple(r) for r in got.select(*cols).withColumn("churn_prob", F.round("churn_prob", 9)).collect())
    w = sorted(tuple(r) for r in want.select(*cols).withColumn("churn_prob", F.round("churn_prob", 9)).collect())
    assert g == w and len(g) == raw.count()
