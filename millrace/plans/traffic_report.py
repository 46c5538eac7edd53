"""Traffic job: quota, canary, screening and cache facts, then outcomes, from logged requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import ServingLimits
from millrace.operators import requests, traffic


def outcomes(log: DataFrame, canary_percent: int, limits: ServingLimits = ServingLimits()) -> DataFrame:
    """Classify logged requests.

    ``log`` has client, ts, request_id and the logged facts except ``quota_ok``
    and ``variant``, which follow from the policies. Only requests that got as
    far as the quota check use up quota.
    """
    reached = F.col("authorized") & F.col("valid") & ~F.col("too_large")
    marked = log.withColumn("_reached", F.coalesce(reached, F.lit(False)))
    limited = traffic.quota(marked, limits, within=["_reached"]).select(
        *log.columns, (~F.col("_reached") | F.col("allowed")).alias("quota_ok")
    )
    return requests.classify(limited.withColumn("variant", traffic.variant(F.col("client"), canary_percent)))
