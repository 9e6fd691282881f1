"""Scoring a stream of new items against fixed seed-set parameters.

The reference has no streaming. Since the era adjustment, the cosine score's raw similarity
and the blend are stateless expressions over per-set parameters, a ``readStream`` frame can be
scored with the same code: the parameters are a static frame joined on ``set_id``
(stream-static join), and no state is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import attach
from seedrank.operators import era as E


def score_stream(stream: DataFrame, scaler: DataFrame, target: DataFrame, era: DataFrame,
                 features: Sequence[str], year: str = "release_year", key: str = "set_id") -> DataFrame:
    """Adds cosine_similarity, year_adjustment and stream_score = similarity·(1 − adj/100).
    ``scaler`` (m_*, s_*), ``target`` (t_*) and ``era`` are one-row-per-set static frames."""
    # static one-row-per-set parameters: size-checked broadcast (stream-static joins)
    s = E.apply_era(attach(attach(stream, scaler, key), target, key), era, year, key)
    z = [X.standardized(F.coalesce(F.col(f), F.lit(0.0)), F.col(f"m_{f}"), F.col(f"s_{f}")) for f in features]
    s = s.withColumn("cosine_similarity", X.cosine(z, [F.col(f"t_{f}") for f in features]))
    return s.withColumn("stream_score", E.apply_adjustment(F.col("cosine_similarity"), F.col("year_adjustment")))
