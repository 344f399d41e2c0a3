"""p7: sources mixed to target weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbspark.llm.mixing import mix, shares
from kbspark.llm.tokens import token_counts
from kbspark.sources.tables import table


def _mix(spark, folder, **more):
    return mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), spark, **more)


def _whole(spark, folder):
    """As many tokens as the corpus has: small sources can't reach their share within their cap."""
    docs = table(spark, folder, "documents")
    whole = token_counts(docs, spark).agg(F.sum("tokens").alias("t")).first()["t"]
    return shares(_mix(spark, folder, total_tokens=float(whole or 0)), table(spark, folder, "mix_targets"))


QUERIES = {
    "p7_mix": _mix,
    "p7_shares": lambda spark, folder: shares(_mix(spark, folder), table(spark, folder, "mix_targets")),
    "p7_shares_whole": _whole,
}
ORACLES: dict[str, str] = {}
