"""p8: abusive, hateful or sexual content."""

from __future__ import annotations

from kbspark.llm.toxicity import source_rates, toxic_documents, toxicity
from kbspark.sources.tables import table


def _scores(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    "p8_found": lambda spark, folder: toxic_documents(_scores(spark, folder)),
    "p8_scores": _scores,
    "p8_source_rates": lambda spark, folder: source_rates(_scores(spark, folder)),
}
ORACLES: dict[str, str] = {}
