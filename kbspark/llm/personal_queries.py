"""p5: personal information in content and summary."""

from __future__ import annotations

from kbspark.llm.personal import detect, occurrences
from kbspark.sources.tables import table


def _detected(spark, folder):
    return detect(table(spark, folder, "semantic_output"))


QUERIES = {
    "p5_found": lambda spark, folder: occurrences(_detected(spark, folder)),
    "p5_redacted": lambda spark, folder: _detected(spark, folder).select("source_id", "redacted_content", "redacted_summary").distinct(),
}
ORACLES: dict[str, str] = {}
