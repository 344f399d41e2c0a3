"""p6: token ids of the whole corpus."""

from __future__ import annotations

from kbspark.llm.tokens import decode_corpus, encode_corpus
from kbspark.sources.tables import table


def _ids(spark, folder):
    return encode_corpus(table(spark, folder, "documents"), spark)


QUERIES = {
    "p6_ids": _ids,
    "p6_decoded": lambda spark, folder: decode_corpus(_ids(spark, folder), spark),
}
ORACLES = {"p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
