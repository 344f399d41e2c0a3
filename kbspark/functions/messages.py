"""Rules on free text that is shown or logged, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kbspark.functions.titles import plain_url

#: Links in text, signs that end a sentence after one, secrets in messages, signs of what no longer holds, names in Markdown links.
URL = r"https?://[^\s<>\"']+"
URL_END = r"[).,;:!?，。；：！？\]}]+$"
MESSAGE_SECRET = r"(?i)(api[_-]?key|authorization|bearer|token|secret)\s*[:=]?\s*\S+"
STALE = r"废止|已失效|停止使用|已停用|不再适用|有效期(?:至|截止)"
MARKDOWN_LINK = r"!?\[([^\]]+)\]\([^)]*\)"


def plain_urls(text: Column) -> Column:
    """A text whose signed links have lost their queries; signs after a link stay."""
    links = F.regexp_extract_all(text, F.lit(f"({URL})"), 1)
    rest = F.split(text, URL)

    def plain(link: Column) -> Column:
        bare = F.regexp_replace(link, URL_END, "")
        return F.concat(plain_url(bare), F.substring(link, F.length(bare) + 1, F.length(link)))

    return F.array_join(F.transform(rest, lambda t, i: F.concat(t, F.coalesce(plain(F.get(links, i)), F.lit("")))), "")


def safe_message(text: Column, most: int = 1000) -> Column:
    """A message without links and secrets, cut to length."""
    t = F.regexp_replace(text, r"https?://\S+", "[URL]")
    return F.substring(F.regexp_replace(t, MESSAGE_SECRET, "$1=[REDACTED]"), 1, most)


def safe_name(name: Column, most: int = 90) -> Column:
    """A name that can be a file's: no control characters, slashes, colons, edges of white space or final dots; 未命名 where nothing is left."""
    t = F.regexp_replace(F.trim(F.regexp_replace(name, r"[\x00-\x1f/:]", "_")), r"\.+$", "")
    return F.rtrim(F.substring(F.when(t == "", "未命名").otherwise(t), 1, most))


def inline_text(text: Column, most: int = 180) -> Column:
    """A text for one cell of a table: white space collapsed, no bars, cut to length; empty for null."""
    return F.substring(F.replace(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), F.lit("|"), F.lit("｜")), 1, most)


def json_list(text: Column) -> Column:
    """Items of a JSON array as texts; of other JSON none; a text that is no JSON is one item; null and empty none."""
    items = F.from_json(text, "array<string>")
    value = F.try_parse_json(text)
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).when(value.isNull(), F.array(text)).otherwise(F.coalesce(items, F.array().cast("array<string>")))


def fingerprint(**fields: Column) -> Column:
    """SHA-256 of the fields by name, in the order of names, as JSON; null fields count as empty texts."""
    return F.sha2(F.to_json(F.struct(*[F.coalesce(c.cast("string"), F.lit("")).alias(k) for k, c in sorted(fields.items())])), 256)


def _visible(text: str) -> str:
    return "".join(c.casefold() for c in unicodedata.normalize("NFKC", text).replace("\\", "") if c.isalnum())


@F.pandas_udf(StringType())
def visible_characters(text: pd.Series) -> pd.Series:
    """Letters and digits of a text in their plain forms, case folded; in Arrow batches, since no built-in function normalises."""
    return text.map(_visible, na_action="ignore")


def last_lines(text: Column) -> Column:
    """The lines of a text from the last to the first, without marks of Markdown."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r]"), lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), MARKDOWN_LINK, "$1"), r"^[#>*+\-\d.\s]+", ""))
    return F.reverse(lines)
