"""Rules on text with markup, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Control and format characters, private and unassigned ones, without line end and tab.
UNSAFE = r"[\p{Cc}\p{Cf}\p{Co}&&[^\n\t]]"


def safe_characters(text: Column) -> Column:
    """Without control, format and private characters; line ends and tabs stay."""
    return F.regexp_replace(text, UNSAFE, "")


def unsafe_characters(text: Column) -> Column:
    """Every control, format and private character, with repeats."""
    return F.regexp_extract_all(text, F.lit(f"({UNSAFE})"), 1)


def headings(text: Column) -> Column:
    """The Markdown headings of a text, in order."""
    return F.regexp_extract_all(text, F.lit(r"(?:^|[\r\n])(#{1,6}[ \t]+[^\r\n]+)"), 1)


def visible_text(html: Column) -> Column:
    """Text of HTML without scripts, styles, comments and tags; the common entities read; blank lines dropped."""
    t = F.regexp_replace(html, r"(?is)<(script|style|noscript|svg|template|canvas)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)</?[A-Za-z][^<>]*>", "\n")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(t, r"[ \t]*\n\s*", "\n"))


def hit_windows(text: Column, pattern: str, before: int, after: int) -> Column:
    """Merged stretches around the matches of ``pattern``: array of (start_pos, end_pos), end exclusive, in order.

    Starts come from the lengths of what lies between matches; stretches that touch or
    overlap are merged in one pass over them.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    step = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start_pos:int,end_pos:int>>").alias("w"))

    def add(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(gaps, i))
        end = start + F.length(F.get(hits, i))
        low, high = F.greatest(start - before, F.lit(0)), F.least(end + after, F.length(text))
        last = F.get(acc["w"], F.size(acc["w"]) - 1)
        merged = F.concat(F.slice(acc["w"], 1, F.size(acc["w"]) - 1), F.array(F.struct(last["start_pos"].alias("start_pos"), F.greatest(last["end_pos"], high).alias("end_pos"))))
        fresh = F.concat(acc["w"], F.array(F.struct(low.alias("start_pos"), high.alias("end_pos"))))
        return F.struct(end.alias("at"), F.when((F.size(acc["w"]) > 0) & (low <= last["end_pos"]), merged).otherwise(fresh).alias("w"))

    n = F.size(hits)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), step, add)["w"])


def title_and_rest(text: Column) -> tuple[Column, Column]:
    """(first top heading of a Markdown text, the text without that line's heading); null and the whole text where there is none."""
    line = F.regexp_extract(text, r"(?:^|[\r\n])(#[ \t]+[^\r\n]+)", 1)
    # the heading stands at the start or after a line end
    at = F.when(F.startswith(text, line), F.lit(1)).otherwise(F.regexp_instr(text, F.lit(r"[\r\n]#[ \t]+[^\r\n]+")) + 1)
    title = F.when(line != "", F.trim(F.regexp_replace(line, r"^#[ \t]+", "")))
    rest = F.when(line != "", F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(line), F.length(text)))).otherwise(text)
    return title, rest
