"""Rules on names, words and links, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What marks a version in a name, and ids of projects and tickets.
VERSION_MARK = r"(?i)新版|旧版|最新版|修订|替代|取代|废止|失效|沿用|v\s*\d+(?:\.\d+)*|version\s*\d+(?:\.\d+)*"
VERSION_SUFFIX = r"(?i)[-_｜| ]?(?:v(?:er(?:sion)?)?\s*\d+(?:\.\d+)*|新版|旧版|最新版|修订版|最终版|草稿版|\d{4}[-_/]\d{1,2}[-_/]\d{1,2})"
BUSINESS_IDS = (r"(?i)\bPRJ[-_ ]?\d{3,}[A-Z]?\b", r"(?i)\b(?:TICKET|WORK|BUG|REQ)[-_]?\d{3,}\b", r"\b[A-Z]{2,10}[-_/]\d{3,}(?:[-_/]\d+)?\b")
STABLE_ID = r"(?i)\b[A-Z][A-Z0-9_-]{1,20}-[A-F0-9]{12}\b"
NODE_LINK = r"https?://[^\s/]+/(?:i/)?(?:nodes|spaces)/([A-Za-z0-9_-]+)"
TITLE_CITED = "(?:依据|参照|按照|详见|见|引用|遵循)[ \\t]*[《“\"]([^》”\"\\n]{2,100})[》”\"]"
#: Query keys of links that are signed for a short time.
SIGNED_KEYS = ("accesskeyid", "ossaccesskeyid", "signature", "expires", "security-token", "x-oss-security-token", "x-oss-signature", "x-oss-credential", "token", "access_token")
#: Secrets in text: label, pattern, replacement.
SECRETS = (
    ("password", r"(?i)((?:访问)?密码|password|passcode)(\s*[:：=]\s*)([^\s,，;；。]{3,})", "$1$2[REDACTED]"),
    ("token", r"(?i)(api[_ -]?key|access[_ -]?token|refresh[_ -]?token|secret|bearer)(\s*[:：=]?\s*)([A-Za-z0-9_./+\-=]{6,})", "$1$2[REDACTED]"),
    ("private key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----", "[REDACTED PRIVATE KEY]"),
)


def stable_id(prefix: str, workspace: Column, node: Column) -> Column:
    """PREFIX- and the first 12 hex digits of the hash of workspace and node, upper case; null without node."""
    return F.concat(F.lit(prefix + "-"), F.upper(F.substring(F.sha2(F.concat(workspace, F.lit(":"), node), 256), 1, 12)))


def folded(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def title_key(name: Column) -> Column:
    """A file name without extension, id, version and date, folded: the same for versions of one document."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^./\\]*$", "")
    stem = F.regexp_replace(stem, r"(?i)\[[A-Z][A-Z0-9_-]+-[A-F0-9]{12}\]", "")
    return folded(F.regexp_replace(stem, VERSION_SUFFIX, ""))


def words(text: Column) -> Column:
    """Latin words, numbers of two digits or more, and pairs of neighbouring Han characters, with repeats."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z][a-z0-9_-]{1,}|\d{2,}|[\u4e00-\u9fff]{2,})"), 1)
    pairs = F.transform(found, lambda w: F.when(w.rlike(r"^[\u4e00-\u9fff]{3,}$"), F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2)))).otherwise(F.array(w)))
    return F.flatten(pairs)


def business_ids(text: Column) -> Column:
    """Distinct project and ticket ids, upper case without blanks."""
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), 0) for p in BUSINESS_IDS])
    return F.array_distinct(F.transform(found, lambda x: F.replace(F.upper(x), F.lit(" "), F.lit(""))))


def plain_url(url: Column) -> Column:
    """A link without query and fragment where its query is signed for a short time; else as it is."""
    keys = F.transform(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1))))
    signed = F.arrays_overlap(keys, F.array(*[F.lit(k) for k in SIGNED_KEYS]))
    return F.when(signed, F.regexp_replace(url, r"[?#].*$", "")).otherwise(url)


def without_secrets(text: Column) -> tuple[Column, Column]:
    """(text with secrets replaced, labels of what was there)."""
    labels = []
    for label, pattern, put in SECRETS:
        labels.append(F.when(text.rlike(pattern), F.lit(label)))
        text = F.regexp_replace(text, pattern, put)
    return text, F.array_compact(F.array(*labels))


def clean_list(items: Column, most: int = 30, longest: int = 500) -> Column:
    """Items with white space collapsed, blanks and repeats dropped, cut to length and number."""
    one = F.transform(items, lambda x: F.substring(F.trim(F.regexp_replace(x, r"\s+", " ")), 1, longest))
    return F.slice(F.array_distinct(F.filter(one, lambda x: x.isNotNull() & (x != ""))), 1, most)
