"""String rules shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, with the two invisible characters that arrive with copied ids.
SPACE = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
EDGES = rf"^{SPACE}+|{SPACE}+$"


def strip(c: Column | str) -> Column:
    """Without surrounding white space of any kind; null stays null."""
    return F.regexp_replace(c if isinstance(c, Column) else F.col(c), EDGES, "")


def blank_to_null(c: Column | str) -> Column:
    """Null where the text is null, empty or white space only; otherwise stripped."""
    s = strip(c)
    return F.when(s != "", s)


def canonical_id(c: Column | str) -> Column:
    """Ids compare upper case without surrounding white space; a blank id is null."""
    return F.upper(blank_to_null(c))


def canonical_word(c: Column | str) -> Column:
    """Statuses, types and the like compare lower case without surrounding white space."""
    return F.lower(strip(c))


def canonical_hash(c: Column | str) -> Column:
    """Hashes compare trimmed, lower case and without algorithm prefix; blank is null."""
    return blank_to_null(F.regexp_replace(F.lower(strip(c)), rf"^sha-?(256|512|1){SPACE}*:{SPACE}*", ""))


def canonical_extension(c: Column | str) -> Column:
    """Extensions compare trimmed, lower case and without leading dot; null counts as empty."""
    return F.coalesce(F.regexp_replace(F.lower(strip(c)), r"^\.+", ""), F.lit(""))
