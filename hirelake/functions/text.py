"""Scalar text expressions; all of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of Unicode white space at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def json_list(c: Column | str) -> Column:
    """JSON list text -> array<string>; malformed or non-list text gives NULL."""
    return F.from_json(col(c), "array<string>")


def json_list_malformed(c: Column | str) -> Column:
    """True where the text is present but cannot be read as a list."""
    return col(c).isNotNull() & json_list(c).isNull()


def to_json_list(c: Column | str) -> Column:
    """array<string> -> JSON list text with ', ' between the items."""
    quoted = F.transform(col(c), lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1))
    return F.when(col(c).isNotNull(), F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def url_core(c: Column | str) -> Column:
    """URL without its query string."""
    return F.split_part(col(c), F.lit("?"), F.lit(1))


def absolute_url(c: Column | str, host: str) -> Column:
    """Prefix the host unless the link is absolute already; an empty link stays empty."""
    c = col(c)
    return F.when((c == "") | c.startswith("http"), c).otherwise(F.concat(F.lit(host), c))


def url_number(c: Column | str) -> Column:
    """The number in '.../<number>.html', or the whole URL."""
    found = F.regexp_extract(col(c), r"/(\d+)\.html", 1)
    return F.when(found == "", col(c)).otherwise(found)


def last_path_part(c: Column | str) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def first_int(c: Column | str, default: int | None = None) -> Column:
    """First run of digits as an int."""
    n = F.regexp_extract(col(c), r"(\d+)", 1).try_cast("int")
    return n if default is None else F.coalesce(n, F.lit(default))


def remove_text(c: Column | str, part: Column | str) -> Column:
    """Remove every occurrence of ``part``."""
    part = F.lit(part) if isinstance(part, str) else part
    return F.replace(col(c), part, F.lit(""))


def thousands(c: Column | str) -> Column:
    return F.format_number(col(c), 0)


def whole_seconds(c: Column | str) -> Column:
    """Crawl times are kept to the second."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")


def tokens(c: Column | str) -> Column:
    """Lower-case letter/digit runs of the whole text, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(f"({TOKEN})"), 1)


def point_id(c: Column | str) -> Column:
    """MD5 of an id in UUID spelling: the stable key of an index point."""
    return F.regexp_replace(
        F.md5(col(c).cast("string")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def or_none(c: Column | str) -> Column:
    """Text of a value, 'None' for NULL."""
    return F.coalesce(col(c).cast("string"), F.lit("None"))


def profile_lines(answer: Column | str, fallback: Column | str) -> tuple[Column, Column]:
    """Read the 'YOE: ..' and 'QUERY: ..' lines of a profile answer.

    Reading goes line by line and stops at a YOE line without a number; the last line read wins.
    Years default to 0 and the query to ``fallback`` (the candidate's own text).
    """
    text = col(answer)
    lines = F.split(strip(text), "\n")
    bad = F.array_position(
        F.transform(lines, lambda x: x.startswith("YOE:") & ~x.rlike(r"\d")), F.lit(True)
    ).cast("int")
    read = F.when(bad > 0, F.slice(lines, 1, F.greatest(bad - 1, F.lit(0)))).otherwise(lines)
    yoe = F.try_element_at(F.filter(read, lambda x: x.startswith("YOE:")), F.lit(-1))
    query = F.try_element_at(F.filter(read, lambda x: x.startswith("QUERY:")), F.lit(-1))
    return (
        first_int(yoe, 0),
        F.coalesce(strip(remove_text(query, "QUERY:")), col(fallback)),
    )
