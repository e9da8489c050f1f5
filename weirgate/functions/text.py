"""Expressions over text: delimited lines, names, globs and trailers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _field(delimiter: str, quote: str) -> str:
    d, q = re.escape(delimiter), re.escape(quote)
    return f"(?:{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}|[^{q}{d}][^{d}]*+|)"


def well_formed(line: Column, delimiter: str = ",", quote: str = '"') -> Column:
    """Whether a line is a record: no open quote, nothing after a closing one."""
    f = _field(delimiter, quote)
    return line.rlike(rf"(?s)\A{f}(?:{re.escape(delimiter)}{f})*+\z")


def tokens(line: Column, delimiter: str = ",", quote: str = '"') -> Column:
    """The fields of a well-formed line, unquoted; a blank line has none."""
    raw = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(f"(?s){re.escape(delimiter)}({_field(delimiter, quote)})"), 1)
    plain = F.transform(raw, lambda t: F.when(t.startswith(quote), F.replace(t.substr(F.lit(2), F.length(t) - 2), F.lit(quote * 2), F.lit(quote))).otherwise(t))
    return F.when(blank(line), F.array().cast("array<string>")).otherwise(plain)


def blank(line: Column) -> Column:
    return line == ""


def clean_name(name: Column) -> Column:
    """One path segment: not empty, no dots only, none of / \\ % and no control characters."""
    return F.coalesce(~name.isin("", ".", "..") & ~name.rlike(r"[/\\%\x00-\x1f\x7f]"), F.lit(False))


def glob_pattern(glob: str) -> str:
    """A shell pattern as an anchored regular expression of the engine."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            negated, body = ("^", body[1:]) if body[0] == "!" else ("", body)
            out.append(f"[{negated}{body.replace('^', chr(92) + '^')}]")
            i = close
        else:
            out.append(re.escape(c))
        i += 1
    return rf"(?s)\A{''.join(out)}\z"


def matches_glob(name: Column, glob: str) -> Column:
    return F.coalesce(name.rlike(glob_pattern(glob)), F.lit(False))


def slug(name: Column) -> Column:
    """A path as one segment: / becomes --."""
    return F.replace(name, F.lit("/"), F.lit("--"))


def unslug(name: Column) -> Column:
    """The path of a slug; of a run of three dashes the first belongs to the name."""
    return F.replace(F.regexp_replace(name, "---", "-/"), F.lit("--"), F.lit("/"))


def received_stamp(at: Column) -> Column:
    """A time of receipt as it stands in object paths."""
    return F.date_format(at, "yyyyMMdd'T'HHmmssSSSSSS'Z'")


def object_prefix(root: str, feed_id: Column, at: Column, delivery_id: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), feed_id, F.lit("/received_at="), received_stamp(at), F.lit("/dl-"), delivery_id, F.lit("/"))


def split_uri(uri: Column) -> Column:
    """(bucket, key) of an object address; null parts if it is none."""
    part = lambda i: F.nullif(F.regexp_extract(uri, r"\A[a-z][a-z0-9+.-]*://([^/]+)/(.+)\z", i), F.lit(""))
    return F.struct(part(1).alias("bucket"), part(2).alias("key"))


def is_batch_uuid(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"), F.lit(False))


def last_line(text: Column) -> Column:
    """The last line that is not blank, or null."""
    lines = F.filter(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: ~x.rlike(r"\A\s*\z"))
    return F.get(lines, F.size(lines) - 1)


def identifier(text: str) -> str:
    """A dotted table name with each part quoted; anything else is refused."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*", text):
        raise ValueError(f"{text!r} is no table name")
    return ".".join(f"`{p}`" for p in text.split("."))
