"""Text expressions: splitting a delimited line, trimming, the header test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. A line that starts with the prefix is a header, wherever it stands.
HEADER_PREFIX = "EmployeeID"
FIELD_COUNT = 5

# The characters Python counts as white space, as the characters
# themselves (for btrim) and as a character class (for regular expressions).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)

# One field and the comma before it. A field either opens with a quote and runs
# over doubled quotes and commas to its closing quote (what follows up to the
# next comma still belongs to it), or it has no opening quote and runs to the
# next comma. Possessive, so that long fields cannot backtrack or recurse.
_FIELD = r'\G,("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+)?+|[^,]*+)'
# In a quoted field without its opening quote: a doubled quote, or the closing
# quote and the literal text after it.
_INNER_QUOTE = r'(?s)"(?:(")|(.*)\z)'


def is_header(line: Column) -> Column:
    """True for a line that starts with the header prefix (case-sensitive)."""
    return line.startswith(HEADER_PREFIX)


def strip(text: Column) -> Column:
    """Remove white space, not only blanks, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_line_end(line: Column) -> Column:
    """Remove carriage returns left at the end by files with CRLF line ends."""
    return F.when(line.endswith("\r"), F.rtrim(line, F.lit("\r"))).otherwise(line)


def unquote(field: Column) -> Column:
    """The text of one raw field: without its quotes if it opens with one."""
    inner = F.regexp_replace(F.substr(field, F.lit(2)), _INNER_QUOTE, "$1$2")
    return F.when(field.startswith('"'), inner).otherwise(field)


def raw_fields(line: Column) -> Column:
    """Split one delimited line into an array of fields as they stand, quotes included.

    Lines without a quote, nearly all of them, take a plain split. No lambda, so that
    this and ``unquote`` of the fields that are wanted stay in generated code.
    """
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def csv_fields(line: Column) -> Column:
    """Split one delimited line into an array of all its fields, unquoted."""
    raw = raw_fields(line)
    return F.when(line.contains('"'), F.transform(raw, unquote)).otherwise(raw)


def csv_line(*columns: Column) -> Column:
    """Join columns with commas, without quoting; a null counts as empty text."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
