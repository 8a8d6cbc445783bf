"""String expressions with the semantics of the rules: Unicode classes, ``\\n`` as the only line end."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[\\s\\x1c-\\x1f]"
#: The signs that ``(?U)SPACE`` matches, one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def rule(pattern: str, *, start: bool = False, nocase: bool = False, multiline: bool = False, dotall: bool = False) -> str:
    """A rule's regex for Spark; ``start`` anchors it at the start of the text."""
    flags = "dU" + "i" * nocase + "m" * multiline + "s" * dotall
    return f"(?{flags})" + (f"\\A(?:{pattern})" if start else pattern)


def strip(c: Column) -> Column:
    """Trim white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def strip_chars(c: Column, chars: str) -> Column:
    cls = "[" + "".join(f"\\x{ord(x):02x}" for x in chars) + "]"
    return F.regexp_replace(c, f"\\A{cls}+|{cls}+\\z", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"(?U){SPACE}+", " "))


def running_sums(sizes: Column) -> Column:
    """For each of an array's integers the sum of those before it, in one pass."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(sizes, zero, lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))["out"]


def has_any(c: Column, words) -> Column:
    """Whether any of the words is a substring."""
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def normalized_title(c: Column) -> Column:
    # The title rule's numbering, "and", signs left out, and the name of an empty title.
    t = F.regexp_replace(c, "(?U)^\\d+(?:\\.\\d+)*\\s*", "")
    t = F.replace(F.lower(t), F.lit("&"), F.lit(" and "))
    t = F.replace(F.regexp_replace(t, "(?U)[^\\w\\s-]", ""), F.lit("-"), F.lit(" "))
    t = F.regexp_replace(F.regexp_replace(t, "(?U)\\s+", "_"), "_+", "_")
    t = F.regexp_replace(t, "^_|_$", "")
    return F.when(t == "", "section").otherwise(t)


def document_code(stem: Column) -> Column:
    t = F.upper(F.regexp_replace(F.regexp_replace(stem, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.when(t == "", "DOCUMENT").otherwise(t)


def slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def csv_row(cells: Column) -> Column:
    """One CSV line with minimal quoting; a lone empty cell is quoted."""
    quote = lambda x: F.when(x.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
    return F.when((F.size(cells) == 1) & (F.get(cells, F.lit(0)) == ""), F.lit('""')).otherwise(F.array_join(F.transform(cells, quote), ","))


def csv_lines(c: Column) -> Column:
    return F.split(c, "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]", -1)


def without(c: Column, part: str) -> Column:
    return F.replace(c, F.lit(part), F.lit(""))


def sorted_set(c: Column) -> Column:
    """The different values of an array without nulls, in order; ``array_sort`` has a lambda, below which Spark compiles nothing and shares no parts."""
    return F.sort_array(F.array_distinct(c))


def words(c: Column) -> Column:
    """Number of words between white space."""
    t = strip(c)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, f"(?U){SPACE}+")))
