"""Text helpers for rules and their messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything a printable string literal has to escape, apart from the plain space.
_UNPRINTABLE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def is_blank(text: Column) -> Column:
    """Null, empty, or nothing but whitespace of any script.

    Most texts start with a plain visible character and skip the pattern.
    """
    return text.isNull() | (~F.ascii(text).between(33, 126) & text.rlike(r"(?U)\A[\s\x1c-\x1f]*\z"))


def quoted(text: Column) -> Column:
    """The text as a quoted literal with escapes, as messages show it."""
    body = F.regexp_replace(text, r"\\", r"\\\\")
    both = text.contains("'") & text.contains('"')
    body = F.when(both, F.replace(body, F.lit("'"), F.lit("\\'"))).otherwise(body)
    mark = F.when(text.contains("'") & ~text.contains('"'), F.lit('"')).otherwise(F.lit("'"))

    def escaped(char: Column) -> Column:
        code = F.ascii(char)
        digits = F.lower(F.hex(code))
        return (
            F.when(~char.rlike(_UNPRINTABLE), char)
            .when(char == "\n", F.lit("\\n"))
            .when(char == "\r", F.lit("\\r"))
            .when(char == "\t", F.lit("\\t"))
            .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
        )

    spelled = F.when(
        body.rlike(_UNPRINTABLE), F.array_join(F.transform(F.split(body, ""), escaped), "")
    ).otherwise(body)
    return F.when(text.isNull(), F.lit("None")).otherwise(F.concat(mark, spelled, mark))
