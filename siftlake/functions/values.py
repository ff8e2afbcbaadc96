"""JSON values as text: one string carries both the type and the content.

``to_json`` of a variant prints strings in quotes, numbers bare, and a JSON
null as ``null``; an absent field is SQL NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The printed forms of null, "", false, empty list, empty object and zero.
_EMPTY_FORMS = ["null", '""', "false", "[]", "{}", "0", "0.0", "-0.0"]


def after_blanks(text: Column) -> Column:
    """JSON text from its first character that is no white space."""
    return F.ltrim(text, F.lit(" \t\n\r"))


def field(document: Column, name: str) -> Column:
    """One top-level field of a variant, as a variant."""
    return F.variant_get(document, "$['" + name.replace("'", "\\'") + "']", "variant")


def field_json(document: Column, name: str) -> Column:
    """One top-level field as JSON text; NULL only when the field is absent."""
    return F.to_json(field(document, name))


def is_truthy(json_text: Column) -> Column:
    return json_text.isNotNull() & ~json_text.isin(*_EMPTY_FORMS)


def first_truthy(*json_texts: Column) -> Column:
    """``a or b or c``: the first non-empty value, else the last one as it is."""
    *early, last = json_texts
    return F.coalesce(*[F.when(is_truthy(text), text) for text in early], last)


def is_string(json_text: Column) -> Column:
    return json_text.startswith('"')


def is_object(json_text: Column) -> Column:
    return json_text.startswith("{")


def string_content(json_text: Column) -> Column:
    """The characters of a JSON string, unescaped only when it has escapes."""
    return F.when(
        is_string(json_text),
        F.when(
            json_text.contains("\\"),
            F.try_variant_get(F.try_parse_json(json_text), "$", "string"),
        ).otherwise(F.substring(json_text, F.lit(2), F.length(json_text) - 2)),
    )


def is_empty_object(json_text: Column) -> Column:
    """True for ``{}`` with any inner or outer blanks."""
    return json_text.rlike(r"\A\s*\{\s*\}\s*\z")
