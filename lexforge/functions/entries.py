"""Key-value entry lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_string(text: Column) -> Column:
    """A JSON string literal, quotes included, with everything escaped that JSON requires."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.char_length(listed) - 2)


def entry_line(hash_key: Column, sort_key: Column, payload: Column, field: str = "data") -> Column:
    """One put request per line, ending in a comma; ``payload`` is itself JSON, held as a string."""
    # The request layout, blanks included.
    return F.concat(
        F.lit('{"PutRequest": {"Item": {"hk": {"S": '), json_string(hash_key),
        F.lit('},"sk": {"S": '), json_string(sort_key),
        F.lit('},"' + field + '": {"S": '), json_string(payload),
        F.lit("}}}},"),
    )
