"""Rows of JSON lines: validity, schema label, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE_SPACE
from ..functions.detect import _escaped

_STRIPPED = f"btrim({{}}, '{_escaped(WHITE_SPACE)}')"


def variant_path(key: str) -> str:
    """JSON path of a top-level key with any characters but both kinds of quotes."""
    if "'" in key and '"' in key:
        raise ValueError("a key with both kinds of quotes cannot be addressed")
    quote = '"' if '"' not in key else "'"
    return f"$[{quote}{key}{quote}]"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _field(name: str, of: str = "v") -> str:
    return f"try_variant_get({of}, {_literal(variant_path(name))}, 'variant')"


def parsed(rows: DataFrame, value: str = "value") -> DataFrame:
    """rows with line (without its line end), empty_line, v (the object, or null) and json_error.

    Spark's parser ignores what follows a value.  So a line is parsed as the first element of an array of two, whose second
    one is the line's own hash: only a single value leaves the array with just these two.
    """
    line = F.rtrim(F.make_valid_utf8(F.col(value)), F.lit("\r\n"))
    out = rows.withColumn("line", line).withColumn("empty_line", F.col("line") == "").withColumn("__mark", F.xxhash64("line"))
    out = out.withColumn("__pair", F.expr("if(empty_line or not ltrim(' \t\r', line) like '{%', null, try_parse_json(concat('[', line, ',', __mark, ']')))"))
    single = "try_variant_get(__pair, '$[1]', 'bigint') <=> __mark and try_variant_get(__pair, '$[2]', 'variant') is null"
    out = out.withColumn("v", F.expr(f"if({single}, try_variant_get(__pair, '$[0]', 'variant'), null)")).drop("__pair", "__mark")
    return out.withColumn("json_error", ~F.col("empty_line") & F.col("v").isNull())


def is_array(x: str) -> str:
    return f"coalesce(schema_of_variant({x}) like 'ARRAY%', false)"


def is_string(x: str) -> str:
    return f"coalesce(schema_of_variant({x}) = 'STRING', false)"


def schema_label(key: str) -> Column:
    """chatml, sharegpt, flat or other."""
    at = _field(key)
    return F.expr(
        f"case when {is_array(_field('messages'))} then 'chatml' when {is_array(_field('conversations'))} then 'sharegpt' "
        f"when {is_string(at)} or {is_array(at)} then 'flat' else 'other' end"
    )


def _items(x: str) -> str:
    return f"try_cast({x} as array<variant>)"


def messages_text(x: str) -> str:
    """Stripped string contents of a chat's messages, one a line."""
    content = _field("content", "m")
    found = f"transform(filter({_items(x)}, m -> schema_of_variant(m) like 'OBJECT%' and {is_string(content)}), m -> {_STRIPPED.format(f'cast({content} as string)')})"
    return f"array_join(filter({found}, t -> t <> ''), '\\n')"


def conversations_text(x: str) -> str:
    """Stripped strings of a conversation's turns, from value or, where that is nothing, content; one a line."""
    value, content = _field("value", "m"), _field("content", "m")
    nothing = f"({value} is null or is_variant_null({value}) or to_json({value}) in ('\"\"', '0', '-0', '0.0', '-0.0', 'false', '[]', '{{}}'))"
    chosen = f"if({nothing}, {content}, {value})"
    found = f"transform(filter({_items(x)}, m -> schema_of_variant(m) like 'OBJECT%' and {is_string(chosen)}), m -> {_STRIPPED.format(f'cast({chosen} as string)')})"
    return f"array_join(filter({found}, t -> t <> ''), '\\n')"


def list_text(x: str) -> str:
    """The strings of a list that aren't blank, as they are, one a line."""
    found = f"transform(filter({_items(x)}, m -> {is_string('m')}), m -> cast(m as string))"
    return f"array_join(filter({found}, t -> {_STRIPPED.format('t')} <> ''), '\\n')"


def extracted_text(key: str) -> Column:
    """The text of a parsed row under a key; empty if there is none."""
    at = _field(key)
    listed = messages_text(at) if key == "messages" else conversations_text(at) if key == "conversations" else list_text(at)
    return F.expr(f"coalesce(case when {is_array(at)} then {listed} when {is_string(at)} then {_STRIPPED.format(f'cast({at} as string)')} end, '')")


def has_key(key: str) -> Column:
    """Whether the object has the key, be its value null."""
    return F.expr(f"{_field(key)} is not null")


def with_text(rows: DataFrame, key: str) -> DataFrame:
    """Parsed rows with schema, has_key and text."""
    return rows.withColumns({"schema": schema_label(key), "has_key": has_key(key), "text": extracted_text(key)})
