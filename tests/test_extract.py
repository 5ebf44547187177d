"""Edge rows of JSON lines: outcome, schema, text."""

from __future__ import annotations

import json

import pytest

from screenforge.config import ScreenConfig
from screenforge.plans.screen import facts

LONG = "the cat and the dog are in that house with this " * 3
# (line, key, expected facts)
ROWS = [
    ("", "text", {"empty_line": True, "bucket": None}),
    ("\r", "text", {"empty_line": True, "bucket": None}),
    (" ", "text", {"json_error": True, "bucket": "non_selected", "schema": None}),
    ('{"text":"x', "text", {"json_error": True, "bucket": "non_selected"}),
    ("[1]", "text", {"json_error": True, "bucket": "non_selected"}),
    ("null", "text", {"json_error": True}),
    ('"s"', "text", {"json_error": True}),
    ("3", "text", {"json_error": True}),
    ('{"a":NaN}', "text", {"json_error": True}),
    ('{"other":"x"}', "text", {"bucket": "unknown", "key_missing": True, "content_empty": False, "schema": "other"}),
    ('{"text":null}', "text", {"bucket": "unknown", "key_missing": True, "content_empty": True, "schema": "other"}),
    ('{"text":5}', "text", {"bucket": "unknown", "content_empty": True, "schema": "other"}),
    ('{"text":{}}', "text", {"bucket": "unknown", "content_empty": True, "schema": "other"}),
    ('{"text":"  "}', "text", {"bucket": "unknown", "content_empty": True, "schema": "flat"}),
    ('{"text":[]}', "text", {"bucket": "unknown", "content_empty": True, "schema": "flat"}),
    ('{"text":"hi"}', "text", {"bucket": "non_selected", "lang": "unknown", "conf": None, "schema": "flat"}),
    ('{"text":"a","text":"b"}', "text", {"text": "b"}),
    ('{"a":1} trailing', "text", {"json_error": True}),
    ('{"a":1} {"b":2}', "text", {"json_error": True}),
    ('{"a":1}], [{}', "text", {"json_error": True}),
    ('{"a":1}},{"b":2', "text", {"json_error": True}),
    ('{"messages":[{"content":" hi "},{"content":null},{"content":[]},3]}', "messages", {"text": "hi", "schema": "chatml"}),
    ('{"messages":["a","b"]}', "messages", {"text": "", "bucket": "unknown", "content_empty": True, "schema": "chatml"}),
    ('{"messages":" a b "}', "messages", {"text": "a b", "schema": "flat"}),
    ('{"conversations":[{"value":"","content":"c1"}]}', "conversations", {"text": "c1", "schema": "sharegpt"}),
    ('{"conversations":[{"value":{"a":1},"content":"c2"}]}', "conversations", {"text": ""}),
    ('{"conversations":[{"value":"  ","content":"c3"}]}', "conversations", {"text": ""}),
    ('{"conversations":[{"value":0,"content":"c4"},{"value":false,"content":"c5"},{"value":[],"content":"c6"}]}', "conversations", {"text": "c4\nc5\nc6"}),
    ('{"x":["a"," ",3,"b "]}', "x", {"text": "a\nb ", "schema": "flat"}),
    ('{"messages":[],"conversations":[],"x":"y"}', "x", {"schema": "chatml", "text": "y"}),
    ('{"a.b":"dotted key works"}', "a.b", {"text": "dotted key works"}),
    ('{"it\'s":"quoted key works"}', "it's", {"text": "quoted key works"}),
    (json.dumps({"text": " 　 padded text here  "}), "text", {"text": "padded text here"}),
    (json.dumps({"text": "a  b"}), "text", {"words": 3, "tokens": 3}),
    (json.dumps({"text": LONG}), "text", {"bucket": "en", "lang": "en", "single": True, "chunked": False}),
    (json.dumps({"text": LONG}) + "\r", "text", {"bucket": "en", "bytes": len(json.dumps({"text": LONG})) + 2}),
]


@pytest.mark.parametrize("line,key,expected", ROWS, ids=range(len(ROWS)))
def test_row(line, key, expected, spark):
    row = facts(spark.createDataFrame([("f", line)], "path string, value string"), key, ScreenConfig()).first().asDict()
    assert {k: row[k] for k in expected} == expected
    assert row["value"] == line


def test_code_option_keeps_code(spark):
    df = spark.createDataFrame([("f", json.dumps({"text": "def f(): import os and return it"}))], "path string, value string")
    row = facts(df, "text", ScreenConfig(code_detection=True)).first()
    assert (row.bucket, row.lang, row.code, row.conf, row.single) == ("en", "code", True, None, False)


@pytest.mark.parametrize("n,chunked", [(10_000, False), (10_001, True)])
def test_length_limit(n, chunked, spark):
    text = ("the cat and the dog " * 600)[: n - 1] + "x"
    row = facts(spark.createDataFrame([("f", json.dumps({"text": text}))], "path string, value string"), "text", ScreenConfig()).first()
    assert row.chunked is chunked
    assert (row.found.total == 4) if chunked else row.found.total is None


def test_invalid_utf8_survives(spark, tmp_path):
    from screenforge.sources import jsonl

    raw = b'{"text":"the bad \xff byte and the rest of it"}\n\n{"text":"second"}\r\n{"text":"third"}'
    (tmp_path / "a.jsonl").write_bytes(raw)
    lines = jsonl.read_lines(spark, [str(tmp_path / "a.jsonl")])
    assert facts(lines, "text", ScreenConfig()).where("json_error").count() == 0
    lines.select("value").coalesce(1).write.option("lineSep", "\n").text(str(tmp_path / "out"))
    written = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert written == raw + b"\n"
