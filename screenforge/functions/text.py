"""Scalar text functions, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as str.strip() takes it off.  Fixed values.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Bucket labels and their upper bounds (exclusive).  Fixed values.
SIZE_BUCKETS = ["0-1KB", "1-10KB", "10-100KB", "100KB-1MB", "1-10MB", "10MB+"]
SIZE_BOUNDS = [1024, 10240, 102400, 1048576, 10485760]
CONF_BUCKETS = ["<0.5", "0.5-0.6", "0.6-0.7", "0.7-0.8", "0.8-0.9", "0.9-1.0"]
CONF_BOUNDS = [0.5, 0.6, 0.7, 0.8, 0.9]
RATIO_BUCKETS = [f"{k / 10:.1f}-{(k + 1) / 10:.1f}" for k in range(10)]


def let(name: str, value: str, body: str) -> str:
    """SQL for body with name bound to value, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def word_count(text: Column) -> Column:
    """Spaces plus one."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def token_estimate(words: Column) -> Column:
    """1.3 tokens a word, rounded down for each text."""
    return (words * F.lit(1.3)).cast("long")


def raw_bytes(line: Column) -> Column:
    """Bytes of a line with its line feed."""
    return (F.octet_length(line) + 1).cast("long")


def bucketed(value: Column, labels: list[str], bounds: list) -> Column:
    """The label of the first bound above the value, the last label beyond all."""
    out = F.lit(labels[-1])
    for label, bound in reversed(list(zip(labels, bounds, strict=False))):
        out = F.when(value < F.lit(bound), F.lit(label)).otherwise(out)
    return out


def size_bucket(size: Column) -> Column:
    return bucketed(size, SIZE_BUCKETS, SIZE_BOUNDS)


def conf_bucket(conf: Column) -> Column:
    return bucketed(conf, CONF_BUCKETS, CONF_BOUNDS)


def ratio_bucket(hits: Column, total: Column) -> Column:
    """Tenths of hits / total; the full share falls to the last."""
    tenth = F.least(F.lit(9), F.floor(hits * 10 / total)).cast("int")
    return F.element_at(F.array(*map(F.lit, RATIO_BUCKETS)), tenth + 1)


def output_basename(path: Column) -> Column:
    """grandparent_parent_stem of an absolute path, with fewer parts if there are fewer folders."""
    parts = F.split(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/"), "/+")
    name = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]+$", "")
    n = F.size(parts)
    return (
        F.when(n >= 4, F.concat_ws("_", F.element_at(parts, -3), F.element_at(parts, -2), name))
        .when(n == 3, F.concat_ws("_", F.element_at(parts, -2), name))
        .otherwise(name)
    )


# The code heuristic's lists.  Fixed values.
CODE_SINGLE = [
    "def __init__", "if __name__", "<!DOCTYPE", "public static void main", "#!/usr/bin", "#!/bin/bash", "package main", "func main()",
    "#include <", "using namespace", "Console.WriteLine", "System.out.println", "import React",
]
CODE_KEYWORDS = [
    "def ", "class ", "import ", "from ", "return ", "function ", "const ", "let ", "var ", "async ", "await ", "yield ", "#include",
    "SELECT ", "INSERT ", "CREATE TABLE", "fn ", "pub fn", "impl ", "struct ", "enum ", "package ", "interface ", "throws ",
    "elif ", "else:", "except:", "finally:",
]
CODE_STRUCTURAL = ["=>", "->", "::", "===", "!==", "&&", "||"]
CODE_SAMPLE = 3000


def code_signs(text: Column) -> dict[str, Column]:
    """The parts of the code heuristic, on the first CODE_SAMPLE code points."""
    sample = F.substring(text, 1, CODE_SAMPLE)

    def held(marks: list[str]) -> Column:
        total = F.lit(0)
        for mark in marks:
            total = total + F.contains(sample, F.lit(mark)).cast("int")
        return total

    return {
        "fence": F.contains(sample, F.lit("```")),
        "single": held(CODE_SINGLE) > 0,
        "keywords": held(CODE_KEYWORDS),
        "structural": held(CODE_STRUCTURAL),
        "letters": F.length(F.regexp_replace(sample, r"[^\p{L}]+", "")),
        "braces": F.length(F.regexp_replace(sample, r"[^{}()\[\];]+", "")),
    }


def is_code(text: Column) -> Column:
    s = code_signs(text)
    dense = (s["letters"] > 0) & (s["braces"] / F.greatest(s["letters"], F.lit(1)) > 0.08)
    return s["fence"] | s["single"] | (s["keywords"] >= 2) | (s["structural"] >= 3) | dense
