"""Language detectors.

A detector scores texts with a label and a confidence.  The default counts function words and is made of SQL
functions alone, so that it stays in the plan; models come in as Arrow-batched functions.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITE_SPACE, let

#: Function words by language; ties go to the first language.
STOPWORDS: dict[str, str] = {
    "en": "the of and with by for are is to in that this",
    "fr": "le la les des un une et que qui dans pour par du",
    "de": "der die das und ist nicht den ein mit dem von ich",
    "es": "el los las que en por con del una se y un",
}
RESULT = "struct<lang:string,conf:double>"


class StopwordDetector:
    """Most hits in the language's word list wins; the confidence is its share of all hits."""

    def __init__(self, words: dict[str, str] | None = None, min_chars: int = 10) -> None:
        self.words, self.min_chars = {k: v.split() for k, v in (words or STOPWORDS).items()}, min_chars
        #: Tells word lists apart in a run's fingerprint.
        self.name = "stopwords" if words is None else "stopwords " + hashlib.sha256(repr(self.words).encode()).hexdigest()[:16]

    def sql(self, text: str) -> str:
        """SQL for struct(lang, conf) of a text; unknown with confidence 0 if short or without hits."""
        listed = sorted({w for v in self.words.values() for w in v})
        quoted = lambda ws: ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in ws)
        counts = ", ".join(f"size(filter(h, w -> w in ({quoted(v)})))" for v in self.words.values())
        names = list(self.words)
        best = "".join(f"when c[{k}] = array_max(c) then '{n}' " for k, n in enumerate(names))
        chosen = let(
            "c",
            f"array({counts})",
            f"if(array_max(c) = 0, named_struct('lang', 'unknown', 'conf', 0D), named_struct('lang', case {best}end, 'conf', array_max(c) / cast(aggregate(c, 0, (a, x) -> a + x) as double)))",
        )
        hits = f"filter(split(regexp_replace(lower({text}), r'[^\\p{{L}}]+', ' '), ' '), w -> w in ({quoted(listed)}))"
        short = f"length(btrim({text}, '{_escaped(WHITE_SPACE)}')) < {self.min_chars}"
        return f"if({text} is null or {short}, named_struct('lang', 'unknown', 'conf', 0D), {let('h', hits, chosen)})"

    def one(self, text: str) -> Column:
        return F.expr(self.sql(text))

    def many(self, texts: str) -> Column:
        """array of struct(lang, conf) for an array of texts."""
        return F.expr(f"transform({texts}, t -> {self.sql('t')})")

    def check(self, spark) -> bool:
        """Whether a plain English sentence is taken for English."""
        return spark.sql("select 'This is the end of the line, and that is to be with us for good' as t").select(self.one("t")["lang"]).first()[0] == "en"


_loaded: dict[str, Callable] = {}


def _predictor(name: str, load: Callable) -> Callable:
    """The model of that name, loaded once per Python worker."""
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = load()
    return _loaded[name]


def clean_label(label: str) -> str:
    """A model's label without the prefix that marks it as one."""
    return label.removeprefix("__label__")


class ModelDetector:
    """Wraps a model: load() is called once per Python worker and returns a function from a list of texts to (label, conf).

    name: tells models apart, in a worker and in a run's fingerprint.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], list[tuple[str, float]]]], min_chars: int = 10, name: str = "model") -> None:
        self.load, self.min_chars, self.name = load, min_chars, name

    def _scorer(self) -> Callable[[list], list[tuple[str, float]]]:
        name, load, least = self.name, self.load, self.min_chars

        def score(texts: list) -> list[tuple[str, float]]:
            fit = [i for i, t in enumerate(texts) if t is not None and len(t.strip()) >= least]
            out = [("unknown", 0.0)] * len(texts)
            if fit:
                found = _predictor(name, load)([texts[i].replace("\n", " ").replace("\r", " ") for i in fit])
                for i, r in zip(fit, found, strict=True):
                    out[i] = (clean_label(r[0]), float(r[1])) if r and r[0] else ("unknown", 0.0)
            return out

        return score

    def one(self, text: str) -> Column:
        score = self._scorer()

        @F.pandas_udf(RESULT)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield pd.DataFrame(score(texts.tolist()), columns=["lang", "conf"])

        return run(F.make_valid_utf8(F.col(text)))

    def many(self, texts: str) -> Column:
        score = self._scorer()

        @F.pandas_udf(f"array<{RESULT}>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                found = iter(score([t for row in rows if row is not None for t in row]))
                yield pd.Series([None if row is None else [dict(zip(("lang", "conf"), next(found), strict=True)) for _ in row] for row in rows])

        return run(F.transform(F.col(texts), F.make_valid_utf8))

    def check(self, spark) -> bool:
        return spark.sql("select 'This is the end of the line, and that is to be with us for good' as t").select(self.one("t")["lang"]).first()[0] == "en"


def fasttext_detector(path: str, min_chars: int = 10) -> ModelDetector:
    """A fastText model from a file that every worker can read."""
    import importlib.util

    if importlib.util.find_spec("fasttext") is None:
        raise ValueError("a model is given, but the library fasttext isn't installed")
    if not os.path.isfile(path):
        raise ValueError(f"no model at {path}")

    def load():
        import fasttext

        model = fasttext.load_model(path)

        def predict(texts: list[str]) -> list[tuple[str, float]]:
            labels, scores = model.predict(texts, k=1)
            return [(a[0], b[0]) if a else ("", 0.0) for a, b in zip(labels, scores, strict=True)]

        return predict

    return ModelDetector(load, min_chars, f"fasttext {path} {os.path.getsize(path)}")


def _escaped(text: str) -> str:
    return "".join(f"\\u{ord(c):04X}" for c in text)
