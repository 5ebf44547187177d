"""Command line of the screening engine."""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging

from pyspark.sql import SparkSession

from .config import ScreenConfig
from .functions.detect import StopwordDetector, fasttext_detector
from .plans import screen

# Options that set a field of ScreenConfig.  Fixed values.
SETTINGS = {
    "split_mb": "--split-threshold",
    "confidence": "--confidence",
    "chunk_size": "--chunk-size",
    "max_chunks": "--max-chunks",
    "min_en_ratio": "--min-en-ratio",
    "default_key": "--default-key",
    "code_detection": "--enable-code-detection",
}
_MEANING = {
    "split_mb": "MB of a file that one task reads",
    "confidence": "least confidence of a detection that counts",
    "chunk_size": "code points of a long text's chunk, at most",
    "max_chunks": "chunks of a long text, at most",
    "min_en_ratio": "share of chunks that must be in an allowed language",
    "default_key": "key of files that the worklist names none for",
    "code_detection": "keep rows that look like program code",
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Screens JSON-lines corpora by language.")
    # Names of the other options.  Fixed values.
    p.add_argument("--file-list", required=True, help="CSV with the columns path and key")
    p.add_argument("--output", "-o", required=True, help="folder of all runs")
    p.add_argument("--workers", "-w", type=int, default=8, help="tasks at a time, for the dry run's estimate; cores are Spark's matter")
    p.add_argument("--model-path", help="a fastText model, instead of the built-in detector by function words")
    p.add_argument("--resume", action="store_true", default=True, help="carry over what the newest run has finished (the default)")
    p.add_argument("--no-resume", action="store_true", help="screen all files anew")
    p.add_argument("--dry-run", action="store_true", help="say what there is to do, and write nothing")
    p.add_argument("--no-merge", action="store_true", help="leave the outputs as ordered parts")
    for field in dataclasses.fields(ScreenConfig):
        if field.name in SETTINGS:
            how = {"action": "store_true"} if isinstance(field.default, bool) else {"default": field.default, "type": type(field.default) if field.default is not None else str}
            p.add_argument(SETTINGS[field.name], dest=field.name, help=_MEANING[field.name], **how)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    config = ScreenConfig(**{name: getattr(a, name) for name in SETTINGS})
    logging.basicConfig(format="%(asctime)s | %(levelname)-7s | %(message)s", level=logging.WARNING)
    logging.getLogger("screenforge").setLevel(logging.INFO)
    detector = fasttext_detector(a.model_path, config.min_chars) if a.model_path else StopwordDetector(min_chars=config.min_chars)
    spark = SparkSession.builder.appName("screenforge").getOrCreate()
    if a.dry_run:
        done = screen.plan(spark, a.file_list, config, a.workers)
    else:
        done = screen.run(spark, a.file_list, a.output, config, detector, again=not a.no_resume, merge=not a.no_merge)
    print(json.dumps(done, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
