"""A whole screening run: worklist, scan, decisions, routed outputs, manifest, checks."""

from __future__ import annotations

import dataclasses
import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScreenConfig
from ..functions.detect import StopwordDetector
from ..functions.text import output_basename
from ..operators import decide, extract, resume, stats, verify
from ..session import isolated
from ..sources import jsonl, sinks, worklist
from .progress import Progress, RunLog


def facts(lines: DataFrame, key: str, config: ScreenConfig, detector=None) -> DataFrame:
    """The facts of every line under one key."""
    rows = extract.with_text(extract.parsed(lines), key)
    return decide.outcomes(rows, config, detector or StopwordDetector(min_chars=config.min_chars))


def facts_of_files(spark: SparkSession, files: list[tuple[str, str]], config: ScreenConfig, detector=None) -> DataFrame:
    """Facts over files with various keys: one scan for each key."""
    out = None
    for key in sorted({k for _, k in files}):
        lines = jsonl.read_lines(spark, [p for p, k in files if k == key])
        part = facts(lines, key, config, detector)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("basename", output_basename(F.col("path")))


def plan(spark: SparkSession, csv_path: str, config: ScreenConfig, workers: int = 8) -> dict:
    """A dry run: what there is to do, and what is wrong with it.  Nothing is written."""
    files, missing = worklist.expanded(spark, worklist.read_worklist(spark, csv_path, config.default_key))
    named = sinks.basenames(files)
    return {
        **worklist.plan(files, config.split_mb, workers).first().asDict(),
        "missing": missing,
        "duplicates": [r["path"] for r in verify.duplicate_paths(files).collect()],
        "collisions": [r["basename"] for r in verify.basename_collisions(named).collect()],
    }


def _newest_manifest(spark: SparkSession, output: str) -> dict | None:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(output)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return None
    runs = sorted(s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().startswith("run_"))
    for name in reversed(runs):
        manifest = jvm.org.apache.hadoop.fs.Path(f"{output}/{name}/manifest.json")
        if fs.exists(manifest):
            rows = spark.read.text(manifest.toString(), wholetext=True).collect()
            return {"run": name, **json.loads(rows[0]["value"])}
    return None


_FILE = "path string, key string, input_size_bytes long, basename string, kept_rows long, rejected_rows long, unknown_rows long"


def _done_before(spark: SparkSession, entries: DataFrame, before: dict, output: str) -> list[dict]:
    """Manifest entries of files that an earlier run under the same settings has finished, and whose outputs have the lines it counted."""
    names = [x.split()[0] for x in _FILE.split(", ")]
    old = spark.createDataFrame([tuple(f[c] for c in names) for f in before["per_file"]], _FILE)
    there = sinks.read_routed(spark, f"{output}/{before['run']}/lines")
    written = there.groupBy("basename", "bucket").agg(F.count("*").alias("lines"))
    done = {r["path"] for r in resume.finished(entries, old, written).collect()}
    return [f for f in before["per_file"] if f["path"] in done]


def _without_key(spark: SparkSession, files: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(path, why) of files whose key is in none of the sampled lines; files with nothing but blank lines are none of them."""
    lines = worklist.sampled(spark, files).cache()
    try:
        named = lines.where(F.rtrim("value", F.lit("\r\n")) != "").select("path", "key").distinct()
        return [(r["path"], r["finding"]) for r in verify.keys_found(named, jsonl.key_presence(lines)).orderBy("path").collect()]
    finally:
        lines.unpersist()


def _per_file(spark: SparkSession, cube: DataFrame, info: dict[str, dict], langs: list[str], schemas: list[str]) -> list[dict]:
    """Statistics of every file, worst rejection rate first; zeros for files without lines."""
    files = stats.by_file(cube).join(stats.pivoted(cube, "lang", langs), "path", "left").join(stats.pivoted(cube, "schema", schemas), "path", "left")
    listed = spark.createDataFrame([(p,) for p in info], "path string").join(files, "path", "left").na.fill(0).na.fill("N/A", ["kept_pct"])
    return [r.asDict() for r in stats.ranking(listed).collect()]


def run(
    spark: SparkSession, csv_path: str, output: str, config: ScreenConfig, detector=None, again: bool = True, sample: float = 0.001, merge: bool = True, validate: bool = True
) -> dict:
    """Screens a worklist into output/run_<time>/ and returns its summary and findings.

    Every line is scored once; lines and facts are staged in the run's folder, the lines are written from there in order, and
    the facts are summed up once, to the cube in `stats`, from which every number of the manifest comes.  Files without
    lines have a row of zeros and three empty outputs.

    again: files that the newest run has finished under the same settings, and whose outputs have the lines it counted, are
    not read anew; their statistics and outputs are carried into the new run.  If that goes for all files, nothing is
    done, and the folder returned is the earlier one.
    merge: writes <basename>_<bucket>.jsonl from the ordered parts in `lines` (through the driver; see sinks.merge).
    validate: files whose key is in none of their first and last lines are left out, and reported as `invalid`.
    Findings don't fail the run.
    """
    own = isolated(spark, spark__sql__files__maxPartitionBytes=str(config.split_mb << 20))
    detector = detector or StopwordDetector(min_chars=config.min_chars)
    config = dataclasses.replace(config, detector=detector.name)
    settings = json.loads(json.dumps(dataclasses.asdict(config)))
    began, log = time.time(), RunLog()
    entries, missing = worklist.expanded(own, worklist.read_worklist(own, csv_path, config.default_key))
    for path in missing:
        log.warn(f"no file at {path}")
    double = [r["path"] for r in verify.duplicate_paths(entries).collect()]
    if double:
        raise ValueError(f"listed more than once: {', '.join(double)}")
    named = sinks.basenames(entries)
    clash = [r["basename"] for r in verify.basename_collisions(named).collect()]
    if clash:
        raise ValueError(f"several files would be written as {', '.join(clash)}")

    summary = {"missing": missing, "invalid": [], "skipped": 0, "files": 0, "findings": []}
    carried: list[dict] = []
    before = _newest_manifest(own, output) if again else None
    if before and before["run_info"]["config"] == settings:
        carried = _done_before(own, entries, before, output)
        log.info(f"{len(carried)} files are carried over from {before['run']}")
        named = resume.remaining(named, own.createDataFrame([(f["path"],) for f in carried], "path string"))
    summary["skipped"] = len(carried)
    info = {r["path"]: r.asDict() for r in named.collect()}
    if not info:
        log.info("nothing to do")
        return summary | ({"folder": f"{output}/{before['run']}", "total": before["global_summary"]} if carried else {})
    if not detector.check(own):
        summary["findings"].append((detector.name, "a plain English sentence isn't taken for English"))
    if validate:
        summary["invalid"] = _without_key(own, [(p, f["key"]) for p, f in info.items()])
        for path, why in summary["invalid"]:
            log.warn(f"left out: {path}: {why}")
            del info[path]
        if not info:
            return summary
    size = sum(f["size"] for f in info.values())
    if not verify.disk_space(output, size + sum(f["input_size_bytes"] for f in carried)):
        summary["findings"].append((output, "too little disk space"))
    summary["files"] = len(info)

    folder = f"{output}/run_{time.strftime('%Y%m%d_%H%M%S')}_{os.urandom(3).hex()}"
    log.info(f"{len(info)} files, {size / 2**20:.1f} MB, to {folder}; settings {config.fingerprint([(p, f['key'], f['size']) for p, f in info.items()])}")
    try:
        with Progress(own, log):
            summary |= _screened(own, folder, output, config, settings, detector, info, carried, before, summary["findings"], sample, merge, began)
        log.info(f"done in {time.time() - began:.1f} s; {summary['total_findings']} findings")
    finally:
        sinks.write_text(own, f"{folder}/logs/run.log", log.text())
    return summary


def _screened(own, folder, output, config, settings, detector, info, carried, before, findings, sample, merge, began) -> dict:
    """The part of a run that reads and writes; what it adds to the summary."""
    everything = facts_of_files(own, [(p, f["key"]) for p, f in info.items()], config, detector)
    everything.drop("v", "text", "line", "found").write.parquet(f"{folder}/_facts")
    everything = own.read.parquet(f"{folder}/_facts")
    stats.cube(everything).write.parquet(f"{folder}/stats")
    verify.by_block(everything).write.parquet(f"{folder}/blocks")
    sinks.write_routed(everything, f"{folder}/lines")
    sinks.delete(own, f"{folder}/_facts")
    if carried:
        earlier = f"{output}/{before['run']}"
        paths = own.createDataFrame([(f["path"],) for f in carried], "path string")
        own.read.parquet(f"{earlier}/stats").join(paths, "path", "left_semi").write.mode("append").parquet(f"{folder}/stats")
        sinks.carry(own, f"{earlier}/lines", f"{folder}/lines", [f["basename"] for f in carried])

    cube, blocks = own.read.parquet(f"{folder}/stats"), own.read.parquet(f"{folder}/blocks")
    langs, schemas = stats.labels_of(cube, "lang"), stats.labels_of(cube, "schema")
    known = {f["path"]: f for f in carried}
    per_file = _per_file(own, cube, info | known, langs, schemas)
    total = stats.total(cube).first().asDict() | {"total_files": len(per_file)}
    total |= {f"{c}_{x}": sum(f[f"{c}_{x}"] or 0 for f in per_file) for c, labels in (("lang", langs), ("schema", schemas)) for x in labels}
    total["top_rejected_langs"] = {r["lang"]: r["count"] for r in stats.top_rejected(cube, config.allowed).collect()}
    for name in stats.HISTOGRAMS:
        total[f"{name}_buckets"] = {f"{r['side']} {r['bucket']}": r["rows"] for r in stats.histogram(cube, name).collect()}
    seconds, size = time.time() - began, max(1, sum(f["size"] for f in info.values()))
    for f in per_file:
        if f["path"] in known:
            f |= {c: known[f["path"]][c] for c in ("filename", "basename", "key", "input_size_bytes", "input_size_mb", "input_mtime_iso", "total_parts", "processing_time_sec", "rows_per_sec", "mb_per_sec")}
            continue
        i = info[f["path"]]
        f |= {"filename": os.path.basename(f["path"]), "basename": i["basename"], "key": i["key"], "input_size_bytes": i["size"], "input_size_mb": round(i["size"] / 2**20, 2)}
        f |= {"input_mtime_iso": time.strftime("%Y-%m-%dT%H:%M:%S", time.localtime(i["mtime"] / 1000)), "total_parts": max(1, -(-i["size"] // (config.split_mb << 20)))}
        # All files are read at once; a file's time is its share, by bytes, of the run's.
        f |= _rates(f["total_rows"], i["size"], seconds * i["size"] / size)
    whole = sum(f["input_size_bytes"] for f in per_file)
    total |= {"input_size_mb": round(whole / 2**20, 2)} | _rates(total["total_rows"], whole, seconds)
    run_info = {"config": settings, "fingerprint": config.fingerprint([(f["path"], f["key"], f["input_size_bytes"]) for f in per_file]), "seconds": round(seconds, 2), "resumed_from": before["run"] if carried else None}
    sinks.write_text(own, f"{folder}/manifest.csv", sinks.manifest_csv(per_file, total, langs, schemas))

    written = sinks.read_routed(own, f"{folder}/lines")
    names = [x.split()[0] for x in _FILE.split(", ")]
    files = own.createDataFrame([tuple(f[c] for c in names) for f in per_file], _FILE)
    first, count = verify.report(
        verify.accounting(stats.by_file(cube)),
        verify.line_counts(files, written),
        verify.coverage(blocks),
        verify.boundaries(blocks),
        verify.size_ratio(files, written),
        verify.json_sample(written.where("bucket = 'en'").select("value"), sample),
        folder=f"{folder}/findings",
    )
    if merge:
        sinks.merge(own, f"{folder}/lines", folder, [f["basename"] for f in per_file])
    # The manifest comes last: a run without one isn't resumed from.
    sinks.write_text(own, f"{folder}/manifest.json", sinks.manifest_json(run_info, total, per_file, merge))
    return {"folder": folder, "total": total, "findings": findings + first, "total_findings": len(findings) + count}


def _rates(rows: int, size: int, seconds: float) -> dict:
    some = max(seconds, 0.01)
    return {"processing_time_sec": round(seconds, 2), "rows_per_sec": round(rows / some, 1), "mb_per_sec": round(size / 2**20 / some, 1)}
