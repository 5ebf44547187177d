"""Whole runs: outputs, manifest, resume, dry run, stream."""

from __future__ import annotations

import json

import pytest

from screenforge.config import ScreenConfig
from screenforge.plans import screen

EN = "the cat and the dog are in that house with this and that is for by to "
FR = "le chat et la souris dans une maison pour le jardin des enfants du "


@pytest.fixture
def corpus(tmp_path):
    a = tmp_path / "in" / "one"
    a.mkdir(parents=True)
    lines = [json.dumps({"text": EN})] * 3 + [json.dumps({"text": FR})] * 2 + ["", "{bad", json.dumps({"other": 1})]
    (a / "a.jsonl").write_text("\n".join(lines) + "\n")
    (a / "b.jsonl").write_text("".join(json.dumps({"messages": [{"content": EN}, {"content": EN}]}) + "\n" for _ in range(4)))
    (a / "ignored.txt").write_text("x")
    (tmp_path / "list.csv").write_text(f" Path ,KEY\n{a / 'a.jsonl'},text\n{a / 'b.jsonl'},messages\n{tmp_path / 'missing.jsonl'},text\n")
    return tmp_path


def lines_of(folder, basename, bucket):
    return sorted(x for p in folder.glob(f"lines/basename={basename}/bucket={bucket}/part-*") for x in p.read_text().splitlines())


def test_run_and_resume(spark, corpus):
    from pathlib import Path

    out = str(corpus / "out")
    first = screen.run(spark, str(corpus / "list.csv"), out, ScreenConfig(), sample=1.0)
    folder = Path(first["folder"])
    assert first["findings"] == [] and first["missing"] == [str(corpus / "missing.jsonl")]
    total = first["total"]
    assert (total["total_rows"], total["kept_rows"], total["rejected_rows"], total["unknown_rows"]) == (11, 7, 3, 1)
    assert (total["empty_lines"], total["json_errors"], total["key_missing"]) == (1, 1, 1)
    assert total["top_rejected_langs"] == {"fr": 2}
    assert lines_of(folder, "in_one_a", "en") == [json.dumps({"text": EN})] * 3
    assert lines_of(folder, "in_one_a", "non_selected") == sorted([json.dumps({"text": FR})] * 2 + ["{bad"])
    manifest = json.loads((folder / "manifest.json").read_text())
    assert {f["basename"] for f in manifest["per_file"]} == {"in_one_a", "in_one_b"} == set(manifest["provenance"])
    table = (folder / "manifest.csv").read_text().splitlines()
    assert len(table) == 4 and table[-1].startswith("=== TOTAL ===") and "lang_fr" in table[0]
    assert table[1].startswith("a.jsonl")  # the worst comes first

    # Ordered single files, all three of each input, and the log.
    assert (folder / "in_one_a_en.jsonl").read_text().splitlines() == [json.dumps({"text": EN})] * 3
    assert (folder / "in_one_a_non_selected.jsonl").read_text().splitlines() == [json.dumps({"text": FR})] * 2 + ["{bad"]
    assert (folder / "in_one_b_unknown.jsonl").read_text() == "" and len(list(folder.glob("*.jsonl"))) == 6
    assert "done in" in (folder / "logs" / "run.log").read_text() and not (folder / "_facts").exists()
    for f in manifest["per_file"]:
        assert f["processing_time_sec"] > 0 and f["rows_per_sec"] > 0 and f["total_parts"] == 1
        assert (folder / manifest["provenance"][f["basename"]]["output_en"]).exists()

    again = screen.run(spark, str(corpus / "list.csv"), out, ScreenConfig())
    assert (again["skipped"], again["files"], again["folder"]) == (2, 0, first["folder"])
    (corpus / "in" / "one" / "a.jsonl").write_text(json.dumps({"text": EN}) + "\n")
    third = screen.run(spark, str(corpus / "list.csv"), out, ScreenConfig())
    assert (third["skipped"], third["files"]) == (1, 1)
    manifest = json.loads((Path(third["folder"]) / "manifest.json").read_text())
    assert len(manifest["per_file"]) == 2  # what was skipped is carried on
    assert (third["total"]["total_rows"], third["total"]["kept_rows"], third["total"]["total_files"]) == (5, 5, 2)
    assert len((Path(third["folder"]) / "in_one_b_en.jsonl").read_text().splitlines()) == 4
    assert screen.run(spark, str(corpus / "list.csv"), out, ScreenConfig(confidence=0.8))["files"] == 2


def test_resume_needs_and_carries_outputs(spark, corpus):
    import shutil
    from pathlib import Path

    def run():
        return screen.run(spark, str(corpus / "list.csv"), str(corpus / "out"), ScreenConfig(), sample=1.0)

    folder = Path(run()["folder"])
    shutil.rmtree(folder / "lines" / "basename=in_one_b")
    second = run()
    assert (second["skipped"], second["files"], second["findings"]) == (1, 1, [])
    for name, bucket, n in (("in_one_a", "en", 3), ("in_one_a", "non_selected", 3), ("in_one_a", "unknown", 1), ("in_one_b", "en", 4)):
        assert len(lines_of(Path(second["folder"]), name, bucket)) == n
    assert lines_of(Path(second["folder"]), "in_one_a", "en") == lines_of(folder, "in_one_a", "en")
    assert run()["files"] == 0


def listed(tmp_path, **files):
    """A worklist of files with the given texts."""
    for name, text in files.items():
        (tmp_path / f"{name}.jsonl").write_text(text)
    (tmp_path / "list.csv").write_text("path,key\n" + "".join(f"{tmp_path / name}.jsonl,text\n" for name in files))
    return str(tmp_path / "list.csv"), str(tmp_path / "out")


def test_files_without_lines(spark, tmp_path):
    from pathlib import Path

    for files in ({"empty": ""}, {"blank": "\n\n\n"}, {"empty": "", "blank": "\n\r\n", "full": json.dumps({"text": EN}) + "\n"}):
        where = tmp_path / "_".join(files)
        where.mkdir()
        done = screen.run(spark, *listed(where, **files), ScreenConfig())
        folder = Path(done["folder"])
        assert (done["files"], done["findings"], done["invalid"]) == (len(files), [], [])
        assert len(list(folder.glob("*.jsonl"))) == 3 * len(files)
        rows = {f["filename"]: (f["total_rows"], f["empty_lines"], f["kept_pct"]) for f in json.loads((folder / "manifest.json").read_text())["per_file"]}
        assert rows.get("empty.jsonl", (0, 0, "N/A")) == (0, 0, "N/A")
        if "blank" in files:
            assert rows["blank.jsonl"] == (0, files["blank"].count("\n"), "N/A")
        assert done["total"]["total_rows"] == ("full" in files) and done["total"]["total_files"] == len(files)
        assert len((folder / "manifest.csv").read_text().splitlines()) == len(files) + 2


def test_files_without_their_key_are_left_out(spark, tmp_path):
    good, other = json.dumps({"text": EN}) + "\n", json.dumps({"body": EN}) + "\n"
    done = screen.run(spark, *listed(tmp_path, a=other * 30 + good, b=other * 50, c="[1]\n" * 3, d=other * 15 + good + other * 15), ScreenConfig(), sample=1.0)
    assert [(p.rsplit("/", 1)[1], "body" in why) for p, why in done["invalid"]] == [("b.jsonl", True), ("c.jsonl", False), ("d.jsonl", True)]
    assert done["files"] == 1 and done["total"]["total_rows"] == 31 and done["findings"] == []
    assert screen.run(spark, *listed(tmp_path, b=other * 50), ScreenConfig())["files"] == 0
    done = screen.run(spark, *listed(tmp_path, b=other * 50), ScreenConfig(), validate=False)
    assert (done["files"], done["total"]["unknown_rows"]) == (1, 50)


def test_lines_longer_than_a_split(spark, tmp_path):
    """Blocks in which no line starts are no finding; outputs keep the order of the file."""
    from pathlib import Path

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = [json.dumps({"text": f"{k} " + EN * n}) for k, n in enumerate((50_000, 3, 48_000, 1, 50_000, 2, 2))]
    done = screen.run(spark, *listed(tmp_path, long="\n".join(lines)), ScreenConfig(split_mb=1), sample=1.0)
    assert done["findings"] == [] and done["total"]["kept_rows"] == 7
    assert (Path(done["folder"]) / f"{tmp_path.parent.name}_{tmp_path.name}_long_en.jsonl").read_text().splitlines() == lines
    assert json.loads((Path(done["folder"]) / "manifest.json").read_text())["per_file"][0]["total_parts"] > 5
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_other_detectors_are_other_runs(spark, corpus, tmp_path):
    from screenforge.functions.detect import ModelDetector, clean_label, fasttext_detector

    args = spark, str(corpus / "list.csv"), str(corpus / "out"), ScreenConfig()
    first = screen.run(*args)
    detector = ModelDetector(lambda: lambda texts: [("__label__fr", 0.9) for _ in texts], name="always French")
    second = screen.run(*args, detector=detector)
    assert second["files"] == 2 and second["total"]["kept_rows"] == 0 and second["total"]["lang_fr"] == 9
    assert any("English" in why for _, why in second["findings"])  # the detector takes English for French
    assert first["findings"] == [] and clean_label("__label__en") == "en"
    with pytest.raises(ValueError, match="fasttext"):
        fasttext_detector(str(tmp_path / "none.ftz"))


def test_command_line(spark, corpus, capsys):
    from screenforge import cli

    assert cli.main(["--file-list", str(corpus / "list.csv"), "-o", str(corpus / "out"), "--dry-run"]) == 0
    assert json.loads(capsys.readouterr().out)["files"] == 2
    assert cli.main(["--file-list", str(corpus / "list.csv"), "-o", str(corpus / "out"), "--no-merge", "--min-en-ratio", "0.5"]) == 0
    done = json.loads(capsys.readouterr().out)
    assert done["total"]["kept_rows"] == 7
    options = {x for a in cli.parser()._actions for x in a.option_strings}
    assert {"--model-path", "--workers", "--split-threshold", "--confidence", "--chunk-size", "--max-chunks", "--default-key", "--enable-code-detection", "--resume", "--no-resume"} <= options


def test_all_findings_are_written_and_counted(spark, tmp_path):
    from screenforge.operators import verify

    found = spark.range(250).selectExpr("concat('f', id) AS path", "'wrong' AS finding")
    first, count = verify.report(found, found.limit(0), folder=str(tmp_path / "findings"))
    assert (len(first), count) == (100, 250) and spark.read.json(str(tmp_path / "findings")).count() == 250


def test_plan_writes_nothing(spark, corpus):
    plan = screen.plan(spark, str(corpus / "list.csv"), ScreenConfig())
    assert plan["files"] == 2 and plan["units"] == 2 and plan["missing"] and not plan["collisions"]
    assert not (corpus / "out").exists()


def test_bad_worklists(spark, corpus):
    twice = corpus / "twice.csv"
    twice.write_text(f"path,key\n{corpus}/in/one,text\n{corpus}/in/one/a.jsonl,text\n")
    with pytest.raises(ValueError, match="more than once"):
        screen.run(spark, str(twice), str(corpus / "o"), ScreenConfig())
    twice.write_text(f"path\n{corpus}/in/one/a.jsonl\n")
    with pytest.raises(ValueError, match="no default key"):
        screen.plan(spark, str(twice), ScreenConfig())
    assert screen.plan(spark, str(twice), ScreenConfig(default_key="text"))["files"] == 1


def test_stream(spark, corpus):
    from screenforge.streaming.screen import start

    out = corpus / "stream"
    for extra in (False, True):
        if extra:
            (corpus / "in" / "one" / "c.jsonl").write_text(json.dumps({"text": EN}) + "\n")
        start(spark, str(corpus / "in" / "one"), str(out), str(corpus / "state"), "text", ScreenConfig()).awaitTermination()
    counted = spark.read.parquet(str(out / "stats"))
    assert counted.groupBy().sum("total_rows", "kept_rows").first()[:] == (12, 4)


def test_entry_works_without_llm():
    import importlib
    import sys

    import __spark_entry__

    held = {k: sys.modules.pop(k) for k in list(sys.modules) if k.startswith(("screenforge.llm", "corpus_pipeline"))}
    import screenforge

    package = screenforge.__dict__.pop("llm", None)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name in ("screenforge.llm", "corpus_pipeline"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    sys.meta_path.insert(0, gone := Gone())
    try:
        entry = importlib.reload(__spark_entry__)
        assert "bucket_by_language" in entry.queries() and "pipeline" not in entry.queries()
        assert set(entry.oracle_sql()) <= set(entry.queries())
    finally:
        sys.meta_path.remove(gone)
        sys.modules.update(held)
        if package is not None:
            screenforge.llm = package
        importlib.reload(__spark_entry__)
