"""Configuration and commands, end to end without a network."""

from __future__ import annotations

import logging

import pytest

from loomspan import config as C
from loomspan.cli import main
from tests.test_report_rules import valid

GOOD = "github: {org: o, token_env: LOOM_TOKEN}\nscan: {days: 7, timezone: Asia/Shanghai}\noutput: {file: 'out/{org}-{start_date}.md'}\n"


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "config.yaml"
    file.write_text(GOOD)
    return file


@pytest.mark.parametrize("old, new", [("days: 7", "days: 0"), ("days: 7", "days: true"), ("Asia/Shanghai", "UTC"), ("org: o, ", ""), ("org: o", "org: o, x: 1"), (GOOD, "- a"), (GOOD, "a: [")])
def test_wrong_configurations(path, old, new, capsys):
    path.write_text(GOOD.replace(old, new))
    assert main(["validate-config", "--config", str(path)]) == 2 and "error:" in capsys.readouterr().err


def test_template_is_checked(path, capsys):
    assert main(["validate-config", "--config", str(path)]) == 0
    path.write_text(GOOD.replace("{org}", "{other}"))
    assert main(["validate-config", "--config", str(path)]) == 2 and "template" in capsys.readouterr().err


def test_output_path(path):
    assert C.output_path(path, "a/{org}.md", org="o", start_date="s", end_date="e") == path.parent / "a" / "o.md"
    for template in ("{other}", "{org!r}", "{org:>9}", "{", "{0}"):
        with pytest.raises(ValueError):
            C.output_path(path, template, org="o", start_date="s", end_date="e")


def test_dry_run_and_missing_token(path, capsys, monkeypatch):
    monkeypatch.delenv("LOOM_TOKEN", raising=False)
    dates = ["--start-date", "2026-07-10", "--end-date", "2026-07-16"]
    assert main(["collect", "--config", str(path), *dates, "--dry-run"]) == 0
    out = capsys.readouterr().out
    assert "Scan end: 2026-07-16T23:59:59.999999+08:00" in out and f"Evidence file: {path.parent}/out/o-2026-07-10.md" in out and "Dry run" in out
    assert main(["collect", "--config", str(path), *dates]) == 2 and "LOOM_TOKEN" in capsys.readouterr().err
    assert main(["collect", "--config", str(path), "--start-date", "2026-07-10"]) == 2


def test_collect_then_read(spark, path, capsys, monkeypatch):
    monkeypatch.setenv("LOOM_TOKEN", "secret-value")
    dates = ["--start-date", "2026-07-10", "--end-date", "2026-07-16"]
    assert main(["collect", "--config", str(path), *dates, "--base-url", "https://api.test", "--workers", "2", "--transport", "tests.test_rest:pretend"]) == 0
    shown = capsys.readouterr()
    assert "Issues: 3\nPull requests: 1\nAPI request failures: 2\n" in shown.out and "secret-value" not in shown.out + shown.err
    assert all(x in shown.err for x in ("Starting GitHub collection", "retained: 4 (o/r#1, ", "WARNING loomspan: ", "Rendering Markdown evidence", "Writing evidence file")) and not logging.getLogger("loomspan").handlers
    document = str(path.parent / "out" / "o-2026-07-10.md")
    assert main(["overview", document]) == 0
    assert "## Collection Summary" in capsys.readouterr().out
    assert main(["index", document, "issue", "--limit", "2"]) == 0
    shown = capsys.readouterr()
    assert shown.out.count("\n") == 4 and shown.err.startswith("items 1-2 of 3;") and shown.err.endswith("next offset: 2\n")
    assert main(["item", document, "issue", "o/r#2", "--view", "comments", "--max-bytes", "256"]) == 0
    assert len(capsys.readouterr().out.encode()) <= 256
    assert main(["item", document, "issue", "o/r#99"]) == 2
    assert main(["index", document, "issue", "--offset", "9"]) == 2


def test_check_report(spark, tmp_path, capsys):
    report = tmp_path / "report.md"
    report.write_text(valid())
    rest = ["--org", "Some-Org", "--title", "# Weekly"]
    assert main(["check-report", str(report), *rest]) == 0
    report.write_text(valid() + "\nsee tool#9\n")
    assert main(["check-report", str(report), *rest]) == 1 and "'tool#9'" in capsys.readouterr().err
    assert main(["check-report", str(tmp_path / "none.md"), *rest]) == 2
