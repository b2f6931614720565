"""One change to a valid report for each rule."""

from __future__ import annotations

import pytest

from loomspan.operators.report_rules import Style, findings, in_order

STYLE = Style(org="Some-Org", title="# Weekly")
LINK = "[Some-Org/tool#7](https://github.com/Some-Org/tool/issues/7)"


def valid() -> str:
    out = [STYLE.title, "", "Intro for C#11 readers.", ""]
    for section in STYLE.sections:
        out += [f"## {section}", ""]
        if section == "Worth Engineering Investment":
            out += [f"1. See {LINK}", "", "   - 建议投入类型：`quick review`", "", "2. More", ""]
        elif section == STYLE.allocation:
            out += ["1. One", "", STYLE.week_heading, "", "A conclusion.", "", "A reason.", ""]
        else:
            out += [STYLE.empty_message + "。", ""]
    return "\n".join(out)


def changed(old: str, new: str) -> str:
    assert old in valid()
    return valid().replace(old, new, 1)


CASES = {
    "V01": valid() + "\n~~~~\n~~~\n",
    "V02": changed("# Weekly", "# Monthly"),
    "V03": changed("## Must Pay Attention", "## Must Pay"),
    "V04": changed("[Some-Org/tool#7]", "[the tool]"),
    "V05": changed("issues/7", "issues/8"),
    "V06": changed(LINK, "https://github.com/Some-Org/tool/pull/7"),
    "V07": changed("2. More", "2. More on tool#9"),
    "V08": changed("2. More", "2. More\n\n### 3. Third"),
    "V09": changed("2. More", "2. More\n\n* point"),
    "V10": changed("   - 建议", "  - 建议"),
    "V11": changed("\n\n   - 建议", "\n   - 建议"),
    "V12": changed("## Worth Engineering Investment\n\n", "## Worth Engineering Investment\n"),
    "V13": changed(STYLE.empty_message, "nothing"),
    "V14": changed("2. More", "3. More"),
    "V15": changed(STYLE.week_heading, "### Other"),
    "V16": changed(STYLE.empty_message + "。\n\n## Must", f"{STYLE.empty_message}\n\n{STYLE.week_heading}\n\nA\n\nB\n\n## Must").replace(f"1. One\n\n{STYLE.week_heading}", "1. One\n\n### Other"),
    "V17": changed("A reason.", "- A reason."),
    "V18": changed("A conclusion.\n\n", ""),
    "V19": changed("建议投入类型", "建议投入"),
    "V20": changed("`quick review`", "`a year`"),
}


@pytest.fixture(scope="module")
def found(spark):
    texts = {"valid": valid(), "crlf": valid().replace("\n", "\r\n"), "hidden": valid() + "\n```\ntool#9\n- x\n```\n", "empty": "", "null": None, **CASES}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    out: dict = {name: [] for name in texts}
    for r in in_order(findings(docs, STYLE)).collect():
        out[r.doc_id].append(r)
    return out


def test_valid_reports(found):
    assert found["valid"] == found["crlf"] == found["hidden"] == []


@pytest.mark.parametrize("rule", sorted(CASES))
def test_rule(found, rule):
    rules = {r.rule for r in found[rule]}
    assert rule in rules
    assert rules <= {rule, *{"V03": {"V13"}, "V10": {"V10"}, "V17": {"V09", "V18"}, "V15": set(), "V09": {"V09"}}.get(rule, set())}


def test_lines_and_messages(found):
    assert found["V01"][0].line_no == len(valid().split("\n")) + 1
    assert found["V14"][0].message.endswith("expected [1, 2], found [1, 3]")
    assert found["V07"][0].message.endswith("'tool#9'")
    assert {r.rule for r in found["empty"]} == {r.rule for r in found["null"]} == {"V02", "V03", "V13", "V15"}
