"""The configuration file and the output path that it names."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from string import Formatter

import yaml

from loomspan.period import TIMEZONE

# The keys of each part and the type of each value.
PARTS = {"github": {"org": str, "token_env": str}, "scan": {"days": int, "timezone": str}, "output": {"file": str}}
PLACEHOLDERS = {"org", "start_date", "end_date"}


@dataclass(frozen=True)
class Config:
    org: str
    token_env: str
    days: int
    timezone: str
    file: str


def parse(value: object) -> Config:
    """All keys are required and no others are allowed."""
    _same_keys(value, set(PARTS), "the configuration")
    flat: dict[str, object] = {}
    for part, keys in PARTS.items():
        _same_keys(value[part], set(keys), part)
        for key, kind in keys.items():
            got = value[part][key]
            if not isinstance(got, kind) or isinstance(got, bool) or not got:
                raise ValueError(f"{part}.{key} must be a {'text that is not empty' if kind is str else 'number above 0'}")
            flat[key] = got
    if flat["days"] < 1:
        raise ValueError("scan.days must be a number above 0")
    if flat["timezone"] != TIMEZONE:
        raise ValueError(f"scan.timezone must be {TIMEZONE}")
    return Config(**flat)


def _same_keys(value: object, keys: set[str], where: str) -> None:
    if not isinstance(value, dict):
        raise ValueError(f"{where} must be a mapping")
    if unknown := set(value) - keys:
        raise ValueError(f"{where} has unknown keys: {', '.join(sorted(map(str, unknown)))}")
    if missing := keys - set(value):
        raise ValueError(f"{where} lacks keys: {', '.join(sorted(missing))}")


def load(path: str | Path) -> Config:
    try:
        return parse(yaml.safe_load(Path(path).read_text(encoding="utf-8")))
    except OSError as e:
        raise ValueError(f"cannot read {path}: {e}") from e
    except yaml.YAMLError as e:
        raise ValueError(f"{path} is not YAML: {e}") from e


def output_path(config_path: str | Path, template: str, **values: str) -> Path:
    """The template's placeholders filled; a relative path starts at the configuration's folder, ~ is the home folder."""
    try:
        for _, name, spec, conversion in Formatter().parse(template):
            if name is not None and (name not in PLACEHOLDERS or spec or conversion):
                raise ValueError(f"only plain placeholders of {', '.join(sorted(PLACEHOLDERS))} are allowed")
        filled = Path(template.format(**values)).expanduser()
    except (KeyError, IndexError, ValueError) as e:
        raise ValueError(f"the output file template is invalid: {e}") from e
    return filled if filled.is_absolute() else Path(config_path).resolve().parent / filled
