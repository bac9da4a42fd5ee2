"""Strings of options and file names."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .guards import col

#: Fixed value: the entities of a file name.
ENTITIES = {"subject": "sub", "session": "ses", "run": "run", "task": "task", "acquisition": "acq"}


def parse_options(text: str, kinds: dict[str, type]) -> dict:
    """"a=1,b=true" as typed values; unknown keys and bad values raise."""
    out = {}
    for part in filter(None, text.split(",")):
        key, sign, value = part.partition("=")
        if not sign or key not in kinds:
            raise ValueError(f"unknown option: {part}")
        if kinds[key] is bool:
            if value.lower() not in ("true", "false"):
                raise ValueError(f"{key} is true or false, not {value}")
            out[key] = value.lower() == "true"
        else:
            out[key] = kinds[key](value)
    return out


def parse_interval(text: str, frames: int) -> tuple[int, int]:
    """"first-last" or "first-end" as a half-open interval of frames."""
    if text == "all" or "," in text:
        raise ValueError(f"an interval is first-last or first-end, not {text}")
    parts = text.split("-")
    if len(parts) != 2:
        raise ValueError(f"an interval has two parts: {text}")
    return int(parts[0]), frames if parts[1] == "end" else int(parts[1])


def parse_spacing(text: str) -> tuple[float, ...] | None:
    """"AxBxC" as three sizes; None for inputs_defined."""
    if text == "inputs_defined":
        return None
    parts = text.split("x")
    if len(parts) != 3:
        raise ValueError(f"a spacing is AxBxC, not {text}")
    return tuple(float(p) for p in parts)


def read_filter(path: str) -> dict:
    """A JSON file that filters scans by entity."""
    with open(path, encoding="utf-8") as f:
        out = json.load(f)
    if not isinstance(out, dict):
        raise ValueError("a filter is an object of entities")
    return out


def stem(path: Column | str) -> Column:
    """A path's file name up to .nii."""
    return F.regexp_extract(F.regexp_replace(col(path), r"^.*/", ""), r"^(.*?)(?:\.nii.*)?$", 1)


def entity(path: Column | str, name: str) -> Column:
    """An entity of a file name, null if it has none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(col(path), r"^.*/", ""), rf"(?:^|_){re.escape(ENTITIES[name])}-([A-Za-z0-9]+)", 1), F.lit(""))
