"""Sinks: confined, atomic and canonical outputs."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame


class OutputError(ValueError):
    pass


def confined(root: str, path: str, suffix: str | None = None) -> str:
    """The absolute path of an output that stays below an existing root."""
    base = os.path.realpath(root)
    if not os.path.isdir(base):
        raise OutputError("the output root is not a folder")
    if not path or "\x00" in path or "\\" in path:
        raise OutputError("the output path is not portable")
    out = os.path.realpath(os.path.join(base, path))
    if os.path.commonpath([base, out]) != base or out == base:
        raise OutputError("the output leaves its root")
    if suffix and not out.lower().endswith(suffix):
        raise OutputError(f"the output must end with {suffix}")
    return out


def distinct_outputs(outputs: list[str], inputs: list[str]) -> None:
    """Refuses outputs that are the same file as one another or as an input."""
    seen = {os.path.realpath(p).casefold() for p in inputs}
    for p in outputs:
        key = os.path.realpath(p).casefold()
        if key in seen:
            raise OutputError(f"output is used twice: {p}")
        seen.add(key)


def replaced(path: str, data: bytes, force: bool = False) -> None:
    """Writes a file whole or not at all; an existing one only with force."""
    if os.path.exists(path) and not force:
        raise OutputError(f"output exists: {path}")
    fd, temp = tempfile.mkstemp(dir=os.path.dirname(path))
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    except BaseException:
        if os.path.exists(temp):
            os.unlink(temp)
        raise


def replaced_together(files: dict[str, bytes], force: bool = False) -> None:
    """Writes several files, all or none: those replaced so far are put back if one fails."""
    before = {}
    for p in files:
        if os.path.exists(p):
            if not force:
                raise OutputError(f"output exists: {p}")
            with open(p, "rb") as f:
                before[p] = f.read()
    done = []
    try:
        for p, data in files.items():
            replaced(p, data, force=True)
            done.append(p)
    except BaseException:
        for p in done:
            if p in before:
                replaced(p, before[p], force=True)
            else:
                os.unlink(p)
        raise


def canonical(value) -> bytes:
    return (json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n").encode()


def report(df: DataFrame, path: str, force: bool = False) -> None:
    """A small report table as one canonical JSON file, in a fixed order. Large tables go to df.write."""
    rows = sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: json.dumps(r, sort_keys=True, default=str))
    replaced(path, canonical(rows), force)
