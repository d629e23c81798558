"""Settings and prompts, read on the driver: they are small and enter plans as literals. Secrets never enter a plan."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import re
import subprocess
from pathlib import Path


def settings(path: str) -> dict:
    """A JSON file's object; an empty or missing file has none."""
    text = Path(path).read_text(encoding="utf-8").strip() if Path(path).exists() else ""
    return json.loads(text) if text else {}


def environment(path: str) -> dict[str, str]:
    """NAME=value lines of a file, quotes taken off, under the process's own variables, which win."""
    lines = Path(path).read_text(encoding="utf-8").splitlines() if Path(path).exists() else []
    found = (re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", x) for x in lines)
    return {m[1]: re.sub(r"^(['\"])(.*)\1$", r"\2", m[2]) for m in found if m} | dict(os.environ)


def short_hash(text: str, n: int = 8) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:n]


def prompt(folder: str, modules: list[str], optional: tuple[str, ...] = ()) -> tuple[str, str]:
    """(text, hash) of modules stripped and joined by a rule; a module that is missing fails unless it is optional."""
    paths = [Path(folder, m) for m in modules]
    kept = [p.read_text(encoding="utf-8").strip() for p in paths if p.exists() or p.name not in optional]
    text = "\n\n---\n\n".join(kept) + "\n"
    return text, short_hash(text)


def task_prompt(path: str) -> tuple[str, str]:
    """(text, hash) without the block of # lines that it begins with."""
    text = re.sub(r"\A(?:#[^\n]*(?:\n|\Z))+", "", Path(path).read_text(encoding="utf-8")).strip()
    return text, short_hash(text)


def fingerprint(parts: dict) -> str:
    """Equal for equal settings, whatever the order of their names."""
    return short_hash(json.dumps(parts, sort_keys=True, ensure_ascii=False), 12)


def run_facts(prompt_hash: str, repository: str = ".") -> dict[str, str | None]:
    """What a run was made with: commit (null outside a repository), UTC time with its zone, prompt."""
    got = subprocess.run(["git", "-C", repository, "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=False)
    return {"commit": got.stdout.strip() or None, "created_at": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"), "prompt": prompt_hash}


def write_threshold(path: str, name: str, value: float) -> dict:
    """Sets one threshold, counts the version up, and replaces the file in one step."""
    new = settings(path)
    new |= {name: value, "version": int(new.get("version", 0)) + 1}
    part = Path(f"{path}.part")
    part.write_text(json.dumps(new, ensure_ascii=False, indent=1), encoding="utf-8")
    part.replace(path)
    return new
