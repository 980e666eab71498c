"""Provenance on the driver: canonical JSON, fingerprints, revisions, packages."""

from __future__ import annotations

import datetime
import hashlib
import json
import subprocess
import zipfile
from importlib import metadata
from pathlib import Path

from pyspark.sql import DataFrame

from inkwell.sources.manifest import publish


def plain(value):
    """A value that JSON can hold: paths with slashes, sets sorted, anything else by its text."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in sorted(value.items(), key=lambda kv: str(kv[0]))}
    if isinstance(value, (set, frozenset)):
        return sorted((plain(v) for v in value), key=str)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, Path):
        return value.as_posix()
    return value if value is None or isinstance(value, (str, int, float, bool)) else repr(value)


def canonical(value) -> bytes:
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()


def fingerprint(value) -> str:
    return hashlib.sha256(canonical(value)).hexdigest()


def run_key(tag: str, settings) -> str:
    return f"{tag}-{fingerprint(settings)[:12]}"


def snapshot(module, leave_out: tuple[str, ...] = ()) -> dict:
    """A module's public upper-case names."""
    return {k: plain(v) for k, v in sorted(vars(module).items()) if k.isupper() and not k.startswith("_") and k not in leave_out}


def revision(folder: str | Path) -> tuple[str | None, bool | None]:
    """(commit, whether files differ from it), or nothing outside a repository."""

    def git(*args: str) -> str | None:
        done = subprocess.run(["git", "-C", str(folder), *args], capture_output=True, text=True, check=False)
        return done.stdout.strip() if done.returncode == 0 else None

    commit = git("rev-parse", "HEAD")
    return commit, None if commit is None else bool(git("status", "--porcelain"))


def versions(packages: list[str]) -> dict[str, str | None]:
    out = {}
    for p in packages:
        try:
            out[p] = metadata.version(p)
        except metadata.PackageNotFoundError:
            out[p] = None
    return out


def utc_now() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")


def tree(root: str | Path) -> dict[str, str]:
    """Digests of the regular files below a folder; links and other kinds fail."""
    root, out = Path(root), {}
    for p in sorted(root.rglob("*")):
        if p.is_symlink() or not (p.is_dir() or p.is_file()):
            raise ValueError(f"{p} is not a regular file")
        if p.is_file():
            with p.open("rb") as f:
                out[p.relative_to(root).as_posix()] = hashlib.file_digest(f, "sha256").hexdigest()
    return out


def package(root: str | Path, target: str | Path) -> dict[str, str]:
    """Packs a folder whose files must not change meanwhile; an existing archive stays."""
    root, target = Path(root), Path(target)
    before = tree(root)
    part = target.with_name(f".{target.name}.part")
    try:
        with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
            for name in before:
                z.write(root / name, f"{root.name}/{name}")
        with zipfile.ZipFile(part) as z:
            packed = {i.filename.removeprefix(f"{root.name}/"): hashlib.sha256(z.read(i)).hexdigest() for i in z.infolist()}
        if packed != before or tree(root) != before:
            raise RuntimeError("files changed while they were packed")
        target.hardlink_to(part)
    finally:
        part.unlink(missing_ok=True)
    return before


def matches_contract(state: dict, expected: dict) -> list[str]:
    """Names of the settings in which a checkpoint differs from what is expected."""
    return sorted(k for k in expected if plain(state.get(k)) != plain(expected[k]))


#: Rows that a report may have.
MOST_ROWS = 100_000


def write_report(df: DataFrame, path: str | Path, most: int = MOST_ROWS) -> None:
    """A small result as sorted JSON; one of more than ``most`` rows is refused before it is gathered."""
    rows = [r.asDict(recursive=True) for r in df.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    publish(path, (json.dumps(plain(rows), sort_keys=True, indent=2, ensure_ascii=False) + "\n").encode(), overwrite=True)
