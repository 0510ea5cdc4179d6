"""Versioned artifacts of stages in a workspace folder.

``<workspace>/artifacts/<stage>/<scope>/v001/`` has the tables, ``checks.json``
and ``manifest.json`` of a version; ``_latest.json`` names the published one
and is replaced atomically.  Nothing may be written outside the version being
built or, while publishing, the pointer.  The workspace is a folder that the
driver and all executors share.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
from collections.abc import Iterator
from datetime import datetime, timezone
from pathlib import Path

from wayfare.errors import UpstreamCorrupt, UpstreamMissing, WriteViolation

PUBLISHED = ("published",)


def sha256_file(path: Path) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def sha256_path(path: Path) -> str:
    """Hash of a file, or of a folder's relative names and contents: any added, removed, renamed or edited file changes it."""
    if path.is_file():
        return sha256_file(path)
    h = hashlib.sha256()
    for p in sorted(x for x in path.rglob("*") if x.is_file() and not x.name.startswith((".", "_SUCCESS"))):
        h.update(f"{p.relative_to(path)}\0{sha256_file(p)}\n".encode())
    return h.hexdigest()


def sha256_json(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()


def code_hash() -> str:
    """Hash of the library's own sources."""
    root = Path(__file__).resolve().parents[1]
    h = hashlib.sha256()
    for p in sorted(x for pattern in ("*.py", "*.yaml") for x in root.rglob(pattern) if "llm" not in x.relative_to(root).parts):
        h.update(f"{p.relative_to(root)}\0{sha256_file(p)}\n".encode())
    return h.hexdigest()


class Store:
    def __init__(self, workspace: str | Path, digits: int = 3):
        self.root, self.digits = Path(workspace), digits
        self._open: Path | None = None
        self._publishing = False

    # -- paths

    def folder(self, stage: str, scope: str) -> Path:
        return self.root / "artifacts" / stage / scope

    def version(self, stage: str, scope: str, version: str | None = None) -> Path:
        """Folder of a version, by default the published one."""
        version = version or self.latest(stage, scope)
        path = self.folder(stage, scope) / version
        if not (path / "manifest.json").exists():
            raise UpstreamMissing(f"{stage}/{scope} has no version {version}")
        return path

    def latest(self, stage: str, scope: str) -> str:
        pointer = self.folder(stage, scope) / "_latest.json"
        if not pointer.exists():
            raise UpstreamMissing(f"{stage}/{scope} has no published version")
        return json.loads(pointer.read_text())["version"]

    def versions(self, stage: str, scope: str) -> list[Path]:
        folder = self.folder(stage, scope)
        return sorted(p for p in folder.iterdir() if p.is_dir() and p.name[0] == "v") if folder.exists() else []

    def new_version(self, stage: str, scope: str) -> Path:
        """The next number, counting rejected versions too."""
        numbers = [int(p.name[1:].split("-")[0]) for p in self.versions(stage, scope)]
        path = self.folder(stage, scope) / f"v{max(numbers, default=0) + 1:0{self.digits}d}"
        path.mkdir(parents=True)
        return path

    def reject(self, path: Path) -> Path:
        """Keep a failed version under a name that no reader takes for a version."""
        target, n = path.with_name(f"{path.name}-rejected"), 2
        while target.exists():
            target, n = path.with_name(f"{path.name}-rejected-{n}"), n + 1
        path.rename(target)
        return target

    # -- write policy

    @contextlib.contextmanager
    def building(self, path: Path) -> Iterator[None]:
        if self._open is not None:
            raise WriteViolation("another version is being built")
        self._open = path
        try:
            yield
        finally:
            self._open = None

    @contextlib.contextmanager
    def publishing(self) -> Iterator[None]:
        self._publishing = True
        try:
            yield
        finally:
            self._publishing = False

    def assert_writable(self, target: str | Path) -> None:
        path = Path(str(target).removeprefix("file://")).resolve()
        if self._open is not None and path.is_relative_to(self._open.resolve()):
            return
        if self._publishing and path.name == "_latest.json" and path.is_relative_to(self.root.resolve()):
            return
        raise WriteViolation(f"{path} is not open for writing")

    # -- manifests

    @staticmethod
    def manifest(path: Path) -> dict:
        return json.loads((path / "manifest.json").read_text(encoding="utf-8"))

    def write_manifest(self, path: Path, values: dict) -> None:
        self.assert_writable(path / "manifest.json")
        values = {"created": datetime.now(timezone.utc).isoformat(timespec="seconds"), **values}
        (path / "manifest.json").write_text(json.dumps(values, ensure_ascii=False, indent=1, default=str), encoding="utf-8")

    @staticmethod
    def hash_outputs(path: Path) -> dict[str, str]:
        """Hash of every output; manifests and check reports describe outputs and are none."""
        skip = ("manifest.json", "checks.json", "_debug")
        return {p.name: sha256_path(p) for p in sorted(path.iterdir()) if p.name not in skip and not p.name.startswith(".")}

    def verify(self, path: Path) -> list[str]:
        """Names of outputs that no longer have the hash in the manifest."""
        want, have = {k: v["sha256"] for k, v in self.manifest(path)["outputs"].items()}, self.hash_outputs(path)
        return sorted(k for k in {*want, *have} if want.get(k) != have.get(k))

    def upstream(self, stage: str, scope: str, pin: str | None = None) -> Path:
        path = self.version(stage, scope, pin)
        if self.manifest(path)["status"] not in PUBLISHED:
            raise UpstreamMissing(f"{stage}/{scope}/{path.name} is not published")
        changed = self.verify(path)
        if changed:
            raise UpstreamCorrupt(f"{stage}/{scope}/{path.name}: {changed} differ from the manifest")
        return path

    def find_published(self, stage: str, scope: str, key: str) -> str | None:
        for p in reversed(self.versions(stage, scope)):
            if (p / "manifest.json").exists():
                m = self.manifest(p)
                if m["content_key"] == key and m["status"] in PUBLISHED and not self.verify(p):
                    return p.name
        return None

    def publish(self, stage: str, scope: str, version: str) -> None:
        with self.publishing():
            pointer = self.folder(stage, scope) / "_latest.json"
            self.assert_writable(pointer)
            temporary = pointer.with_name(f"._latest.{os.getpid()}")
            temporary.write_text(json.dumps({"version": version}))
            os.replace(temporary, pointer)

    def log(self, **entry) -> None:
        """One JSON line per run, whatever its outcome."""
        self.root.mkdir(parents=True, exist_ok=True)
        with open(self.root / "runs.jsonl", "a", encoding="utf-8") as f:
            f.write(json.dumps({"at": datetime.now(timezone.utc).isoformat(timespec="seconds"), **entry}, ensure_ascii=False, default=str) + "\n")
