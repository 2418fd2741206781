"""Repository manifests with includes. Small: read on the driver."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from pathlib import Path

from factloom.sources.config import Repository


class ManifestError(RuntimeError):
    """A manifest is missing, broken, or includes itself."""


def _included(manifest: Path, name: str) -> Path:
    """Beside the manifest, or in the stores of the ``.repo`` folder above it."""
    places = [manifest.parent / name]
    for folder in (manifest, *manifest.parents):
        if folder.name == ".repo":
            places += [folder / "manifests" / name, folder / "local_manifests" / name]
            break
    return next((p for p in places if p.is_file()), places[0])


def read_manifest(path: str | Path) -> tuple[Repository, ...]:
    """The projects of a manifest and what it includes, by path; of equal paths the first met stays."""
    found: dict[str, Repository] = {}

    def visit(manifest: Path, above: tuple[Path, ...]) -> None:
        manifest = manifest.resolve()
        if manifest in above:
            raise ManifestError(f"include cycle at {manifest}")
        if not manifest.is_file():
            raise ManifestError(f"no manifest {manifest}")
        try:
            root = ET.parse(manifest).getroot()
        except ET.ParseError as e:
            raise ManifestError(f"{manifest}: {e}") from e
        for project in root.iterfind("project"):
            if name := project.get("name"):
                where = project.get("path") or name
                found.setdefault(where, Repository(where, name))
        for include in root.iterfind("include"):
            if name := include.get("name"):
                visit(_included(manifest, name), (*above, manifest))

    visit(Path(path), ())
    return tuple(found[p] for p in sorted(found))
