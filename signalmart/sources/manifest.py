"""Which folders make up the tables: one small file per committed batch, newest file wins.

A batch writes every table into folders of its own. They become part of the mart all at once, when the
manifest that names them is published; a reader sees the tables as of one manifest. Each query is the only
writer of its manifests and of the tables in them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from signalmart.sources.files import Folder

#: Manifests kept for readers that still work with them; folders only older ones name can go.
RETAIN = 8


@dataclass(frozen=True)
class Segment:
    """One written folder of a table: its batch, how often it was merged, the partitions in it."""

    path: str
    batch: int
    level: int = 0
    parts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    batch: int = -1  # newest committed batch
    as_of: str | None = None  # its clock
    before: int = 0  # version it was built on: where a replay of it starts again
    tables: dict[str, tuple[Segment, ...]] = field(default_factory=dict)

    def paths(self) -> set[str]:
        return {segment.path for segments in self.tables.values() for segment in segments}

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        found = json.loads(text)
        found["tables"] = {
            name: tuple(Segment(**{**s, "parts": tuple(s["parts"])}) for s in segments)
            for name, segments in found["tables"].items()
        }
        return cls(**found)


class Log:
    """The manifests of one query."""

    def __init__(self, folder: Folder, query: str):
        self._folder = folder
        self._place = f"_manifests/{query}"
        self._pending = f"_pending/{query}"

    def versions(self) -> list[int]:
        names = self._folder.names(self._place)
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def _name(self, version: int) -> str:
        return f"{self._place}/{version:012d}.json"

    def at(self, version: int) -> Manifest:
        text = self._folder.read(self._name(version)) if version else None
        return Manifest.from_json(text) if text else Manifest()

    def latest(self) -> Manifest:
        while versions := self.versions():
            # Between listing and reading, newer ones may have pushed this one out.
            if text := self._folder.read(self._name(versions[-1])):
                return Manifest.from_json(text)
        return Manifest()

    def publish(self, manifest: Manifest) -> Manifest:
        """Make `manifest` the newest; fails if another writer was faster."""
        version = (self.versions() or [0])[-1] + 1
        manifest = replace(manifest, version=version)
        self._folder.write(self._name(version), manifest.to_json())
        kept = {*self.versions()[-RETAIN:], manifest.before}
        for old in self.versions():
            if old not in kept:
                self._folder.delete(self._name(old))
        return manifest

    def retained(self) -> set[str]:
        """Folders that some kept manifest names."""
        return set().union(*(self.at(version).paths() for version in self.versions()))

    def clock(self, batch: int, now: str) -> str:
        """The clock of a batch, fixed at its first attempt so that a replay judges alike."""
        name = f"{self._pending}/{batch:012d}.json"
        found = self._folder.read(name)
        if found is None:
            self._folder.write(name, json.dumps(now))
            for old in self._folder.names(self._pending):
                if old.endswith(".json") and int(old.removesuffix(".json")) < batch - 1:
                    self._folder.delete(f"{self._pending}/{old}")
            return now
        return json.loads(found)
