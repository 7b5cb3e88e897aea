"""Versioned layers with one small pointer as commit point (K1, K2, L1, L3).

Every run writes its tables to folders of its own, ``<root>/<layer>/<entity>[/<table>]/v-<run>``, and never touches
those of another run. A commit creates one small file, ``<root>/_commits/<entity>-<number>.json``, that names the
folder of every layer table. Readers take the tables of the last complete commit, so they see all layers of one run or
all layers of the run before, at every moment:

* a run that fails or is killed before its commit leaves folders that nothing names (:meth:`Lake.vacuum` removes them);
* one killed while it writes the commit leaves a file that is not complete, which readers pass over;
* nothing is renamed, copied or overwritten, so object stores need no more than creating a file;
* of two runs that end at the same time the second finds its number taken and commits under the next one, on file
  systems that can create a file exclusively.

A commit also holds the fingerprints of its tables (:func:`strata.plans.layers.fingerprint`), taken by the writes.

Delta tables have commits of their own: for ``fmt="delta"`` the layers stay at their plain paths and keep their history.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from strata.plans.layers import LayerPaths
from strata.sources import fs
from strata.spec import ENTITY, GOLD_TABLES

#: a commit file ends with this member; a file cut short has no end that parses
COMPLETE = "complete"


@dataclass(frozen=True)
class RunPaths(LayerPaths):
    """The folders of one run: those of :class:`LayerPaths`, each followed by the run's version."""

    run: str = ""

    def _join(self, *parts: str) -> str:
        return f"{super()._join(*parts)}/v-{self.run}"


@dataclass(frozen=True)
class Commit:
    number: int
    run: str
    tables: dict  # table name -> {"layer", "location"}
    fingerprints: dict = field(default_factory=dict)

    def registry(self, scope: str = "all") -> list[tuple[str, str, str]]:
        return sorted((name, t["layer"], t["location"]) for name, t in self.tables.items() if scope in ("all", t["layer"]))


class Lake:
    """The layers of one entity under ``root``."""

    def __init__(self, spark: SparkSession, root: str, entity: str = ENTITY):
        self.spark, self.root, self.entity = spark, root.rstrip("/"), entity
        self.folder = f"{self.root}/_commits"

    def _path(self, number: int) -> str:
        return f"{self.folder}/{self.entity}-{number:010d}.json"

    def _numbers(self) -> list[int]:
        head = f"{self.entity}-"
        found = (n[len(head):].removesuffix(".json") for n in fs.names(self.spark, self.folder) if n.startswith(head))
        return sorted(int(n) for n in found if n.isdigit())

    def _load(self, number: int) -> Commit | None:
        try:
            data = json.loads(fs.read_text(self.spark, self._path(number)))
        except ValueError:
            return None
        if not data.get(COMPLETE):
            return None
        return Commit(number, data["run"], data["tables"], data["fingerprints"])

    def commits(self) -> list[Commit]:
        """All complete commits, oldest first."""
        return [c for c in map(self._load, self._numbers()) if c]

    def current(self) -> Commit | None:
        """The last complete commit."""
        for number in reversed(self._numbers()):
            if commit := self._load(number):
                return commit
        return None

    def begin(self) -> RunPaths:
        """Folders for a new run; its name sorts by time."""
        return RunPaths(self.root, self.entity, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")

    def commit(self, paths: RunPaths, fingerprints: dict | None = None, gold_tables=GOLD_TABLES) -> Commit:
        """Make the tables of a run the current ones."""
        tables = {name: {"layer": layer, "location": location} for name, layer, location in paths.registry(gold_tables)}
        body = {"run": paths.run, "tables": tables, "fingerprints": fingerprints or {}, COMPLETE: True}
        number = max(self._numbers(), default=0) + 1
        while not fs.create_text(self.spark, self._path(number), json.dumps(body)):
            number += 1
        return Commit(number, paths.run, tables, body["fingerprints"])

    def location(self, table: str) -> str:
        """Where a table of the last commit lies; where it lies without versions if there is no commit."""
        commit = self.current()
        if commit:
            return commit.tables[table]["location"]
        return {name: location for name, _, location in LayerPaths(self.root, self.entity).registry()}[table]

    def paths(self) -> LayerPaths:
        """The paths of the last commit, or the plain ones without any."""
        commit = self.current()
        return RunPaths(self.root, self.entity, commit.run) if commit else LayerPaths(self.root, self.entity)

    def vacuum(self, keep: int = 2, older_than_s: float = 24 * 3600) -> list[str]:
        """Remove the versions of runs that none of the last ``keep`` commits names and that began more than
        ``older_than_s`` seconds ago (a run under way is younger), and all earlier commits. Returns the folders."""
        commits = self.commits()
        kept = {t["location"] for c in commits[-keep:] for t in c.tables.values()}
        limit, gone = time.time_ns() - int(older_than_s * 1e9), []
        for _, _, location in LayerPaths(self.root, self.entity).registry():
            for name in fs.folders(self.spark, location):
                folder = f"{location}/{name}"
                if name.startswith("v-") and folder not in kept and int(name[2:].partition("-")[0]) < limit:
                    fs.delete(self.spark, folder)
                    gone.append(folder)
        for commit in commits[:-keep]:
            fs.delete(self.spark, self._path(commit.number))
        return gone


def entities(spark: SparkSession, root: str) -> list[str]:
    """Entities with commits under ``root``."""
    names = [n.removesuffix(".json").rpartition("-") for n in fs.names(spark, f"{root.rstrip('/')}/_commits")]
    return sorted({entity for entity, _, number in names if number.isdigit()})
