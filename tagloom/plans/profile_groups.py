"""The profile as groups of columns, each stored on its own.

Some thirty programs each own a few columns of one profile. As one table every one of them would rewrite all
columns of all customers. Here a group is a ``ProfileStore`` of its own, bucketed by id like the others:
an upsert writes the groups whose columns it has and nothing else, so writers of different groups never
meet. A read joins the groups bucket by bucket: only their ids are shuffled, to know them all, no
other column.

A manifest names the version of every group. It is committed after the rows: a snapshot holds groups that were written
together, or none of them. Writers of different groups that end at the same moment both commit; the later one puts its
own groups on the other's manifest, a file of a few lines. Old manifests stay readable.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.staging import scratch, stage
from tagloom.plans.profile import ProfileStore, project_profile
from tagloom.sources.versions import Versions

_NOTE = "_groups.json"


@dataclass(frozen=True)
class ProfileGroups:
    """``groups``: group -> its columns, each column in one group only."""

    spark: SparkSession
    root: str
    groups: Mapping[str, Sequence[str]]
    buckets: int

    def __post_init__(self):
        columns = [c for names in self.groups.values() for c in names]
        if len(columns) != len(set(columns)) or "id" in columns:
            raise ValueError("a column belongs to one group, the id to none")

    def store(self, group: str) -> ProfileStore:
        return ProfileStore(self.spark, f"{self.root}/group={group}", self.buckets)

    def _manifests(self) -> Versions:
        return Versions(self.spark, f"{self.root}/manifest")

    def snapshot(self, version: int | None = None) -> dict[str, int]:
        """Group -> version, of a manifest or of the newest one; empty when nothing was written."""
        manifests = self._manifests()
        version = manifests.newest() if version is None else version
        return {} if version is None else json.loads(manifests.note(version, _NOTE))

    def _parts(self, columns: Sequence[str]) -> dict[str, list[str]]:
        unknown = set(columns) - {c for names in self.groups.values() for c in names}
        if unknown:
            raise ValueError(f"no group has the columns {sorted(unknown)}")
        parts = {group: [c for c in columns if c in names] for group, names in self.groups.items()}
        return {group: names for group, names in parts.items() if names}

    def upsert(self, update: DataFrame) -> int:
        """Replaces the update's columns for its ids; returns the manifest that shows it."""
        parts = self._parts([c for c in update.columns if c != "id"])
        with scratch(self.spark):
            rows = stage(update, "update") if len(parts) > 1 else update  # computed once for all groups
            return self.commit({group: self.store(group).upsert(rows.select("id", *names)) for group, names in parts.items()})

    def commit(self, written: Mapping[str, int]) -> int:
        """A manifest with these versions on top of the newest one; of a group the newer version stays."""
        manifests = self._manifests()
        while True:
            base = manifests.newest()
            known = self.snapshot(base) if base else {}
            merged = {**known, **{group: max(version, known.get(group, 0)) for group, version in written.items()}}
            run = manifests.new_run()
            manifests.put_note(run, _NOTE, json.dumps(merged, sort_keys=True))
            if manifests.publish(run, (base or 0) + 1):
                return (base or 0) + 1
            manifests.drop(run)

    def read(self, columns: Sequence[str] | None = None, version: int | None = None) -> DataFrame | None:
        """One row per id that any group knows; with ``columns`` only those are read, and of the
        other groups just the ids. None when nothing was written."""
        snapshot = sorted(self.snapshot(version).items())
        if not snapshot:
            return None
        groups = [self.store(group).read(number) for group, number in snapshot]
        ids = [self.store(group).read(number, bucketed=False).select("id") for group, number in snapshot]
        # left joins keep the buckets of the left side, where full joins would not
        whole = reduce(DataFrame.unionByName, ids).distinct().repartition(self.buckets, "id")
        for rows in groups:
            wanted = [c for c in rows.columns if c != "id" and (columns is None or c in columns)]
            if wanted:
                whole = whole.join(rows.select("id", *wanted), "id", "left")
        return whole if columns is None else project_profile(whole, columns)
