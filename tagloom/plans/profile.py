"""The wide profile: assemble, upsert, store, read back, export."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom import labels as L
from tagloom.functions.casting import text
from tagloom.operators.joining import orders_with_id
from tagloom.operators.staging import stage
from tagloom.plans.line_tags import line_tags
from tagloom.plans.log_tags import log_tags, logs_with_id, view_goods
from tagloom.plans.order_tags import order_tags
from tagloom.plans.tag import aggregate_tags, project_tags
from tagloom.plans.user_tags import user_tags
from tagloom.session import configured_dir
from tagloom.sources.tables import Sources


@dataclass(frozen=True)
class ProfileSettings:
    """What the data do not say: the reference date, id width, population, ladders."""

    as_of: str
    id_digits: int | None
    population: int | None = None
    ladders: dict = field(default_factory=dict)


def checkpointed(spark: SparkSession) -> Callable[[DataFrame], DataFrame] | None:
    """Stages a frame in the cluster's shared folder; None when the session names none."""
    return None if configured_dir(spark) is None else lambda df: stage(df, "profile")


def assemble(frames: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """One row per key that any frame knows. Keys must be unique in each frame.

    Frames that come out of an aggregation by the key are already hash-partitioned by it,
    and so is their union: bringing the parts of a key together needs a local sort but no
    further shuffle. (A chain of full outer joins would shuffle the growing wide rows
    again at every step.) Each frame travels as one struct, so absent parts cost nothing.
    """
    columns = [[c for c in f.columns if c != key] for f in frames]
    parts = [f.select(key, F.struct(*names).alias(f"part{i}")) for i, (f, names) in enumerate(zip(frames, columns))]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = stacked.groupBy(key).agg(
        *[F.first(f"part{i}", ignorenulls=True).alias(f"part{i}") for i in range(len(parts))])
    return merged.select(key, *[
        F.col(f"part{i}.{name}").alias(name) for i, names in enumerate(columns) for name in names])


def source_frames(sources: Sources, settings: ProfileSettings, stage=None) -> list[DataFrame]:
    """One frame per source, each with all its tags from one scan and one aggregation."""
    users = sources.users.where(F.col("id").isNotNull()).repartition("id")
    orders = orders_with_id(sources.orders, settings.id_digits)
    lines = sources.order_lines(settings.id_digits)
    logs = logs_with_id(sources.logs)
    return [
        project_tags(users, user_tags(settings.as_of).values()),
        aggregate_tags(orders, order_tags(settings.ladders).values()),
        aggregate_tags(lines, line_tags().values()),
        aggregate_tags(logs, log_tags(settings.population).values(), stage=stage),
        view_goods(sources.logs, sources.goods),
    ]


def build_profile(spark: SparkSession, sources: Sources, settings: ProfileSettings,
                  extra: Sequence[DataFrame] = ()) -> DataFrame:
    """All rule-based tags, plus ``extra`` frames (value segments, favourites) by id."""
    frames = source_frames(sources, settings, checkpointed(spark))
    return assemble([*frames, *extra])


def upsert(profile: DataFrame, update: DataFrame, key: str = "id") -> DataFrame:
    """Replaces the update's columns for its ids; other ids and columns stay as they are.

    Each id must occur once on either side. Null in the update is a value: it replaces.
    """
    new_columns = [c for c in update.columns if c != key]
    fresh = update.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in new_columns])
    joined = profile.join(fresh, profile[key] == fresh["__key"], "full_outer")
    updated = F.col("__key").isNotNull()

    def merged(c: str):
        fresh_value = F.col(f"__{c}")
        return F.when(updated, fresh_value).otherwise(profile[c]) if c in profile.columns else fresh_value
    kept = [profile[c] for c in profile.columns if c != key and c not in new_columns]
    return joined.select(F.coalesce(profile[key], F.col("__key")).alias(key), *kept,
                         *[merged(c).alias(c) for c in new_columns])


def project_profile(profile: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """The listed columns; a column no run has written yet reads as null."""
    known = set(profile.columns)
    return profile.select(key, *[
        F.col(c) if c in known else F.lit(None).cast("string").alias(c) for c in columns])


def read_view(profile: DataFrame) -> DataFrame:
    return project_profile(profile, L.PROFILE_VIEW)


def export_view(profile: DataFrame) -> DataFrame:
    return project_profile(profile, L.PROFILE_EXPORT)


@dataclass(frozen=True)
class ProfileStore:
    """Parquet versions of the profile under one root; the newest one counts.

    Rows are written to a folder of their own, which then becomes the next version by a
    rename that fails when that version exists. So a failed run never damages what readers
    see, and of two programs that start from the same version the later one reads the
    other's version and merges its update anew: no update is lost. With ``buckets`` (at
    least the shuffle width of the session) versions are bucketed by id: an upsert then
    shuffles only its update, never the stored profile, and its result is already split
    the way it is written.
    """

    spark: SparkSession
    root: str
    buckets: int | None = None

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, name: str) -> dict[int, tuple[str, str]]:
        """version -> (folder, file) of the files that fit a pattern below the versions."""
        pattern, files = self._path(f"version=*/{name}")
        found = {}
        for file in files.globStatus(pattern) or []:
            folder = file.getPath().getParent()
            found[int(folder.getName().removeprefix("version="))] = (folder.toString(), file.getPath().getName())
        return dict(sorted(found.items()))

    def versions(self) -> list[int]:
        return list(self._listed("_SUCCESS"))

    def read(self, version: int | None = None, bucketed: bool = True) -> DataFrame | None:
        """The newest version, or the one asked for. Frames that are to be united must not be
        ``bucketed``: Spark 4.1 takes a union of buckets as bucketed, then reads them without."""
        folders = self._listed("_SUCCESS")
        version = max(folders, default=None) if version is None else version
        if version is None:
            return None
        path, marker = folders[version][0], self._listed("_buckets-*").get(version)
        stored = self.spark.read.parquet(path)
        if marker is None or not bucketed:
            return stored
        _, buckets, run = marker[1].split("-")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
        # only a table carries buckets; named after this reading alone, it is dropped once resolved
        table = f"profile_{run}_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION {text(path)}")
        try:
            return self.spark.table(table)
        finally:
            self.spark.sql(f"DROP TABLE {table}")

    def write(self, profile: DataFrame) -> int:
        """Replaces the whole profile."""
        run = self._written(profile.repartition(self.buckets, "id") if self.buckets else profile)
        version = max(self.versions(), default=0) + 1
        while not self._published(run, version):
            version += 1
        return version

    def _written(self, profile: DataFrame) -> str:
        """Name of the new folder that holds the rows."""
        run = uuid.uuid4().hex
        name = f"run-{run}"
        if not self.buckets:
            profile.write.parquet(f"{self.root}/{name}")
            return name
        (profile.write.format("parquet").bucketBy(self.buckets, "id").sortBy("id")
         .option("path", f"{self.root}/{name}").saveAsTable(f"profile_{run}"))
        self.spark.sql(f"DROP TABLE profile_{run}")  # the files stay
        path, files = self._path(f"{name}/_buckets-{self.buckets}-{run}")
        files.create(path, False).close()
        return name

    def _published(self, run: str, version: int) -> bool:
        """Whether the folder became this version; not when another program was first."""
        path, _ = self._path(run)
        target, files = self._path(f"version={version:08d}")
        if files.exists(target):
            return False
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getUri(), self.spark._jsc.hadoopConfiguration())
        no_overwriting = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(path), context.makeQualified(target), no_overwriting)
        except Py4JJavaError:
            if files.exists(target):
                return False
            raise
        return True

    def upsert(self, update: DataFrame) -> int:
        fresh = update.where(F.col("id").isNotNull())
        while True:
            base = max(self.versions(), default=None)
            if base is None:
                run = self._written(fresh.repartition(self.buckets, "id") if self.buckets else fresh)
            else:
                run = self._written(upsert(self.read(base), fresh))
            version = (base or 0) + 1
            if self._published(run, version):
                return version
            path, files = self._path(run)
            files.delete(path, True)  # our own attempt, on a version that is no longer the newest
            if version not in self.versions():
                raise FileExistsError(f"{self.root}/version={version:08d} is there but not complete")
