"""Keyed store with a compacted base, levelled deltas, conditional writes and a change history.

A store is a folder.  ``base-…`` holds every key once, in buckets of the key,
sorted; ``delta-…`` folders hold later upserts and deletions; ``history-…``
folders hold refused changes.  Manifests ``manifest/N.json`` say which folders
belong to version N.

* Reading joins the base with the few deltas on the key.  The base is bucketed
  by the key, so only the deltas are shuffled, into the buckets of the base.
* ``fan`` deltas of one level are merged into one of the next; ``compact`` merges
  all deltas into a new base, again without moving the old one, unless it has
  outgrown its buckets.
* A delta holds each key once, so merging moves and sorts every row once, uncombined.
* A version is published by creating its manifest, which fails if the manifest
  is there already: of two writers that start from one version, one commits and
  the other gets ``Conflict`` and has changed nothing.  Readers keep the version
  they began with, since folders of earlier versions stay until ``vacuum``.
* A writer who must not overwrite unseen changes states the ``row_version`` that
  it has read per row.  Rows that have another one by now are refused, and every
  field that would have changed is kept as a history candidate.

The atomic step is the exclusive creation of a file, as HDFS and local file
systems have it; an object store needs a connector that offers it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripweave.operators.keyvalue import KEYS, has_key, pick_per_key

GONE = "_deleted"
VERSION = "row_version"
BUCKET_BYTES = 32 << 20  # of files; a base gets more buckets where they would hold more than twice that


class Conflict(RuntimeError):
    """Another writer has published the version that this one was to be."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    base: str | None = None
    schema: str | None = None  # of the base, as JSON
    buckets: int = 0
    deltas: list[dict] = field(default_factory=list)  # folder, level, batch (the highest inside); newest last
    history: list[str] = field(default_factory=list)
    batch: int = 0  # highest batch that is in


class Store:
    """A keyed store below ``path``; ``buckets`` and ``fan`` are used when it grows."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = KEYS, buckets: int = 16, fan: int = 4):
        self.spark, self.path, self.keys, self.buckets, self.fan = spark, path.rstrip("/"), list(keys), buckets, fan

    # --- versions ---------------------------------------------------------------

    def _hadoop(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def manifest(self, version: int | None = None) -> Manifest:
        """A published version, the newest by default; version 0 is the empty store."""
        if version is None:
            fs, folder = self._hadoop("manifest")
            names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
            version = max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)
        if not version:
            return Manifest()
        fs, path = self._hadoop(f"manifest/{version}.json")
        stream = fs.open(path)
        try:
            return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def _publish(self, before: Manifest, **changes) -> Manifest:
        after = replace(before, version=before.version + 1, **changes)
        fs, path = self._hadoop(f"manifest/{after.version}.json")
        if fs.exists(path):
            raise Conflict(f"version {after.version} is published already")
        try:
            stream = fs.create(path, False)
        except Exception as error:  # the file appeared in between
            raise Conflict(f"version {after.version} is published already") from error
        try:
            stream.write(bytearray(json.dumps(asdict(after)).encode()))
        finally:
            stream.close()
        return after

    def _new(self, kind: str) -> str:
        return f"{kind}-{uuid.uuid4().hex[:12]}"

    # --- reading ----------------------------------------------------------------

    def _base(self, known: Manifest) -> DataFrame | None:
        """The base as a bucketed table; another session registers it anew from its files."""
        if known.base is None:
            return None
        name = "store_" + hashlib.md5(f"{self.path}/{known.base}".encode()).hexdigest()
        if not self.spark.catalog.tableExists(name):
            schema = StructType.fromJson(json.loads(known.schema))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            try:
                self.spark.sql(
                    f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                    f"INTO {known.buckets} BUCKETS LOCATION '{self.path}/{known.base}'"
                )
            except AnalysisException:  # registered by another thread
                if not self.spark.catalog.tableExists(name):
                    raise
        return self.spark.table(name)

    def _deltas(self, deltas: Sequence[dict], buckets: int | None = None) -> DataFrame | None:
        """Newest row of every key in some deltas, deletions included; later folders win.  They lie in ``buckets`` of the key, if told."""
        rows = None
        for order, delta in enumerate(deltas):
            own = self.spark.read.parquet(f"{self.path}/{delta['folder']}").withColumn("_order", F.lit(order))
            rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
        if rows is None:
            return None
        if buckets is not None:
            rows = rows.repartition(buckets, *self.keys)
        # a key has one row per delta at most: nothing to combine before the shuffle
        newer = F.lead("_order").over(Window.partitionBy(*self.keys).orderBy("_order"))
        return rows.withColumn("_newer", newer).where("_newer IS NULL").drop("_newer", "_order")

    def _merged(self, known: Manifest, buckets: int | None = None) -> DataFrame | None:
        """All rows of a version; ``buckets`` of the key deal them out where there is no base yet."""
        base, deltas = self._base(known), self._deltas(known.deltas, known.buckets or buckets)
        if base is None or deltas is None:
            rows = base if deltas is None else deltas.where(~F.col(GONE)).drop(GONE)
            return rows
        old, new = [c for c in base.columns if c not in self.keys], [c for c in deltas.columns if c not in self.keys]
        left = base.select(*self.keys, F.struct(*old).alias("_old"))
        right = deltas.select(*self.keys, F.struct(*new).alias("_new"))
        both = left.join(right, self.keys, "full_outer").where(F.coalesce(~F.col(f"_new.{GONE}"), F.lit(True)))

        def newest(column: str) -> Column:
            one = F.col(f"_new.`{column}`") if column in new else F.lit(None)
            other = F.col(f"_old.`{column}`") if column in old else F.lit(None)
            return F.when(F.col("_new").isNotNull(), one).otherwise(other).alias(column)

        return both.select(*self.keys, *(newest(c) for c in [*old, *(c for c in new if c not in old and c != GONE)]))

    def current(self, version: int | None = None) -> DataFrame | None:
        """All rows of a version, one per key; None while the store is empty."""
        return self._merged(self.manifest(version))

    def history(self) -> DataFrame | None:
        """Refused changes: keys, field, stored, offered, expected_version, found_version, batch."""
        folders = self.manifest().history
        return self.spark.read.parquet(*(f"{self.path}/{f}" for f in folders)) if folders else None

    # --- writing ----------------------------------------------------------------

    def append(self, items: DataFrame, batch: int, order: Sequence[str], deleted: Column | None = None) -> Manifest:
        """Publishes one batch of upserts, the last row in ``order`` per key; ``deleted`` marks rows that remove their key.

        A batch that is in already, or is older, changes nothing, so a retry is safe.
        Rows without key are left out.
        """
        known = self.manifest()
        if batch <= known.batch:
            return known
        marked = items.withColumn(GONE, F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False)))
        rows = marked.where(has_key(self.keys)).withColumn("_order", F.struct(*order))
        return self._add(known, pick_per_key(rows, self.keys, F.col("_order")).drop("_order"), batch)

    def _add(self, known: Manifest, rows: DataFrame, batch: int, history: Sequence[str] = ()) -> Manifest:
        folder = self._new("delta")
        rows.write.parquet(f"{self.path}/{folder}")
        deltas = [*known.deltas, {"folder": folder, "level": 0, "batch": batch}]
        return self._publish(known, deltas=deltas, batch=batch, history=[*known.history, *history])

    def write_if(self, changes: DataFrame, batch: int, expected: str = "expected_version", since: int | None = None) -> Manifest:
        """Publishes the changed rows whose stored ``row_version`` is the ``expected`` one; refuses the others.

        ``changes`` holds whole rows, one per key; a null expectation stands for a
        key that is not stored.  Accepted rows get the next row version.  Refused
        rows become one history candidate per field that differs.  ``since`` is
        the store's version that the writer has read: if another one has been
        published meanwhile, nothing is written and ``Conflict`` is raised.
        """
        known = self.manifest()
        if since is not None and known.version != since:
            raise Conflict(f"version {known.version} was published after {since}")
        if batch <= known.batch:
            return known
        values = [c for c in changes.columns if c not in (*self.keys, expected, VERSION)]
        offered = changes.where(has_key(self.keys)).select(
            *self.keys, F.col(expected).cast("long").alias("_expected"), F.struct(*values).alias("_offered")
        )
        now = self._merged(known)
        if now is None:
            now = self.spark.createDataFrame([], offered.select(*self.keys, "_offered.*").withColumn(VERSION, F.lit(0).cast("long")).schema)
        if VERSION not in now.columns:  # stored by plain batches
            now = now.withColumn(VERSION, F.lit(0).cast("long"))
        stored = now.select(*self.keys, F.struct(*(c for c in now.columns if c not in self.keys)).alias("_stored"))
        met = stored.join(offered, self.keys, "right")
        found = F.when(F.col("_stored").isNotNull(), F.coalesce(F.col(f"_stored.{VERSION}"), F.lit(0).cast("long")))
        met = met.withColumn("_found", found).withColumn("_fits", F.col("_found").eqNullSafe(F.col("_expected")))
        met.write.parquet(f"{self.path}/{(work := self._new('work'))}")
        judged = self.spark.read.schema(met.schema).parquet(f"{self.path}/{work}")
        kept = [c for c in now.columns if c not in (*self.keys, VERSION, *values)]  # fields that the change does not name stay
        accepted = judged.where("_fits").select(
            *self.keys, "_offered.*", *(F.col(f"_stored.`{c}`").alias(c) for c in kept),
            (F.coalesce("_found", F.lit(0).cast("long")) + 1).alias(VERSION), F.lit(False).alias(GONE),
        )
        candidates = F.array(*(
            F.struct(
                F.lit(c).alias("field"),
                (F.col(f"_stored.`{c}`") if c in now.columns else F.lit(None)).cast("string").alias("stored"),
                F.col(f"_offered.`{c}`").cast("string").alias("offered"),
                F.col("_expected").alias("expected_version"),
                F.col("_found").alias("found_version"),
            )
            for c in values
        ))
        refused = judged.where("NOT _fits").select(*self.keys, F.explode(candidates).alias("c"))
        refused = refused.where("NOT (c.stored <=> c.offered)").select(*self.keys, "c.*", F.lit(batch).cast("long").alias("batch"))
        folder = self._new("history")
        refused.write.parquet(f"{self.path}/{folder}")
        return self._add(known, accepted, batch, [folder])

    # --- maintenance ------------------------------------------------------------

    def tidy(self) -> Manifest:
        """Merges the deltas of a level, wherever ``fan`` of them have come together, into one of the next level."""
        known = self.manifest()
        deltas = list(known.deltas)
        for level in range(max((d["level"] for d in deltas), default=-1) + 1):
            # levels fall from the oldest to the newest, so those of a level are neighbours
            own = [d for d in deltas if d["level"] == level]
            if len(own) >= self.fan:
                folder = self._new("delta")
                self._deltas(own).write.parquet(f"{self.path}/{folder}")
                at = deltas.index(own[0])
                deltas[at : at + len(own)] = [{"folder": folder, "level": level + 1, "batch": own[-1]["batch"]}]
        return known if deltas == known.deltas else self._publish(known, deltas=deltas)

    def _fitting_buckets(self, known: Manifest) -> int:
        """Buckets of the next base: as many as now, or more once they would hold more than twice BUCKET_BYTES each."""
        held = 0
        for folder in [*([known.base] if known.base else []), *(d["folder"] for d in known.deltas)]:
            fs, path = self._hadoop(folder)
            held += fs.getContentSummary(path).getLength()
        own, fitting = known.buckets or self.buckets, -(-held // BUCKET_BYTES)
        return fitting if fitting > 2 * own else own

    def compact(self) -> Manifest:
        """Merges all deltas into a new base; the old base is read bucket by bucket where it lies."""
        known = self.manifest()
        if not known.deltas:
            return known
        buckets = self._fitting_buckets(known)
        rows = self._merged(known, buckets)
        if known.base is not None and buckets != known.buckets:
            rows = rows.repartition(buckets, *self.keys)
        folder = self._new("base")
        name = "store_" + hashlib.md5(f"{self.path}/{folder}".encode()).hexdigest()
        writer = rows.write.bucketBy(buckets, *self.keys).sortBy(*self.keys).format("parquet")
        writer.option("path", f"{self.path}/{folder}").saveAsTable(name)
        schema = self.spark.table(name).schema.json()
        return self._publish(known, base=folder, schema=schema, buckets=buckets, deltas=[])

    def vacuum(self) -> int:
        """Deletes folders that the newest version does not use; call it when no earlier version is read any more."""
        known = self.manifest()
        used = {known.base, "manifest", *known.history, *(d["folder"] for d in known.deltas)}
        fs, root = self._hadoop("")
        gone = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() not in used]
        for path in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS store_{hashlib.md5(f'{self.path}/{path.getName()}'.encode()).hexdigest()}")
            fs.delete(path, True)
        return len(gone)
