"""A snapshot store over Parquet: immutable snapshots in buckets, and a manifest per database that names the current ones.

A label's rows lie in buckets by the hash of their identity. A write that tells the keys it touches reads and writes their
buckets alone; the others stay the files they are. A commit writes the changed buckets and then creates the next manifest's
file, which only one writer can do. The loser sees ConcurrentModification and tries again on the new state. All labels of a
commit, and the watermarks of change streams, change together because they lie in one manifest. Old files stay, for readers
that began before, until vacuum() removes what the last manifests don't name.

Files go through Hadoop's file system. Only one writer may create a version's lock: HDFS and local files see to that; on an
object store it takes a client whose createNewFile is conditional, or one writer at a time.
"""

from __future__ import annotations

import contextvars
import json
import random
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantgraph import telemetry
from tenantgraph.errors import ConcurrentModification, QueryFailed, UpdateFailed
from tenantgraph.resource import Resource
from tenantgraph.sources.scan import decoded

ATTEMPTS, JITTER, LEASE = 5, 0.1, 600.0
BUCKET = "__tg_bucket"
_current: contextvars.ContextVar[Transaction | None] = contextvars.ContextVar("tenantgraph_transaction", default=None)


@dataclass
class Transaction:
    """staged: a label's new rows; touched: the buckets that they replace, all if it isn't there."""

    database: str | None
    base: dict[str, Any]
    staged: dict[str, DataFrame]
    watermarks: dict[str, int]
    touched: dict[str, frozenset[int]] = field(default_factory=dict)
    resources: dict[str, Resource] = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # Files

    def _fs(self, path: str) -> tuple[Any, Any]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _folder(self, database: str | None) -> str:
        return f"{self.root}/{database or '_default'}"

    def _versions(self, database: str | None) -> list[int]:
        fs, p = self._fs(f"{self._folder(database)}/_manifest")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def manifest(self, database: str | None = None, version: int | None = None) -> dict[str, Any]:
        versions = self._versions(database) if version is None else [version]
        if not versions:
            return {"version": 0, "labels": {}, "watermarks": {}}
        fs, p = self._fs(f"{self._folder(database)}/_manifest/{versions[-1]:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(b & 0xFF for b in stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, database: str | None, manifest: dict[str, Any]) -> None:
        """Writes aside, then renames to the version's name; a name that is taken means that another writer was first."""
        folder = f"{self._folder(database)}/_manifest"
        fs, aside = self._fs(f"{folder}/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        _, lock = self._fs(f"{folder}/.lock-{manifest['version']:012d}")
        _, name = self._fs(f"{folder}/{manifest['version']:012d}.json")
        if not fs.createNewFile(lock):
            fs.delete(aside, False)
            if not fs.exists(name):
                self._break_stale(fs, lock)
            raise ConcurrentModification("concurrent_modification")
        if fs.exists(name) or not fs.rename(aside, name):
            raise ConcurrentModification("concurrent_modification")

    def _break_stale(self, fs: Any, lock: Any) -> None:
        """A writer that died between lock and rename would stop all later ones; its lock goes, by rename, which one caller can do, after the lease."""
        try:
            if time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > LEASE:
                fs.rename(lock, self._fs(f"{lock.getParent()}/.stale-{uuid.uuid4().hex}")[1])
        except Exception:  # noqa: BLE001 - another caller was first
            return

    # Reading

    def _bucket(self, resource: Resource, n: int) -> Column:
        keys = resource.pk + [resource.discriminator] * (resource.tenancy == "attribute" and resource.discriminator not in resource.pk)
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int") if keys else F.lit(0)

    def _rows(self, resource: Resource, entry: dict[str, Any] | None, but: frozenset[int] = frozenset(), only: frozenset[int] | None = None) -> DataFrame:
        paths = [p for b, p in (entry or {"paths": {}})["paths"].items() if int(b) not in but and (only is None or int(b) in only)]
        if not paths:
            return self.spark.createDataFrame([], resource.schema)
        return decoded(self.spark.read.option("mergeSchema", "true").parquet(*paths), resource)

    def scan(self, resource: Resource, database: str | None, manifest: dict[str, Any] | None = None) -> DataFrame:
        tx = _current.get()
        if not tx or tx.database != database:
            return self._rows(resource, (manifest or self.manifest(database))["labels"].get(resource.label))
        tx.resources.setdefault(resource.label, resource)
        entry = tx.base["labels"].get(resource.label)
        if resource.label not in tx.staged:
            return self._rows(resource, entry)
        staged = decoded(tx.staged[resource.label], resource)
        touched = tx.touched.get(resource.label)
        return staged if touched is None else staged.unionByName(self._rows(resource, entry, but=touched))

    def pinned(self) -> Pinned:
        """A source that reads one state of each database, whatever is committed meanwhile."""
        return Pinned(self, {})

    def watermark(self, slot: str, database: str | None = None) -> int | None:
        return self.manifest(database)["watermarks"].get(slot)

    # Writing

    def _commit(self, tx: Transaction) -> None:
        labels = dict(tx.base["labels"])
        for label, df in tx.staged.items():
            path = f"{self._folder(tx.database)}/data/{label}/{uuid.uuid4().hex}"
            resource, old = tx.resources.get(label), labels.get(label)
            touched = tx.touched.get(label)
            n = old["buckets"] if touched is not None else self.buckets if resource else 1
            bucket = self._bucket(resource, n) if resource else F.lit(0)
            rows = decoded(df, resource) if resource else df
            rows.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(path)
            fs, p = self._fs(path)
            new = {x.getPath().getName().partition("=")[2]: f"{path}/{x.getPath().getName()}" for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName().startswith(BUCKET)}
            kept = {b: x for b, x in old["paths"].items() if int(b) not in touched} if touched is not None else {}
            labels[label] = {"buckets": n, "paths": kept | new}
        for slot, lsn in tx.watermarks.items():
            if lsn < tx.base["watermarks"].get(slot, lsn):
                raise UpdateFailed("watermark_lowered")
        self._publish(tx.database, {"version": tx.base["version"] + 1, "labels": labels, "watermarks": tx.base["watermarks"] | tx.watermarks})

    def put(self, tx: Transaction, resource: Resource, change: Callable[[DataFrame], DataFrame], keys: DataFrame | None = None) -> None:
        """Stages change(rows). keys: the identities that the change may touch, read or make; then it sees the rows of their buckets alone."""
        label = resource.label
        entry = tx.base["labels"].get(label)
        tx.resources[label] = resource
        if keys is None or entry is None or label in tx.staged and label not in tx.touched:
            tx.staged[label] = change(self.scan(resource, tx.database))
            tx.touched.pop(label, None)
            return
        bucket, n = self._bucket(resource, entry["buckets"]), entry["buckets"]
        asked = frozenset(r[0] for r in decoded(keys, resource).select(bucket).distinct().collect())  # as many as there are buckets at most
        before = tx.touched.get(label, frozenset())
        if label in tx.staged:
            rows = self.scan(resource, tx.database).where(bucket.isin(*asked)) if asked else self.scan(resource, tx.database).limit(0)
            tx.staged[label] = decoded(tx.staged[label], resource).where(~bucket.isin(*asked) if asked else F.lit(True)).unionByName(decoded(change(rows), resource))
        else:
            tx.staged[label] = change(self._rows(resource, entry, only=asked))
        tx.touched[label] = before | asked

    @contextmanager
    def transaction(self, database: str | None = None):
        """Stages writes and commits once at the end; an exception discards them. An inner transaction joins the outer."""
        outer = _current.get()
        if outer:
            if outer.database != database:
                raise UpdateFailed("cross_database_transaction")
            yield outer
            return
        tx = Transaction(database, self.manifest(database), {}, {})
        token = _current.set(tx)
        try:
            yield tx
            if tx.staged or tx.watermarks:
                self._commit(tx)
        finally:
            _current.reset(token)

    def write(self, resource: Resource, database: str | None, change: Callable[[DataFrame], DataFrame], keys: DataFrame | None = None) -> None:
        """Replaces a label's rows by change(rows). Outside a transaction the change is tried again on the new state after a conflict.
        keys: rows with the identities that the change may touch, read or make, where they are known."""
        with telemetry.span("write", resource=resource.label):
            self.retried(database, lambda tx: self.put(tx, resource, change, keys))

    def retried(self, database: str | None, work: Callable[[Transaction], Any]) -> Any:
        """work in a transaction, again on the new state after a conflict; within an outer transaction once, as part of it."""
        for attempt in range(ATTEMPTS):
            try:
                with self.transaction(database) as tx:
                    return work(tx)
            except ConcurrentModification:
                if _current.get() or attempt == ATTEMPTS - 1:
                    raise
                time.sleep(random.uniform(0, min(0.005 * 2**attempt, JITTER)))

    def vacuum(self, database: str | None = None, keep: int = 2, age: float = 86_400.0) -> int:
        """Deletes snapshots that the last `keep` manifests don't name, and the manifests before those, if older than `age` seconds,
        which must be longer than any reader or writer takes. The number of folders that went."""
        versions = self._versions(database)
        named = {p.rsplit("/", 1)[0] for v in versions[-keep:] for entry in self.manifest(database, v)["labels"].values() for p in entry["paths"].values()}
        fs, data = self._fs(f"{self._folder(database)}/data")
        before, gone = (time.time() - age) * 1000, 0
        for label in fs.listStatus(data) if fs.exists(data) else ():
            for x in fs.listStatus(label.getPath()):
                if f"{self._folder(database)}/data/{label.getPath().getName()}/{x.getPath().getName()}" not in named and x.getModificationTime() < before:
                    gone += bool(fs.delete(x.getPath(), True))
        for v in versions[:-keep]:
            _, p = self._fs(f"{self._folder(database)}/_manifest/{v:012d}.json")
            if fs.getFileStatus(p).getModificationTime() < before:
                fs.delete(p, False)
        return gone

    def clear(self, resource: Resource, database: str | None = None) -> None:
        if not database and resource.tenancy == "context":
            raise QueryFailed("tenant_required")
        self.write(resource, database, lambda rows: rows.limit(0))


@dataclass(frozen=True)
class Pinned:
    store: Store
    manifests: dict[str | None, dict[str, Any]]

    def scan(self, resource: Resource, database: str | None) -> DataFrame:
        if database not in self.manifests:
            self.manifests[database] = self.store.manifest(database)
        return self.store.scan(resource, database, self.manifests[database])
