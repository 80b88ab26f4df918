"""Change streams: ordered transactions applied with effect-once semantics.

A change row: commit_lsn long, seq long, op (insert, update, delete, truncate), schema, table, record map<string,string>,
old_record map<string,string>. Columns that a record lacks keep their value. Data and watermark are committed in one
manifest, and transactions at or below the watermark are skipped, so a batch that Spark delivers again changes nothing.

The fold is one aggregate of maxima over (lsn, seq), summed where the changes are before anything is shuffled, so a key with
a third of all changes is one row per task: a delete forgets what came before, later values win column by column. Truncates are barriers: per table only what follows the last one counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenantgraph import telemetry
from tenantgraph.errors import CdcError, GraphError
from tenantgraph.resource import Resource
from tenantgraph.sources.scan import decoded
from tenantgraph.sources.store import Store, Transaction

SCHEMA = "commit_lsn long, seq long, op string, schema string, `table` string, record map<string,string>, old_record map<string,string>"


@dataclass(frozen=True)
class MirrorSpec:
    resource: Resource
    table: str
    schema: str = "public"
    skip: tuple[str, ...] = ()
    on_truncate: str = "halt"
    columns: dict[str, str] = field(default_factory=dict)  # source column -> attribute, where they differ

    def __post_init__(self) -> None:
        r = self.resource
        if r.tenancy == "context" or self.on_truncate not in ("halt", "mirror"):
            raise CdcError("invalid_mirror", field=r.label)
        if not r.pk or any(r.by_name[k].sensitive or k in self.skip for k in r.pk):
            raise CdcError("invalid_mirror_key", field=r.label)

    def source_of(self, attribute: str) -> str:
        return next((s for s, a in self.columns.items() if a == attribute), attribute)


def index(specs: list[MirrorSpec]) -> dict[tuple[str, str], MirrorSpec]:
    out = {(s.schema or "public", s.table): s for s in specs}
    if not specs or len(out) != len(specs):
        raise CdcError("empty_index" if not specs else "duplicate_source")
    return out


def folded(changes: DataFrame, spec: MirrorSpec) -> DataFrame:
    """One row per key that the changes touch: the key, __tg_gone (what was there before is forgotten), __tg_live, and for each
    attribute the last value that was given, with whether one was given."""
    r = spec.resource
    keys = r.pk + [r.discriminator] * (r.tenancy == "attribute" and r.discriminator not in r.pk)
    at = F.struct(F.col("commit_lsn").alias("l"), F.col("seq").alias("s"))
    rows = changes.withColumn("at", at)
    barrier = rows.where("op = 'truncate'").agg(F.max("at").alias("barrier"))
    rows = rows.where("op <> 'truncate'").join(F.broadcast(barrier)).where(F.col("barrier").isNull() | (F.col("at") > F.col("barrier")))  # one row
    of = lambda record, k: F.element_at(F.col(record), spec.source_of(k))
    removal = (F.col("op") == "delete") | (F.col("op") == "update") & F.col("old_record").isNotNull() & _any([F.element_at("old_record", spec.source_of(k)).isNotNull() & ~of("old_record", k).eqNullSafe(of("record", k)) for k in keys])
    old = lambda k: F.coalesce(F.element_at("old_record", spec.source_of(k)), F.element_at("record", spec.source_of(k)))
    gone = rows.where(removal).select(*[old(k).alias(k) for k in keys], "at", F.lit(0).alias("step"), F.lit(None).cast("map<string,string>").alias("given"))
    put = rows.where("op <> 'delete'").select(*[of("record", k).alias(k) for k in keys], "at", F.lit(1).alias("step"), F.col("record").alias("given"))
    both = gone.unionByName(put).withColumn("at", F.struct("at", "step"))
    values = [c for c in r.stored if c not in keys and c not in spec.skip]
    has = lambda c: F.map_contains_key("given", F.lit(spec.source_of(c)))
    out = both.groupBy(*keys).agg(
        F.max(F.when(F.col("step") == 0, F.col("at"))).alias("last_gone"), F.max(F.when(F.col("step") == 1, F.col("at"))).alias("last_put"),
        *[F.max(F.when(has(c), F.struct("at", F.element_at("given", spec.source_of(c)).alias("v")))).alias(f"__tg_{c}") for c in values],
    )
    stands = lambda at: at.isNotNull() & (F.col("last_gone").isNull() | (at > F.col("last_gone")))
    return out.select(
        *[F.col(k).cast(r.schema[k].dataType).alias(f"__tg_k_{k}") for k in keys], F.col("last_gone").isNotNull().alias("__tg_gone"), stands(F.col("last_put")).alias("__tg_live"),
        *[F.when(stands(F.col(f"__tg_{c}")["at"]), F.struct(F.col(f"__tg_{c}")["v"].alias("v"))).alias(f"__tg_{c}") for c in values],
    )


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def mirrored(old: DataFrame, changes: DataFrame, spec: MirrorSpec, truncated: bool = False) -> DataFrame:
    """The mirror's rows after the changes."""
    r = spec.resource
    keys = r.pk + [r.discriminator] * (r.tenancy == "attribute" and r.discriminator not in r.pk)
    new = folded(changes, spec)
    old = old.limit(0) if truncated else old
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"`{k}`").eqNullSafe(F.col(f"__tg_k_{k}"))
    both = old.withColumn("__tg_old", F.lit(True)).join(new, match, "full_outer")
    untouched, fresh = F.col("__tg_live").isNull(), F.coalesce("__tg_gone", F.lit(False)) | F.col("__tg_old").isNull()
    columns = []
    for c in r.stored:
        if c in keys:
            columns.append(F.coalesce(F.col(f"`{c}`"), F.col(f"__tg_k_{c}")).alias(c))
            continue
        if c in spec.skip:
            columns.append(F.when(untouched | ~fresh, F.col(f"`{c}`")).alias(c))
            continue
        given = F.col(f"__tg_{c}")
        columns.append(F.when(untouched, F.col(f"`{c}`")).when(given.isNotNull(), given["v"].cast(r.schema[c].dataType)).when(fresh, F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c))
    return both.where(untouched | F.col("__tg_live")).select(*columns)


def check(changes: DataFrame, specs: dict[tuple[str, str], MirrorSpec]) -> None:
    """One pass over the batch: a null key, a missing tenant, a sensitive column or a truncate that halts stops it whole."""
    faults = F.lit(None).cast("string")
    for (schema, table), s in specs.items():
        mine = (F.coalesce("schema", F.lit("public")) == schema) & (F.col("table") == table)
        key = _any([F.element_at("record", s.source_of(k)).isNull() & (F.col("op") != "delete") | F.coalesce(F.element_at("old_record", s.source_of(k)), F.element_at("record", s.source_of(k))).isNull() & (F.col("op") == "delete") for k in s.resource.pk])
        key = key & (F.col("op") != "truncate")
        faults = F.when(mine & (F.col("op") == "truncate") & F.lit(s.on_truncate == "halt"), "truncate_halted").otherwise(faults)
        for a in s.resource.attributes:
            if a.sensitive and a.name not in s.skip and not a.skip:
                faults = F.when(mine & F.coalesce(F.map_contains_key("record", F.lit(s.source_of(a.name))), F.lit(False)), "sensitive_column").otherwise(faults)
        if s.resource.tenancy == "attribute":
            d = s.source_of(s.resource.discriminator)
            tenant = F.coalesce(F.element_at("record", d), F.element_at("old_record", d))
            faults = F.when(mine & (F.col("op") != "truncate") & (tenant.isNull() | (F.trim(tenant) == "") | (tenant == "false")), "tenant_required").otherwise(faults)
        faults = F.when(mine & key, "key_required").otherwise(faults)
    bad = changes.select(faults.alias("fault")).where("fault is not null").limit(1).collect()
    if bad:
        raise CdcError(bad[0]["fault"])


def apply(store: Store, changes: DataFrame, specs: list[MirrorSpec], slot: str, database: str | None = None) -> int | None:
    """Applies the transactions above the slot's watermark, all or none; the watermark after it. The watermark is read in the state that
    the commit replaces, so of two appliers one commits and the other begins again from there."""
    by = index(specs)

    def work(tx: Transaction) -> int | None:
        before = tx.watermarks.get(slot, tx.base["watermarks"].get(slot))
        fresh = (changes.where(F.col("commit_lsn") > before) if before is not None else changes).persist()
        kept.append(fresh)
        top = fresh.agg(F.max("commit_lsn")).first()[0]
        if top is None:
            return before
        check(fresh, by)
        for (schema, table), s in by.items():
            mine = fresh.where((F.coalesce("schema", F.lit("public")) == schema) & (F.col("table") == table))
            ops = {x["op"] for x in mine.select("op").distinct().collect()}  # four at most
            if ops:
                keys = [c for c in folded(mine, s).columns if c.startswith("__tg_k_")]
                touched = None if "truncate" in ops else folded(mine, s).select(*[F.col(c).alias(c.removeprefix("__tg_k_")) for c in keys])
                store.put(tx, s.resource, lambda old, mine=mine, s=s, ops=ops: mirrored(old, mine, s, "truncate" in ops), touched)
        tx.watermarks[slot] = int(top)
        return int(top)

    kept: list[DataFrame] = []
    try:
        top = store.retried(database, work)
        telemetry.emit("cdc", operation="apply", outcome="ok")
        return top
    except GraphError:
        raise
    except Exception:  # noqa: BLE001
        raise CdcError("sink_failed") from None
    finally:
        for df in kept:
            df.unpersist()


def start(store: Store, changes: DataFrame, specs: list[MirrorSpec], slot: str, checkpoint: str, *, available_now: bool = False) -> StreamingQuery:
    """changes: a streaming DataFrame of change rows. The stream's own checkpoint is an offset cache; the manifest decides."""
    index(specs)
    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: apply(store, df, specs, slot) and None)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def check_rows(rows: DataFrame, spec: MirrorSpec) -> None:
    """What check() asks of changes, of a table's rows: no sensitive column, a key and a tenant everywhere, and each key once."""
    r = spec.resource
    for a in r.attributes:
        if a.sensitive and a.name not in spec.skip and not a.skip and spec.source_of(a.name) in rows.columns:
            raise CdcError("sensitive_column", field=a.name)
    keys = r.pk + [r.discriminator] * (r.tenancy == "attribute" and r.discriminator not in r.pk)
    if missing := [k for k in keys if spec.source_of(k) not in rows.columns]:
        raise CdcError("tenant_required" if missing == [r.discriminator] else "key_required")
    of = lambda k: F.col(f"`{spec.source_of(k)}`")
    faults = F.when(_any([of(k).isNull() for k in r.pk]), "key_required")
    if r.tenancy == "attribute":
        tenant = of(r.discriminator).cast("string")
        faults = faults.when(tenant.isNull() | (F.trim(tenant) == "") | (tenant == "false"), "tenant_required")
    if bad := rows.select(faults.alias("fault")).where("fault is not null").limit(1).collect():
        raise CdcError(bad[0]["fault"])
    if not rows.groupBy(*[of(k) for k in keys]).count().where("count > 1").isEmpty():
        raise CdcError("repeated_key")


def snapshot(store: Store, tables: dict[str | tuple[str, str], DataFrame], specs: list[MirrorSpec], slot: str, lsn: int, database: str | None = None) -> None:
    """Bootstrap: each mirror is replaced by its table's rows, checked as changes are, and the watermark appears with them. tables: by
    (schema, table), or by the table's name alone where no other schema has it."""
    by = index(specs)
    names = [t for _, t in by]

    def work(tx: Transaction) -> None:
        for (schema, table), s in by.items():
            rows = tables.get((schema, table))
            if rows is None and names.count(table) == 1:
                rows = tables.get(table)
            if rows is None:
                raise CdcError("missing_table", field=s.resource.label)
            check_rows(rows, s)
            own = [F.col(f"`{s.source_of(c)}`").alias(c) for c in s.resource.stored if s.source_of(c) in rows.columns and c not in s.skip]
            store.put(tx, s.resource, lambda old, rows=rows, own=own, s=s: decoded(rows.select(*own), s.resource))
        tx.watermarks[slot] = lsn

    try:
        store.retried(database, work)
    except GraphError:
        raise
    except Exception:  # noqa: BLE001
        raise CdcError("sink_failed") from None


def start_mode(store: Store, slot: str, database: str | None = None) -> str:
    """snapshot where there is no watermark, else resume. A watermark that can't be read refuses: a snapshot would undo what is there."""
    try:
        return "snapshot" if store.watermark(slot, database) is None else "resume"
    except Exception:  # noqa: BLE001
        raise CdcError("watermark_unreadable") from None
