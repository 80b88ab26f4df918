"""The write algebra as functions from rows to rows; a store commits their result in one step.

Identities always include the discriminator of a tenant-scoped resource, and keys compare null-safely. All expressions of
one write see the row as it was.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantgraph import tenancy
from tenantgraph.errors import CreateFailed, InvalidRelationship, StaleRecord, UpdateFailed
from tenantgraph.functions.expr import Compiler, Expr
from tenantgraph.resource import Resource
from tenantgraph.sources.scan import decoded
from tenantgraph.types import literal

NEW = "__tg_new_"


def _settable(r: Resource, name: str, plain: bool = False) -> None:
    """plain: a value that is given as it is, which a sensitive field, always binary, takes; an expression must not reach one."""
    a = r.by_name.get(name)
    if a is None or a.skip or a.sensitive and not plain or name == r.discriminator:
        raise UpdateFailed("field_not_settable", field=name)


def _atomics(r: Resource, atomics: dict[str, Expr], loading: bool = True) -> dict[str, Column]:
    for name in atomics:
        _settable(r, name)
    return {n: Compiler(r, loading=loading).column(e).cast(r.schema[n].dataType) for n, e in atomics.items()}


def identity(r: Resource, keys: list[str] | None = None) -> list[str]:
    keys = list(keys or r.pk)
    if not keys:
        raise UpdateFailed("empty_identity")
    return keys + [r.discriminator] * (r.tenancy == "attribute" and r.discriminator not in keys)


def scoped_rows(r: Resource, rows: DataFrame, tenant: Any) -> DataFrame:
    """Incoming rows with the discriminator forced to the tenant."""
    return rows.withColumn(r.discriminator, F.lit(tenancy.normalise(tenant)).cast(r.schema[r.discriminator].dataType)) if r.tenancy == "attribute" else rows


def _match(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`{NEW}{k}`")) for k in keys])


def _aside(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`").alias(NEW + c) for c in rows.columns])


def bulk_create(r: Resource, old: DataFrame, rows: DataFrame, tenant: Any = None, atomics: dict[str, Expr] | None = None) -> DataFrame:
    """All rows or none."""
    made = decoded(scoped_rows(r, rows, tenant), r)
    for name, c in _atomics(r, atomics or {}).items():
        made = made.withColumn(name, c)
    return old.unionByName(made)


def create(r: Resource, old: DataFrame, row: DataFrame, tenant: Any = None, atomics: dict[str, Expr] | None = None) -> tuple[DataFrame, DataFrame]:
    """(all rows, the row that was made). Exactly one row."""
    if row.limit(2).count() != 1:
        raise CreateFailed("row_count_mismatch")
    made = bulk_create(r, old.limit(0), row, tenant, atomics)
    return old.unionByName(made), made


def guard_unique(r: Resource, old: DataFrame, rows: DataFrame, keys: list[str]) -> None:
    """The store holds no uniqueness itself: a write that would meet more than one row of an identity fails."""
    asked = _aside(rows.select(*keys).distinct())
    if not old.join(asked, _match(keys), "left_semi").groupBy(*[F.col(f"`{k}`") for k in keys]).count().where("count > 1").isEmpty():
        raise UpdateFailed("identity_not_unique")


def upsert(
    r: Resource, old: DataFrame, rows: DataFrame, *, tenant: Any = None, keys: list[str] | None = None, fields: list[str] | None = None, where: Expr | None = None,
    create_atomics: dict[str, Expr] | None = None, update_atomics: dict[str, Expr] | None = None, guard: bool = True, order: str | None = None, outcome: str | None = None,
) -> DataFrame:
    """Rows that match on the identity get `fields`, if `where` holds of the row that is there; the others are created.

    Rows of one batch with the same identity act one after another, in the order of the column `order` (by default that in which
    they lie, which only rows from the driver or a written table keep when a task runs again): the first creates the row if it
    isn't there, each later one sets `fields` on what is then there. Without a condition and update atomics that is the first
    and the last value of each field, summed where the rows are; with them a batch's rows of one identity are folded in one
    task, as each depends on the one before.

    outcome: a column of that name tells created, updated or skipped of the rows that the batch asked for.
    """
    keys = identity(r, keys)
    rows = scoped_rows(r, rows, tenant)
    rows = decoded(rows, r, (F.monotonically_increasing_id() if order is None else F.col(f"`{order}`")).alias("__tg_n"))
    if guard:
        guard_unique(r, old, rows, keys)
    rest = [c for c in r.stored if c not in keys]
    fields = [f for f in (rest if fields is None else fields) if f in rest]
    updated = _atomics(r, update_atomics or {})
    for e in (create_atomics or {}).values():
        _no_hidden(r, e)
    _atomics(r, create_atomics or {})
    value = F.struct(*[F.col(f"`{c}`") for c in r.stored])
    by = [F.col(f"`{k}`").alias(NEW + k) for k in keys]
    if where is None and not updated:
        asked = rows.groupBy(*by).agg(F.min_by(value, "__tg_n").alias("__tg_first"), F.max_by(value, "__tg_n").alias("__tg_last"), F.count(F.lit(1)).alias("__tg_times"))
    else:
        asked = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("__tg_n", value.alias("v")))).alias("__tg_batch")).withColumn("__tg_first", F.col("__tg_batch")[0]["v"])
    both = old.withColumn("__tg_old", F.lit(True)).join(asked.withColumn("__tg_asked", F.lit(True)), _match(keys), "full_outer")
    there, wanted = F.coalesce("__tg_old", F.lit(False)), F.coalesce("__tg_asked", F.lit(False))
    first = lambda name: F.col("__tg_first")[name]
    fresh = {c: Compiler(r, loading=True, of=first).column(create_atomics[c]).cast(r.schema[c].dataType) if c in (create_atomics or {}) else first(c) for c in r.stored}
    if where is None and not updated:
        last = lambda c: F.col("__tg_last")[c]
        new = {c: F.when(there, last(c)).when(F.col("__tg_times") > 1, last(c)).otherwise(fresh[c]) if c in fields else F.when(there, F.col(f"`{c}`")).otherwise(fresh[c]) for c in r.stored}
        hit = F.lit(True)
    else:

        def step(acc: Column, x: Column) -> Column:
            at = lambda name: acc[name]
            own = {n: Compiler(r, loading=True, of=at).column(e).cast(r.schema[n].dataType) for n, e in (update_atomics or {}).items()}
            changed = F.struct(*[(own[c] if c in own else x["v"][c] if c in fields else acc[c]).alias(c) for c in r.stored], F.lit(True).alias("__tg_hit"))
            return F.when(F.coalesce(Compiler(r, of=at).column(where), F.lit(False)) if where is not None else F.lit(True), changed).otherwise(acc)

        begin = F.struct(*[F.when(there, F.col(f"`{c}`")).otherwise(fresh[c]).alias(c) for c in r.stored], F.lit(False).alias("__tg_hit"))
        batch = F.col("__tg_batch")
        both = both.withColumn("__tg_state", F.aggregate(F.when(there, batch).otherwise(F.slice(batch, 2, F.greatest(F.size(batch), F.lit(1)))), begin, step))
        new = {c: F.col("__tg_state")[c] for c in r.stored}
        hit = F.col("__tg_state")["__tg_hit"]
    told = [F.when(wanted, F.when(~there, "created").when(hit, "updated").otherwise("skipped")).alias(outcome)] if outcome else []
    return both.select(*[F.when(wanted, new[c]).otherwise(F.col(f"`{c}`")).alias(c) for c in r.stored], *told)


def _no_hidden(r: Resource, e: Any) -> None:
    if isinstance(e, Expr):
        if e.op == "ref":
            _settable(r, e.args[0])
        for x in e.args:
            _no_hidden(r, x)


def update_query(r: Resource, old: DataFrame, where: Column, values: dict[str, Any] | None = None, atomics: dict[str, Expr] | None = None) -> DataFrame:
    """Sets fields of all rows that meet the condition; none is success."""
    for name in values or {}:
        _settable(r, name, plain=True)
    new = {n: literal(v, r.by_name[n].storage, n) for n, v in (values or {}).items()} | _atomics(r, atomics or {})
    if not new:
        raise UpdateFailed("empty_set")
    hit = F.coalesce(where, F.lit(False))
    return old.select(*[F.when(hit, new[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in new else F.col(f"`{c}`") for c in r.stored])


def scope(r: Resource, tenant: Any) -> Column:
    return F.col(f"`{r.discriminator}`") == F.lit(tenancy.normalise(tenant)) if r.tenancy == "attribute" else F.lit(True)


def by_key(r: Resource, key: dict[str, Any], tenant: Any, where: Expr | None = None) -> Column:
    c = scope(r, tenant)
    for k in r.pk:
        c = c & F.col(f"`{k}`").eqNullSafe(F.lit(key[k]))
    return c & Compiler(r).column(where) if where is not None else c


def update_one(r: Resource, old: DataFrame, key: dict[str, Any], values: dict[str, Any], *, tenant: Any = None, where: Expr | None = None, atomics: dict[str, Expr] | None = None) -> DataFrame:
    """Exactly one row. Its key may change: the match is on the key as it was."""
    hit = by_key(r, key, tenant, where)
    n = old.where(hit).limit(2).count()
    if n != 1:
        raise StaleRecord("stale_record") if n == 0 else UpdateFailed("key_not_unique")
    return update_query(r, old, hit, values, atomics)


def update_many(r: Resource, old: DataFrame, changes: DataFrame, *, tenant: Any = None, where: Expr | None = None, atomics: dict[str, Expr] | None = None) -> DataFrame:
    """changes: the key and the fields to set, one row per record. Keys that aren't there change nothing."""
    keys, fields = r.pk, [c for c in changes.columns if c not in r.pk]
    for f in fields:
        _settable(r, f, plain=True)
    guard_unique(r, old.where(scope(r, tenant)), changes, keys)
    if not changes.groupBy(*keys).count().where("count > 1").isEmpty():
        raise UpdateFailed("repeated_key")
    joined = old.join(_aside(changes).withColumn("__tg_asked", F.lit(True)), _match(keys), "left")
    hit = F.coalesce(F.col("__tg_asked") & scope(r, tenant) & (Compiler(r).column(where) if where is not None else F.lit(True)), F.lit(False))
    new = {f: F.col(f"`{NEW}{f}`").cast(r.schema[f].dataType) for f in fields} | _atomics(r, atomics or {})
    if not new:
        raise UpdateFailed("empty_set")
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in new else F.col(f"`{c}`") for c in r.stored])


def destroy_query(old: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows that go)."""
    hit = F.coalesce(where, F.lit(False))
    return old.where(~hit), old.where(hit)


def destroy_one(r: Resource, old: DataFrame, key: dict[str, Any], *, tenant: Any = None, where: Expr | None = None) -> DataFrame:
    hit = by_key(r, key, tenant, where)
    if old.where(hit).isEmpty():
        raise StaleRecord("stale_record")
    return destroy_query(old, hit)[0]


def destroy(r: Resource, old: DataFrame, edges: DataFrame, key: dict[str, Any], *, tenant: Any = None, where: Expr | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, edges) after one row went with the edges that touched it. Edges of several tenants must be told apart by their ids."""
    rows = destroy_one(r, old, key, tenant=tenant, where=where)
    return rows, detach(edges, old.where(by_key(r, key, tenant, where)), r.pk[0])


def detach(edges: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Edges without those that touch a vertex that goes."""
    ids = gone.select(F.col(f"`{key}`").alias("__tg_gone"))
    for end in ("src", "dst"):
        edges = edges.join(ids, F.col(end) == F.col("__tg_gone"), "left_anti")
    return edges


# Edges: (label, src, dst, tenant, properties...), one row each


def create_edges(edges: DataFrame, new: DataFrame, vertices: DataFrame, *, multiple: bool, guard: bool = True, resource: Resource | None = None) -> DataFrame:
    """new (label, src, dst, tenant, properties...). Both ends must be vertices (id, tenant) of the edge's tenant. A property that
    the resource declares as a sensitive attribute must be binary, whether there are edges or not.

    multiple: each is an edge of its own; else an edge of the same label and ends takes the properties that aren't null.
    """
    for c, kind in new.dtypes if resource else ():
        if c in resource.by_name and resource.by_name[c].sensitive and kind != "binary":
            raise InvalidRelationship("sensitive_needs_binary", field=c)
    if guard:
        for end in ("src", "dst"):
            ends = vertices.select(F.col("id").alias("__tg_id"), F.col("tenant").alias("__tg_t"))
            if not new.join(ends, F.col(end).eqNullSafe(F.col("__tg_id")) & F.col("tenant").eqNullSafe(F.col("__tg_t")), "left_anti").isEmpty():
                raise InvalidRelationship("invalid_relationship")
    if multiple:
        return edges.unionByName(new)
    keys = ["label", "src", "dst", "tenant"]
    props = [c for c in edges.columns if c not in keys]
    ranked = edges.withColumn("__tg_n", F.lit(0).cast("long")).unionByName(new.withColumn("__tg_n", F.monotonically_increasing_id() + 1))
    return ranked.groupBy(*keys).agg(*[F.max_by(F.col(p), F.when(F.col(p).isNotNull(), F.col("__tg_n"))).alias(p) for p in props]).select(*edges.columns)


def destroy_edges(edges: DataFrame, gone: DataFrame, *, direction: str = "outgoing", guard: bool = True) -> DataFrame:
    """gone (label, src, dst, tenant); both: in either orientation. One that isn't there is a stale record, and nothing goes."""
    columns = ["label", "src", "dst", "tenant"]
    turned = gone.select("label", F.col("dst").alias("src"), F.col("src").alias("dst"), "tenant")
    asked = {"outgoing": gone.select(*columns), "incoming": turned, "both": gone.select(*columns).unionByName(turned)}[direction]
    if guard:
        there = edges.select(*columns)
        held = there.unionByName(there.select("label", F.col("dst").alias("src"), F.col("src").alias("dst"), "tenant")) if direction == "both" else there
        asked_ = _aside(gone.select(*columns) if direction == "both" else asked)
        if not asked_.join(held, _match(columns), "left_anti").isEmpty():
            raise StaleRecord("stale_record")
    return edges.join(_aside(asked), _match(columns), "left_anti")
