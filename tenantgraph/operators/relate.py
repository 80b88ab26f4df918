"""Foreign-key relationships: loads, filters and aggregates, each as one lazy join.

Each side is scanned through its own tenant and row policy. Joins carry no broadcast hint: adaptive execution broadcasts a
side by its measured size, and splits skewed keys otherwise. Aggregates are summed by key before the join.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantgraph.errors import NotFilterable, QueryFailed, UnsupportedAggregate
from tenantgraph.functions.expr import Expr
from tenantgraph.operators.aggregates import Aggregate, _place, check, column
from tenantgraph.plans.query import Query
from tenantgraph.resource import Relationship
from tenantgraph.types import literal

KEY, NTH = "__tg_key", "__tg_nth"


def _targets(rel: Relationship, dest: Query, through: Query | None) -> DataFrame:
    """(KEY, destination columns): the destination's rows by the key of their source."""
    if dest.branches or dest.distincts or dest.loads:
        raise QueryFailed("unsupported_destination", field=rel.name)
    rows = dest.filtered()
    if rel.kind != "many_to_many":
        return rows.where(F.col(f"`{rel.destination_field}`").isNotNull()).withColumn(KEY, F.col(f"`{rel.destination_field}`"))
    links = through.filtered().select(F.col(f"`{rel.through_source}`").alias(KEY), F.col(f"`{rel.through_destination}`").alias("__tg_to")).distinct()
    return rows.join(links, F.col(f"`{rel.destination_field}`") == F.col("__tg_to")).drop("__tg_to")


def _order(rel: Relationship, dest: Query) -> list[Column]:
    sorts = rel.sort or dest.sorts
    for s in sorts:
        dest.sort_column(*s)
    return [x for s in sorts for x in _place(F.col(f"`{s[0]}`"), s[1], dest.resource.by_name[s[0]].storage)] + [F.col(f"`{k}`") for k in dest.resource.pk]


def _unpaged(rel: Relationship, dest: Query) -> Query:
    """Limits belong to each parent of a load; a semi-join or an aggregate has no use for them."""
    if dest.limit_ is not None or dest.offset_:
        raise QueryFailed("unsupported_destination", field=rel.name)
    return dest


def related_rows(q: Query, name: str, dest: Query, through: Query | None = None) -> DataFrame:
    """(KEY, NTH, destination columns), one row for each: each parent's rows in order, from its dest.offset_ on and dest.limit_ at
    most. For parents with more rows than an array should hold; a limited one is cut before and after the shuffle."""
    rel = q.resource.relationship(name)
    found = _targets(rel, dest, through)
    nth = F.row_number().over(Window.partitionBy(KEY).orderBy(*_order(rel, dest)))
    found = found.withColumn(NTH, nth)
    one = rel.kind in ("belongs_to", "has_one")
    last = 1 if one else None if dest.limit_ is None else (dest.offset_ or 0) + dest.limit_
    if last is not None:
        found = found.where(F.col(NTH) <= last)
    if dest.offset_ and not one:
        found = found.where(F.col(NTH) > dest.offset_)
    return dest.masked(found, KEY, NTH)


def load(q: Query, name: str, dest: Query, through: Query | None = None) -> DataFrame:
    """q's rows with a column of that name: the destination's struct, or an array of structs that is empty where there are none.
    A limit and an offset of the destination hold for each parent."""
    rel = q.resource.relationship(name)
    one = rel.kind in ("belongs_to", "has_one")
    value = F.struct(*[F.col(f"`{n}`") for n in dest.resource.stored])
    if one or dest.limit_ is not None or dest.offset_:
        found = related_rows(q, name, dest, through)
        if one:
            found = found.select(KEY, value.alias(name))
        else:
            found = found.groupBy(KEY).agg(F.transform(F.sort_array(F.collect_list(F.struct(NTH, value.alias("v")))), lambda x: x["v"]).alias(name))
    else:
        found = _targets(rel, dest, through)
        shown = F.struct(*[(F.lit(None).cast(kind) if n in dest.hidden() else F.col(f"`{n}`")).alias(n) for n, kind in found.dtypes if n in dest.resource.stored])
        place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_order(rel, dest))], shown.alias("v"))
        found = found.groupBy(KEY).agg(F.transform(F.sort_array(F.collect_list(place)), lambda x: x["v"]).alias(name))
    out = q.to_df().join(found, F.col(f"`{rel.source_field}`") == F.col(KEY), "left").drop(KEY)
    return out if one else out.withColumn(name, F.coalesce(F.col(name), F.array().cast(out.schema[name].dataType)))


def related(q: Query, name: str, dest: Query, predicate: Expr | None = None, through: Query | None = None) -> DataFrame:
    """q's rows that have a related row which meets the predicate: a semi-join, for != as well."""
    rel = q.resource.relationship(name)
    if dest.resource.policy and dest.resource.policy.row and q.strict:
        raise NotFilterable("destination_is_authorised", field=name)
    if rel.kind == "many_to_many" and q.strict:
        raise NotFilterable("many_to_many", field=name)
    dest = _unpaged(rel, dest)
    keys = _targets(rel, dest.filter(predicate) if predicate is not None else dest, through).select(KEY)
    return q.to_df().join(keys, F.col(f"`{rel.source_field}`") == F.col(KEY), "left_semi")


def exists(q: Query, name: str, dest: Query, predicate: Expr | None = None, through: Query | None = None) -> DataFrame:
    """As related, and open to authorised destinations: their row policy holds inside the semi-join."""
    rel = q.resource.relationship(name)
    dest = _unpaged(rel, dest)
    keys = _targets(rel, dest.filter(predicate) if predicate is not None else dest, through).select(KEY)
    return q.to_df().join(keys, F.col(f"`{rel.source_field}`") == F.col(KEY), "left_semi")


def relationship_aggregates(q: Query, name: str, dest: Query, *aggregates: Aggregate, through: Query | None = None) -> DataFrame:
    """q's rows with one column per aggregate over their related rows; parents without any get the default."""
    if "." in name:
        raise UnsupportedAggregate("relationship_path", field=name)
    rel = q.resource.relationship(name)
    dest = _unpaged(rel, dest)
    for a in aggregates:
        check(a, dest.resource, q.strict, per_parent=True)
        if a.field in dest.hidden() and a.kind != "exists":
            raise UnsupportedAggregate("field_not_visible", operator=a.kind, field=a.field)
    found = _targets(rel, dest, through).groupBy(KEY).agg(*[column(a, replace(dest, strict=q.strict)) for a in aggregates])
    out = q.to_df().join(found, F.col(f"`{rel.source_field}`") == F.col(KEY), "left").drop(KEY)
    return with_defaults(out, dest, aggregates)


def with_defaults(out: DataFrame, dest: Query, aggregates: tuple[Aggregate, ...]) -> DataFrame:
    for a in aggregates:
        kind = out.schema[a.name].dataType
        if a.kind == "count":
            none = F.lit(0).cast(kind)
        elif a.kind == "exists":
            none = F.lit(False)
        elif a.kind == "list":
            none = (F.lit(list(a.default)) if a.default else F.array()).cast(kind)
        elif a.default is not None:
            none = literal(a.default, "float" if a.kind == "avg" else dest.resource.by_name[a.field].storage, a.field)
        else:
            continue
        out = out.withColumn(a.name, F.coalesce(F.col(a.name), none))
    return out
