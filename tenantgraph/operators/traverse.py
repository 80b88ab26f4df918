"""Bounded traversal over edges, scoped and authorised per hop.

Tenant and row policy are put on vertices before the expansion, which is the same as asking it of every node of every path,
and cheaper; edges are scoped as they are read. Where only reachability is asked (min_depth 1), pairs of source and node are
made distinct after each hop, so the work is bounded by the pairs and not by the number of paths; undirected, the pairs carry
the first edge as well, which may not be used again, or each step back would seem a way home. Otherwise paths are trails: each
carries its edge ids and uses none twice. The depth is a number, so the plan is a fixed chain of joins, and a hop looks at the
vertices of its far ends alone: the near ones passed that look a hop before.

A path begins at a row of the source's label and ends at one of the destination's. In between it may pass vertices of both and
of the labels in `through`, each by its own tenant and policy. Keys tell vertices apart within a label; where edges have the
columns src_label and dst_label, labels count too, else labels whose keys meet are one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantgraph import telemetry, tenancy
from tenantgraph.errors import QueryFailed, UnsupportedAggregate, redacted
from tenantgraph.operators.aggregates import Aggregate, check, column
from tenantgraph.operators.relate import with_defaults
from tenantgraph.plans.query import Query
from tenantgraph.resource import identifier


@dataclass(frozen=True)
class Traversal:
    """edges: (edge_id, src, dst) and, where they are scoped, a tenant column."""

    edge_label: str
    max_depth: int
    direction: str = "outgoing"
    min_depth: int = 1
    scope_edges: bool = True
    tenant_column: str = "tenant"
    limit: int | None = None
    offset: int = 0

    def __post_init__(self) -> None:
        if not identifier(self.edge_label) or self.direction not in ("outgoing", "incoming", "both"):
            raise QueryFailed("invalid_traversal")
        if not isinstance(self.max_depth, int) or not 1 <= self.min_depth <= self.max_depth:
            raise QueryFailed("unbounded_traversal")
        if self.limit is not None and self.limit < 1 or self.offset < 0:
            raise QueryFailed("invalid_limit")


Scope = tuple[str, Any] | None


def scope_of(q: Query, dest: Query) -> Scope:
    """(discriminator, tenant) that every node and, unless opted out, every edge of a path carries. Either endpoint may bring
    it; two different discriminators, or two tenants, can't hold at once and are refused."""
    scoped = [x for x in (dest, q) if x.resource.tenancy == "attribute"]
    if len({x.resource.discriminator for x in scoped}) > 1:
        raise QueryFailed("mixed_discriminator")
    if len({tenancy.normalise(x.tenant) for x in scoped}) > 1:
        raise QueryFailed("mixed_tenant")
    return (scoped[0].resource.discriminator, tenancy.normalise(scoped[0].tenant)) if scoped else None


def _vertices(nodes: Query, scope: Scope, labelled: bool) -> DataFrame:
    """(v): the vertices that a path may use. A vertex type without the discriminator carries no tenant, so none of it."""
    if len(nodes.resource.pk) != 1:
        raise QueryFailed("composite_key")
    rows = nodes.scoped()
    if scope and nodes.resource.tenancy != "attribute":
        rows = rows.where(F.col(f"`{scope[0]}`") == F.lit(scope[1]) if scope[0] in nodes.resource.stored else F.lit(False))
    return rows.select(vertex(F.col(f"`{nodes.resource.pk[0]}`"), F.lit(nodes.resource.label), labelled).alias("v"))


def vertex(key: Column, label: Column, labelled: bool) -> Column:
    return F.concat_ws(":", label, key.cast("string")) if labelled else key


def _edges(t: Traversal, edges: DataFrame, scope: Scope, vertices: DataFrame) -> DataFrame:
    """(e, a, b): steps to vertices that a path may use."""
    labelled = has_labels(edges)
    if scope and t.scope_edges:
        edges = edges.where(F.col(t.tenant_column) == F.lit(scope[1]))
    src, dst = (vertex(F.col(end), F.col(f"{end}_label") if labelled else F.lit(""), labelled) for end in ("src", "dst"))
    out = edges.select(F.col("edge_id").alias("e"), src.alias("a"), dst.alias("b"))
    turned = edges.select(F.col("edge_id").alias("e"), dst.alias("a"), src.alias("b"))
    out = {"outgoing": out, "incoming": turned, "both": out.unionByName(turned).distinct()}[t.direction]
    return out.join(vertices.select(F.col("v").alias("__tg_v")), F.col("b") == F.col("__tg_v"), "left_semi")


def has_labels(edges: DataFrame) -> bool:
    return {"src_label", "dst_label"} <= set(edges.columns)


def reach(sources: DataFrame, t: Traversal, edges: DataFrame, nodes: Query, scope: Scope = None, seen: Observation | None = None, others: tuple[Query, ...] = (), of: Query | None = None) -> DataFrame:
    """sources (source_id) to distinct (source_id, node_id), node_id a vertex. nodes: the destination's label; of: the source's, if it is
    another; others: those between. seen: told how many there were before they were made distinct."""
    labelled = has_labels(edges)
    of = of or nodes
    kinds = {(x.resource.label, x.resource.database): x for x in (*others, of, nodes)}
    vertices = reduce(DataFrame.unionByName, [_vertices(x, scope, labelled) for x in kinds.values()])
    steps = _edges(t, edges, scope, vertices)
    own = _vertices(kinds[of.resource.label, of.resource.database], scope, labelled)
    start = sources.select("source_id", vertex(F.col("source_id"), F.lit(of.resource.label), labelled).alias("node_id")).distinct()
    start = start.join(own, F.col("node_id") == F.col("v"), "left_semi")
    if t.min_depth == 1:
        undirected = t.direction == "both"
        level, found = start.withColumn("first", F.lit(None).cast(steps.schema["e"].dataType)), None
        for _ in range(t.max_depth):
            onward = level.join(steps, (level.node_id == steps.a) & (F.col("first").isNull() | (F.col("e") != F.col("first")) if undirected else F.lit(True)))
            level = onward.select("source_id", F.col("b").alias("node_id"), F.coalesce("first", "e").alias("first") if undirected else F.col("first")).distinct()
            found = level if found is None else found.unionByName(level)
        found = found.select("source_id", "node_id")
    else:
        found = trails(start, t, steps).select("source_id", "node_id")
    return (found.observe(seen, F.count(F.lit(1)).alias("row_count")) if seen else found).distinct()


def trails(start: DataFrame, t: Traversal, steps: DataFrame) -> DataFrame:
    """(source_id, node_id, path, edge_ids): every trail of min_depth to max_depth hops from start (source_id, node_id) over steps (e, a, b)."""
    none = F.array().cast(T.ArrayType(steps.schema["e"].dataType))
    level = start.select("source_id", "node_id", F.array("node_id").alias("path"), none.alias("edge_ids"))
    out = None
    for depth in range(1, t.max_depth + 1):
        level = level.join(steps, (level.node_id == steps.a) & ~F.array_contains("edge_ids", F.col("e")))
        level = level.select("source_id", F.col("b").alias("node_id"), F.concat("path", F.array("b")).alias("path"), F.concat("edge_ids", F.array("e")).alias("edge_ids"))
        if depth >= t.min_depth:
            out = level if out is None else out.unionByName(level)
    return out


def traverse(q: Query, t: Traversal, edges: DataFrame, dest: Query, seen: Observation | None = None, through: tuple[Query, ...] = ()) -> DataFrame:
    """(source_id, destination columns): the caller's filter and sort act on destinations alone, never on the way there. Rows with a
    null edge id are no edges of an undirected traversal."""
    bare = lambda x: Query(x.resource, x.source, x.tenant, x.actor, strict=x.strict)
    sources = q.to_df().select(F.col(f"`{q.resource.pk[0]}`").alias("source_id"))
    found = reach(sources, t, edges, bare(dest), scope_of(q, dest), seen, tuple(bare(x) for x in through), bare(q) if q.resource.label != dest.resource.label else None)
    rows = dest.to_df()
    key = vertex(F.col(f"`{dest.resource.pk[0]}`"), F.lit(dest.resource.label), has_labels(edges))
    out = found.join(rows, found.node_id == key).drop("node_id")
    if t.limit is not None or t.offset:
        rank = F.row_number().over(Window.partitionBy("source_id").orderBy(*dest._order(dest.sorts)))
        out = out.withColumn("__tg_rank", rank).where(F.col("__tg_rank") > t.offset)
        out = (out.where(F.col("__tg_rank") <= t.offset + t.limit) if t.limit is not None else out).drop("__tg_rank")
    return out


def delivered(q: Query, t: Traversal, edges: DataFrame, dest: Query) -> list[Row]:
    """The rows of traverse, under a span: row_count is the fan-out before destinations are made distinct."""
    with telemetry.span("traverse", resource=dest.resource.label, depth=t.max_depth) as more:
        seen = Observation()
        rows = redacted(lambda: traverse(q, t, edges, dest, seen).collect())
        more |= {"row_count": _observed(seen), "destination_count": len(rows)}
    return rows


def _observed(seen: Observation) -> int:
    try:
        return seen.get["row_count"]
    except Exception:  # noqa: BLE001 - the optimizer proved the paths empty and removed the count with them
        return 0


def traversal_aggregates(q: Query, t: Traversal, edges: DataFrame, dest: Query, *aggregates: Aggregate) -> DataFrame:
    """q's rows with aggregates over what each of them reaches."""
    hidden = dest.resource.policy.hidden(dest.actor) if dest.resource.policy else set()
    for a in aggregates:
        check(a, dest.resource, q.strict, per_parent=True)
        if a.field in hidden and a.kind != "exists":
            raise UnsupportedAggregate("field_not_visible", operator=a.kind, field=a.field)
    parents = q.to_df()
    found = traverse(q, t, edges, dest).groupBy("source_id").agg(*[column(a, dest) for a in aggregates])
    return with_defaults(parents.join(found, F.col(f"`{q.resource.pk[0]}`") == F.col("source_id"), "left").drop("source_id"), dest, aggregates)
