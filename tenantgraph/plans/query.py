"""The immutable query builder and its lowering to a lazy DataFrame.

The order of the plan is fixed and is a matter of security: scan, tenant, row policy, caller's filter, calculations,
distinct, sort, offset and limit, field policy, projection. In set operations the first four hold in every branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantgraph import telemetry, tenancy
from tenantgraph.errors import QueryFailed, TenantRequired, UnsortableField, redacted
from tenantgraph.functions.expr import Compiler, Expr
from tenantgraph.resource import Resource
from tenantgraph.types import is_orderable

DIRECTIONS = ("asc", "desc", "asc_nils_first", "asc_nils_last", "desc_nils_first", "desc_nils_last")
Sort = tuple[str, str]


def directed(c: Column, direction: str) -> Column:
    """asc puts nulls last and desc puts them first, unless the direction says otherwise."""
    return {
        "asc": c.asc_nulls_last, "asc_nils_last": c.asc_nulls_last, "asc_nils_first": c.asc_nulls_first,
        "desc": c.desc_nulls_first, "desc_nils_first": c.desc_nulls_first, "desc_nils_last": c.desc_nulls_last,
    }[direction]()


@dataclass(frozen=True)
class Query:
    resource: Resource
    source: Any
    tenant: Any = None
    actor: Any = None
    filters: tuple[Expr, ...] = ()
    sorts: tuple[Sort, ...] = ()
    distincts: tuple[str, ...] = ()
    distinct_sorts: tuple[Sort, ...] = ()
    branches: tuple[tuple[str, Query], ...] = ()
    loads: tuple[str, ...] = ()
    limit_: int | None = None
    offset_: int | None = None
    strict: bool = True
    extra: tuple[Column, ...] = field(default=(), repr=False)

    # Building

    def for_tenant(self, tenant: Any) -> Query:
        return replace(self, tenant=tenant)

    def as_actor(self, actor: Any) -> Query:
        return replace(self, actor=actor)

    def filter(self, e: Expr) -> Query:
        Compiler(self.resource, self.strict).column(e)
        return replace(self, filters=(*self.filters, e))

    def sort(self, *by: str | Sort) -> Query:
        by_ = tuple((x, "asc") if isinstance(x, str) else tuple(x) for x in by)
        for name, direction in by_:
            self.sort_column(name, direction)
        return replace(self, sorts=(*self.sorts, *by_))

    def distinct(self, *names: str) -> Query:
        for name in names:
            self._stored(name)
        return replace(self, distincts=names)

    def distinct_sort(self, *by: str | Sort) -> Query:
        by_ = tuple((x, "asc") if isinstance(x, str) else tuple(x) for x in by)
        for name, direction in by_:
            if name not in self.resource.by_name:
                raise UnsortableField("unknown_field", field=name)
            self.sort_column(name, direction)
        return replace(self, distinct_sorts=by_)

    def limit(self, n: int) -> Query:
        if isinstance(n, bool) or not isinstance(n, int) or n < 0:
            raise QueryFailed("invalid_limit")
        return replace(self, limit_=n)

    def offset(self, n: int) -> Query:
        if isinstance(n, bool) or not isinstance(n, int) or n < 0:
            raise QueryFailed("invalid_offset")
        return replace(self, offset_=n or None)

    def load(self, *names: str) -> Query:
        for name in names:
            calc = self.resource.calculations.get(name)
            if calc is None:
                raise QueryFailed("unknown_calculation", field=name)
            if isinstance(calc, Expr):
                Compiler(self.resource, self.strict, True).column(calc)
        return replace(self, loads=(*self.loads, *names))

    def combine(self, kind: str, branch: Query) -> Query:
        """kind: base (first and only first), union, union_all, intersect or except; branches fold from left to right."""
        if kind not in ("base", "union", "union_all", "intersect", "except") or (kind == "base") != (not self.branches):
            raise QueryFailed("invalid_combination", operator=kind)
        if branch.loads or branch.branches or branch.distincts:
            raise QueryFailed("unsupported_branch", operator=kind)
        if self.strict and any(isinstance(self.resource.calculations.get(n), Expr) for n, _ in branch.sorts):
            raise QueryFailed("unsupported_branch", operator=kind)
        if self.resource.tenancy == "context" and tenancy.normalise(branch.tenant) != tenancy.normalise(self.tenant):
            raise QueryFailed("branches_span_tenants", operator=kind)
        return replace(self, branches=(*self.branches, (kind, branch)))

    # Guards

    def _stored(self, name: str) -> None:
        a = self.resource.by_name.get(name)
        if a is None or a.skip or a.sensitive:
            raise UnsortableField("field_not_stored", field=name)

    def sort_column(self, name: str, direction: str) -> Column:
        if direction not in DIRECTIONS:
            raise UnsortableField("unknown_direction", field=name)
        calc = self.resource.calculations.get(name)
        if isinstance(calc, Expr):
            return directed(Compiler(self.resource, self.strict).column(calc), direction)
        if calc is not None:
            raise UnsortableField("module_calculation", field=name)
        self._stored(name)
        storage = self.resource.by_name[name].storage
        if not is_orderable(storage) and (self.strict or storage != "decimal"):
            raise UnsortableField("field_not_orderable", field=name)
        if self.resource.policy and name in self.resource.policy.hidden(self.actor):
            raise UnsortableField("field_not_visible", field=name)
        return directed(F.col(f"`{name}`"), direction)

    def _order(self, by: Sequence[Sort]) -> list[Column]:
        return [self.sort_column(*s) for s in by] + [F.col(f"`{k}`").asc_nulls_last() for k in self.resource.pk]

    # Lowering

    def scoped(self, everyone: bool = False) -> DataFrame:
        """Scan, tenant, row policy. everyone: the rows of all tenants of a discriminator, for who is allowed to ask."""
        r = self.resource
        tenant = tenancy.normalise(self.tenant) if r.tenancy and not (everyone and r.tenancy == "attribute") else None
        df = self.source.scan(r, tenancy.database_of(tenant) if r.tenancy == "context" else r.database)
        if r.tenancy == "attribute" and not everyone:
            df = df.where(F.col(f"`{r.discriminator}`") == F.lit(tenant))
        if r.policy and r.policy.row:
            df = df.where(r.policy.row(self.actor))
        return df

    def filtered(self, everyone: bool = False) -> DataFrame:
        compiler = Compiler(self.resource, self.strict)
        df = self.scoped(everyone)
        for e in self.filters:
            df = df.where(compiler.column(e))
        for c in self.extra:
            df = df.where(c)
        return df

    def _paged(self, df: DataFrame) -> DataFrame:
        if self.sorts or self.limit_ is not None or self.offset_:
            df = df.orderBy(*self._order(self.sorts))
        if self.offset_:
            df = df.offset(self.offset_)
        return df if self.limit_ is None else df.limit(self.limit_)

    def _combined(self) -> DataFrame:
        pk = self.resource.pk

        def fold(acc: DataFrame, step: tuple[str, DataFrame]) -> DataFrame:
            kind, branch = step
            if kind == "union_all":
                return acc.unionByName(branch)
            if kind == "union":
                return acc.unionByName(_by_key(branch, acc, pk, "left_anti"))
            return _by_key(acc, branch, pk, "left_semi" if kind == "intersect" else "left_anti")

        plans = []
        for kind, b in self.branches:
            branch = replace(b, tenant=self.tenant if self.resource.tenancy else b.tenant, actor=self.actor, filters=(*self.filters, *b.filters))
            plans.append((kind, branch._paged(branch.filtered())))
        return reduce(lambda df, c: df.where(c), self.extra, reduce(fold, plans[1:], plans[0][1]))  # a cursor moves over the whole, not over each branch

    def rows(self) -> DataFrame:
        """All steps but the masks and loads."""
        df = self.pinned()._combined() if self.branches else self.filtered()
        if self.distincts:
            order = self._order(self.distinct_sorts or self.sorts)
            rank = F.row_number().over(Window.partitionBy(*[F.col(f"`{n}`") for n in self.distincts]).orderBy(*order))
            df = df.withColumn("__tg_rank", rank).where("__tg_rank = 1").drop("__tg_rank")
        return self._paged(df)

    def pinned(self) -> Query:
        """The query with its branches on one state of their stores, where these change."""
        states: dict[int, Any] = {}
        fixed = lambda source: states.setdefault(id(source), source.pinned() if hasattr(source, "pinned") else source)
        return replace(self, source=fixed(self.source), branches=tuple((kind, replace(b, source=fixed(b.source))) for kind, b in self.branches))

    def hidden(self) -> set[str]:
        return self.resource.policy.hidden(self.actor) if self.resource.policy else set()

    def masked(self, df: DataFrame, *more: Column | str) -> DataFrame:
        """The stored columns of rows, those that the actor may not see as nulls, and more."""
        hidden, kinds = self.hidden(), dict(df.dtypes)
        return df.select(*[F.lit(None).cast(kinds[n]).alias(n) if n in hidden else F.col(f"`{n}`") for n in self.resource.stored], *more)

    def to_df(self) -> DataFrame:
        if self.resource.tenancy and self.tenant is None:
            raise TenantRequired("tenant_required")
        df = self.rows()
        compiler = Compiler(self.resource, self.strict, loading=True)
        hidden, loaded = self.hidden(), []
        for name in self.loads:
            calc = self.resource.calculations[name]
            c = compiler.column(calc) if isinstance(calc, Expr) else calc(df)
            loaded.append((F.lit(None).cast(df.select(c).schema[0].dataType) if name in hidden else c).alias(name))
        return self.masked(df, *loaded)

    def collect(self) -> list:
        with telemetry.span("read", resource=self.resource.label) as more:
            rows = redacted(lambda: self.to_df().collect())
            more["row_count"] = len(rows)
        return rows

    def count(self) -> int:
        """The total of all pages."""
        return redacted(lambda: replace(self, limit_=None, offset_=None, sorts=()).rows().count())


def _by_key(left: DataFrame, right: DataFrame, pk: list[str], how: str) -> DataFrame:
    keys = right.select(*[F.col(f"`{k}`").alias(f"__tg_k{i}") for i, k in enumerate(pk)]).distinct()
    return left.join(keys, reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__tg_k{i}")) for i, k in enumerate(pk)]), how)
