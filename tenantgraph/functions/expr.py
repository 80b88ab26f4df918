"""The closed expression language: a small syntax tree, and its compiler to columns.

Every reference is guarded: it must name a stored, non-sensitive attribute or an expression calculation of the resource.
``strict`` keeps the reference semantics' refusals; without it attributes may be compared with each other and decimals
ranged over. Refusals that protect scope or classification hold in both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenantgraph.errors import UnsupportedFilter
from tenantgraph.resource import Resource
from tenantgraph.types import SPARK, is_orderable, literal

RANGE = {"<", ">", "<=", ">="}


@dataclass(frozen=True, eq=False)
class Expr:
    op: str
    args: tuple[Any, ...]

    def __add__(self, o: Any) -> Expr: return call("+", self, o)
    def __sub__(self, o: Any) -> Expr: return call("-", self, o)
    def __mul__(self, o: Any) -> Expr: return call("*", self, o)
    def __truediv__(self, o: Any) -> Expr: return call("/", self, o)
    def __eq__(self, o: Any) -> Expr: return call("==", self, o)  # type: ignore[override]
    def __ne__(self, o: Any) -> Expr: return call("!=", self, o)  # type: ignore[override]
    def __lt__(self, o: Any) -> Expr: return call("<", self, o)
    def __gt__(self, o: Any) -> Expr: return call(">", self, o)
    def __le__(self, o: Any) -> Expr: return call("<=", self, o)
    def __ge__(self, o: Any) -> Expr: return call(">=", self, o)
    def __and__(self, o: Any) -> Expr: return call("and", self, o)
    def __or__(self, o: Any) -> Expr: return call("or", self, o)
    def __invert__(self) -> Expr: return call("not", self)
    __hash__ = None  # type: ignore[assignment]

    def is_in(self, values: Any) -> Expr: return Expr("in", (self, list(values)))
    def is_nil(self, yes: bool = True) -> Expr: return Expr("is_nil", (self, yes))
    def contains(self, o: Any) -> Expr: return call("contains", self, o)
    def starts_with(self, o: Any) -> Expr: return call("string_starts_with", self, o)
    def ends_with(self, o: Any) -> Expr: return call("string_ends_with", self, o)
    def concat(self, o: Any) -> Expr: return call("<>", self, o)


def ref(name: str) -> Expr:
    return Expr("ref", (name,))


def lit(value: Any) -> Expr:
    return value if isinstance(value, Expr) else Expr("lit", (value,))


def call(op: str, *args: Any) -> Expr:
    return Expr(op, tuple(lit(a) for a in args))


def if_(test: Any, then: Any, other: Any = None) -> Expr:
    return call("if", test, then, other)


def storage_of(e: Expr, resource: Resource) -> str | None:
    """The storage class of a plain attribute, else none."""
    return resource.by_name[e.args[0]].storage if e.op == "ref" and e.args[0] in resource.by_name else None


class Compiler:
    """loading: the expression is a loaded value, where a division by zero is an error; elsewhere it is infinite. of: where an
    attribute's value lies, by default in the column of its name."""

    def __init__(self, resource: Resource, strict: bool = True, loading: bool = False, of: Callable[[str], Column] | None = None):
        self.resource, self.strict, self.loading = resource, strict, loading
        self.of = of or (lambda name: F.col(f"`{name}`"))

    def column(self, e: Expr | Any) -> Column:
        e = lit(e)
        method = getattr(self, f"_{ {'ref': 'ref', 'lit': 'lit', 'in': 'in', 'is_nil': 'is_nil'}.get(e.op, 'call') }")
        return method(e)

    def _guard(self, name: str, op: str, presence: bool = False) -> Column:
        a = self.resource.by_name.get(name)
        if a is None or a.skip or a.sensitive and not presence:
            raise UnsupportedFilter("field_not_filterable", operator=op, field=name)
        return self.of(name)

    def _ref(self, e: Expr) -> Column:
        name = e.args[0]
        calc = self.resource.calculations.get(name)
        if isinstance(calc, Expr):
            return self.column(calc)
        if calc is not None:
            raise UnsupportedFilter("module_calculation", field=name)
        if "." in name:
            raise UnsupportedFilter("relationship_path", field=name)
        return self._guard(name, "ref")

    def _lit(self, e: Expr) -> Column:
        return literal(e.args[0], None)

    def _is_nil(self, e: Expr) -> Column:
        of, yes = e.args
        c = self._guard(of.args[0], "is_nil", presence=True) if of.op == "ref" and of.args[0] in self.resource.by_name else self.column(of)
        return c.isNull() if yes else c.isNotNull()

    def _in(self, e: Expr) -> Column:
        of, values = e.args
        if any(isinstance(v, Expr) for v in values):
            raise UnsupportedFilter("reference_in_list", operator="in")
        storage = storage_of(of, self.resource)
        c = self.column(of)
        return c.isin([literal(v, storage, "in") for v in values]) if values else F.lit(False)

    def _compare(self, e: Expr) -> Column:
        a, b = e.args
        storages = [storage_of(x, self.resource) for x in (a, b)]
        for x, s in zip((a, b), storages, strict=True):
            if s and e.op in RANGE and not is_orderable(s) and (self.strict or s != "decimal"):
                raise UnsupportedFilter("field_not_orderable", operator=e.op, field=x.args[0])
            if s == "binary" and e.op not in ("==", "!="):
                raise UnsupportedFilter("field_not_orderable", operator=e.op, field=x.args[0])
        if self.strict and all(storages):
            raise UnsupportedFilter("attribute_to_attribute", operator=e.op, field=a.args[0])
        left, right = (literal(x.args[0], storages[1 - i], e.op) if x.op == "lit" and storages[1 - i] and x.args[0] is not None else self.column(x) for i, x in enumerate((a, b)))
        return {"==": left == right, "!=": left != right, "<": left < right, ">": left > right, "<=": left <= right, ">=": left >= right}[e.op]

    def _divide(self, a: Column, b: Column) -> Column:
        a, b = a.cast("double"), b.cast("double")
        if self.loading:
            return a / b
        signed = F.when(a == 0, F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
        return F.when(b == 0, F.when(a.isNotNull(), signed)).otherwise(F.try_divide(a, b))

    def _call(self, e: Expr) -> Column:
        op, args = e.op, e.args
        if op in ("==", "!=", *RANGE):
            return self._compare(e)
        if op in ("contains", "string_starts_with", "string_ends_with"):
            if args[1].op == "ref":
                raise UnsupportedFilter("reference_as_argument", operator=op, field=args[1].args[0])
            text, part = self.column(args[0]), self.column(args[1])
            return {"contains": text.contains, "string_starts_with": text.startswith, "string_ends_with": text.endswith}[op](part)
        if op == "type":
            return self.column(args[0]).cast(SPARK[args[1].args[0]]) if self.loading else self.column(args[0])
        if op == "round" and len(args) != 1:
            raise UnsupportedFilter("round_precision", operator=op)
        table = {
            "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "/": self._divide, "<>": F.concat, "and": lambda a, b: a & b, "or": lambda a, b: a | b, "not": lambda a: ~a,
            "if": lambda c, a, b: F.when(c, a).otherwise(b), "string_downcase": F.lower, "string_length": F.length, "string_trim": F.trim, "length": F.size, "round": F.round,
        }
        if op not in table:
            raise UnsupportedFilter("unsupported_operator", operator=op)
        return table[op](*(self.column(a) for a in args))
