"""Resources: typed vertex types, checked when they are declared."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from tenantgraph.errors import InvalidResource
from tenantgraph.types import SPARK

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]{0,127}")


def identifier(name: Any) -> bool:
    return isinstance(name, str) and bool(_NAME.fullmatch(name))


@dataclass(frozen=True)
class Attribute:
    name: str
    storage: str = "string"
    pk: bool = False
    skip: bool = False
    sensitive: bool = False


@dataclass(frozen=True)
class Edge:
    """multiple: parallel edges between two endpoints, else one per label and pair."""

    name: str
    label: str
    direction: str = "outgoing"
    destination: str | None = None
    properties: tuple[str, ...] = ()
    multiple: bool = False


@dataclass(frozen=True)
class VectorIndex:
    attribute: str
    dimensions: int
    similarity: str = "cosine"


@dataclass(frozen=True)
class SparseIndex:
    name: str
    tokens: str
    weights: str


@dataclass(frozen=True)
class Relationship:
    """kind: belongs_to, has_many, has_one or many_to_many (then through, and its two keys)."""

    name: str
    kind: str
    destination: str
    source_field: str
    destination_field: str
    through: str | None = None
    through_source: str | None = None
    through_destination: str | None = None
    sort: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Policy:
    """row: actor -> condition that a row must meet. fields: name -> (actor -> whether the actor may see the field)."""

    row: Callable[[Any], Column] | None = None
    fields: dict[str, Callable[[Any], bool]] = field(default_factory=dict)

    def hidden(self, actor: Any) -> set[str]:
        return {name for name, allowed in self.fields.items() if not allowed(actor)}


@dataclass(frozen=True)
class Resource:
    label: str
    attributes: tuple[Attribute, ...]
    tenancy: str | None = None
    discriminator: str | None = None
    edges: tuple[Edge, ...] = ()
    vector_indexes: tuple[VectorIndex, ...] = ()
    sparse_indexes: tuple[SparseIndex, ...] = ()
    relationships: tuple[Relationship, ...] = ()
    calculations: dict[str, Any] = field(default_factory=dict)
    policy: Policy | None = None
    database: str | None = None

    def __post_init__(self) -> None:
        def need(ok: Any, reason: str, name: str | None = None) -> None:
            if not ok:
                raise InvalidResource(reason, field=name)

        need(identifier(self.label), "label_format")
        need(self.database is None or identifier(self.database), "database_format")
        by = {a.name: a for a in self.attributes}
        need(len(by) == len(self.attributes), "duplicate_attribute")
        need(self.tenancy in (None, "attribute", "context"), "tenancy")
        for a in self.attributes:
            need(a.storage in SPARK, "storage", a.name)
            need(not (a.sensitive and not a.skip and a.storage != "binary"), "sensitive_needs_binary", a.name)
            need(not (a.pk and a.skip), "pk_skipped", a.name)
        if self.tenancy == "attribute":
            d = by.get(self.discriminator or "")
            need(d, "discriminator_unknown", self.discriminator)
            need(not d.sensitive, "discriminator_sensitive", d.name)
            need(not d.skip, "discriminator_skipped", d.name)
            need(d.storage != "binary", "discriminator_binary", d.name)
        for e in self.edges:
            need(identifier(e.label), "edge_label_format", e.name)
            need(e.direction in ("outgoing", "incoming", "both"), "edge_direction", e.name)
            for p in e.properties:
                need(p not in by or not by[p].sensitive or by[p].storage == "binary", "sensitive_needs_binary", p)
        for r in self.relationships:
            need(r.kind in ("belongs_to", "has_many", "has_one", "many_to_many"), "relationship_kind", r.name)
            need(r.source_field in by and not by[r.source_field].sensitive, "relationship_key_sensitive", r.source_field)
        seen: set[str] = set()
        for v in self.vector_indexes:
            a = by.get(v.attribute)
            need(a and not a.skip and not a.sensitive and (a.storage == "vector" or a.storage.startswith("array_")), "vector_index", v.attribute)
            need(v.similarity in ("cosine", "dot_product", "euclidean") and v.dimensions > 0, "vector_index", v.attribute)
            need(v.attribute not in seen, "index_not_unique", v.attribute)
            seen.add(v.attribute)
        for s in self.sparse_indexes:
            for name in (s.tokens, s.weights):
                a = by.get(name)
                need(a and not a.skip and not a.sensitive and a.storage.startswith("array_"), "sparse_index", name)
            need(s.tokens != s.weights and s.name not in seen, "sparse_index", s.name)
            seen.add(s.name)

    @property
    def by_name(self) -> dict[str, Attribute]:
        return {a.name: a for a in self.attributes}

    @property
    def pk(self) -> list[str]:
        return [a.name for a in self.attributes if a.pk]

    @property
    def stored(self) -> list[str]:
        return [a.name for a in self.attributes if not a.skip]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(a.name, SPARK[a.storage]) for a in self.attributes if not a.skip])

    def relationship(self, name: str) -> Relationship:
        for r in self.relationships:
            if r.name == name:
                return r
        raise InvalidResource("unknown_relationship", field=name)
