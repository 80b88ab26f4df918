"""Refusals, tenancy, paging, writes, transactions and change streams on small hand-made rows."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tenantgraph import telemetry, tenancy
from tenantgraph.capabilities import REFUSED, SUPPORTED, can
from tenantgraph.errors import CdcError, ConcurrentModification, CreateFailed, GraphError, InvalidRelationship, InvalidResource, NotFilterable, QueryFailed, StaleRecord, TenantRequired, UnsortableField, UnsupportedAggregate, UnsupportedFilter, UpdateFailed
from tenantgraph.functions.expr import call, if_, ref
from tenantgraph.operators import writes as W
from tenantgraph.operators.aggregates import Aggregate, aggregate, fold
from tenantgraph.operators.paging import page, stream
from tenantgraph.operators.relate import exists, load, related, related_rows, relationship_aggregates
from tenantgraph.operators.traverse import Traversal, delivered, traverse
from tenantgraph.operators.vector import fulltext, knn, sparse
from tenantgraph.plans.query import Query
from tenantgraph.resource import Attribute as A
from tenantgraph.resource import Policy, Relationship, Resource, SparseIndex, VectorIndex
from tenantgraph.sources.scan import MemorySource
from tenantgraph.scratch import shared_dir
from tenantgraph.sources.store import Store
from tenantgraph.streaming import cdc

DOC = Resource("doc", (A("id", "integer", pk=True), A("org"), A("name"), A("amount", "integer"), A("price", "decimal"), A("secret", "binary", sensitive=True), A("draft", skip=True)), "attribute", "org",
    calculations={"share": ref("amount") / ref("id")}, relationships=(Relationship("kin", "has_many", "doc", "id", "amount"),))


@pytest.fixture(scope="module")
def rows(spark):
    data = [(9, "o2", "z", 10), (1, "o1", "a", 30), (2, "o1", "b", 10), (3, "o1", "c", 20), (4, "o1", "d", 10), (5, "o1", "e", None), (6, "o1", "f", 10), (0, "o1", "g", 25)]
    return spark.createDataFrame(data, "id long, org string, name string, amount long").cache()


@pytest.fixture(scope="module")
def q(rows):
    return Query(DOC, MemorySource({(None, "doc"): rows}), "o1")


def test_refusals(q):
    for e in (ref("secret") == b"x", ref("draft") == "x", ref("price") > 1, ref("id") == ref("amount"), call("like", ref("name"), "a"), ref("name").contains(ref("org")), ref("id").is_in([ref("amount")]), ref("a.b") == 1):
        with pytest.raises(UnsupportedFilter):
            q.filter(e)
    with pytest.raises(QueryFailed) as e:
        q.filter(ref("amount") == "sneaky")
    assert "sneaky" not in str(e.value)
    for name in ("price", "secret", "draft", "nothing"):
        with pytest.raises(UnsortableField):
            q.sort(name)
    for a in (Aggregate("x", "sum", "name"), Aggregate("x", "min", "price"), Aggregate("x", "custom", "id"), Aggregate("x", "list", "secret"), Aggregate("x", "list", "id", include_nil=True)):
        with pytest.raises(UnsupportedAggregate):
            aggregate(q, a)
    assert q.filter(ref("secret").is_nil()).count() == 7


def test_tenancy(q):
    for t in (None, "", "  ", False):
        with pytest.raises(TenantRequired):
            q.for_tenant(t).to_df()
    assert tenancy.database_of("abc_1") == "t_abc_1" and tenancy.database_of("a-b").startswith("g") and tenancy.database_of(42) == tenancy.database_of("42")
    with pytest.raises(TenantRequired):
        tenancy.database_of("x" * 200)
    assert {r.id for r in q.for_tenant("o2").collect()} == {9}


def test_division_by_zero_is_an_error_when_loaded_and_infinite_when_filtered(q):
    with pytest.raises(QueryFailed):
        q.load("share").collect()
    assert 0 in {r.id for r in q.filter(ref("share") > 5).collect()}


@pytest.mark.parametrize("direction", ["asc", "desc", "asc_nils_first", "desc_nils_last"])
def test_keyset_walk_is_the_full_read(q, direction):
    s = q.sort(("amount", direction))
    full = [r.id for r in s.collect()]
    assert [r.id for r in stream(s, 3)] == full
    last = s.collect()[5].asDict()
    assert [r.id for r in page(s, 3, before=last).collect()] == full[2:5]


def test_declarations():
    for bad in (
        lambda: Resource("1x", (A("id", pk=True),)), lambda: Resource("x", (A("id", pk=True, skip=True),)), lambda: Resource("x", (A("s", "string", sensitive=True),)),
        lambda: Resource("x", (A("id"),), "attribute", "nope"), lambda: Resource("x", (A("v", "string"),), vector_indexes=(VectorIndex("v", 3),)),
    ):
        with pytest.raises(InvalidResource):
            bad()
    for bad in ({"max_depth": 0}, {"max_depth": 2, "min_depth": 3}, {"max_depth": 2, "direction": "up"}):
        with pytest.raises(QueryFailed):
            Traversal("E", **bad)
    assert can("combine:except") and not any(can(x) for x in REFUSED) and not SUPPORTED & REFUSED


def test_policies(q, rows):
    r = Resource("doc", DOC.attributes, "attribute", "org", policy=Policy(row=lambda actor: F.col("id") > actor, fields={"name": lambda actor: actor > 5}))
    guarded = Query(r, q.source, "o1", actor=2)
    assert {x.id for x in guarded.collect()} == {3, 4, 5, 6} and {x.name for x in guarded.collect()} == {None}
    with pytest.raises(UnsortableField):
        guarded.sort("name")
    with pytest.raises(NotFilterable):
        related(q, "kin", guarded, ref("id") == 1)


def test_branch_limit_is_scoped(q):
    both = q.combine("base", q.sort("amount").limit(1)).combine("union", q.filter(ref("amount") == 30))
    assert {r.id for r in both.collect()} == {2, 1}


def test_vector_requests(spark):
    r = Resource("v", (A("id", "integer", pk=True), A("org"), A("e", "vector")), "attribute", "org", vector_indexes=(VectorIndex("e", 2, "euclidean"),))
    rows = spark.createDataFrame([(1, "b", [0.0, 0.0]), (2, "a", [3.0, 4.0]), (3, "a", [6.0, 8.0]), (4, "a", None)], "id long, org string, e array<float>")
    v = Query(r, MemorySource({(None, "v"): rows}), "a")
    assert [(x.id, x.distance) for x in knn(v, "e", [0, 0], 5).collect()] == [(2, 5.0), (3, 10.0)]
    for bad in (lambda: knn(v, "e", [0], 1), lambda: knn(v, "e", [0, 0], 0), lambda: knn(v.limit(1), "e", [0, 0], 1), lambda: knn(v.for_tenant(None), "e", [0, 0], 1), lambda: knn(v, "e", [0, 0], 1, max_candidates=2)):
        with pytest.raises(GraphError):
            bad()


def test_writes(spark, rows):
    old = rows.select("*")
    r = Resource("doc", tuple(a for a in DOC.attributes if a.name in rows.columns), "attribute", "org")
    new = spark.createDataFrame([(1, "x", "first", 1), (1, "x", "last", None), (9, "x", "mine", 2)], "id long, org string, name string, amount long").coalesce(1)
    got = {(x.id, x.org): (x.name, x.amount) for x in W.upsert(r, old, new, tenant="o1", fields=["name"]).collect()}
    assert got[1, "o1"] == ("last", 30) and got[9, "o1"] == ("mine", 2) and got[9, "o2"] == ("z", 10)
    with pytest.raises(StaleRecord):
        W.update_one(r, old, {"id": 77}, {"name": "n"}, tenant="o1")
    with pytest.raises(UpdateFailed):
        W.update_one(r, old, {"id": 1}, {"org": "o2"}, tenant="o1")
    moved = W.update_one(r, old, {"id": 1}, {"id": 100}, tenant="o1", atomics={"amount": ref("amount") + 1})
    assert {(x.id, x.amount) for x in moved.where("id > 50").collect()} == {(100, 31)}
    assert W.destroy_one(r, old, {"id": 1}, tenant="o1").count() == 7


def test_store_and_transactions(spark, rows, tmp_path):
    r = Resource("doc", tuple(a for a in DOC.attributes if a.name in rows.columns))
    store = Store(spark, str(tmp_path))
    store.write(r, None, lambda old: old.unionByName(rows))
    assert store.scan(r, None).count() == 8
    with pytest.raises(ValueError), store.transaction():
        store.write(r, None, lambda old: old.limit(0))
        assert store.scan(r, None).count() == 0
        raise ValueError
    assert store.scan(r, None).count() == 8
    with pytest.raises(UpdateFailed), store.transaction(), store.transaction("other"):
        pass
    with pytest.raises(ConcurrentModification):
        with store.transaction() as tx:
            tx.staged["doc"] = rows.limit(1)
            store._publish(None, {"version": 2, "labels": tx.base["labels"], "watermarks": {}})
    assert store.scan(r, None).count() == 8


def test_a_dead_writers_lock_goes_after_its_lease(spark, rows, tmp_path):
    r = Resource("doc", tuple(a for a in DOC.attributes if a.name in rows.columns))
    store, folder = Store(spark, str(tmp_path)), tmp_path / "_default" / "_manifest"
    store.write(r, None, lambda old: old.unionByName(rows))
    lock = folder / f".lock-{2:012d}"
    lock.touch()
    with pytest.raises(ConcurrentModification):
        store.write(r, None, lambda old: old.limit(1))
    assert store.scan(r, None).count() == 8
    os.utime(lock, (0, 0))
    store.write(r, None, lambda old: old.limit(1))
    assert store.scan(r, None).count() == 1 and store.manifest()["version"] == 2


def test_traversal_scope_and_spans(spark, rows):
    plain = Resource("doc", tuple(a for a in DOC.attributes if a.name in rows.columns))
    owned = Resource("doc", plain.attributes, "attribute", "org")
    other = Resource("doc", plain.attributes, "attribute", "name")
    source = MemorySource({(None, "doc"): rows})
    edges = spark.createDataFrame([(1, 1, 2, "o1"), (2, 2, 3, "o1"), (3, 3, 9, "o1"), (4, 2, 4, None), (5, 1, 3, "o1")], "edge_id long, src long, dst long, tenant string")
    t, seen = Traversal("KIN", 3), []
    telemetry.attach(on := lambda event, metadata: seen.append((event, metadata)))
    try:
        pairs = {(r.source_id, r.id) for r in delivered(Query(owned, source, "o1"), t, edges, Query(plain, source))}
        assert pairs == {(1, 2), (1, 3), (2, 3)}  # the source's tenant binds every node and edge of a path
        assert fold(Query(owned, source, "o1"), Aggregate("n", "count")).n == 7
    finally:
        telemetry.detach(on)
    spans = {event: metadata for event, metadata in seen}
    assert (spans["traverse"]["row_count"], spans["traverse"]["destination_count"], spans["traverse"]["depth"]) == (4, 3, 3)
    assert spans["aggregate"]["kinds"] == ["count"] and spans["aggregate"]["outcome"] == "ok"
    for dest in (Query(other, source, "o1"), Query(owned, source, "o2")):
        with pytest.raises(QueryFailed):
            delivered(Query(owned, source, "o1"), t, edges, dest)
    nameless = Resource("doc", tuple(a for a in plain.attributes if a.name != "org"))
    assert delivered(Query(owned, source, "o1"), t, edges, Query(nameless, source)) == []


MIRROR = Resource("mirror", (A("id", "integer", pk=True), A("org"), A("note"), A("n", "integer")), "attribute", "org")


def _changes(spark, *rows):
    return spark.createDataFrame([(lsn, seq, op, None, "t", rec, old) for lsn, seq, op, rec, old in rows], cdc.SCHEMA)


def test_change_stream(spark, tmp_path):
    store, specs = Store(spark, str(tmp_path)), [cdc.MirrorSpec(MIRROR, "t")]
    first = _changes(spark, (1, 0, "insert", {"id": "1", "org": "a", "note": "x", "n": "1"}, None), (2, 0, "update", {"id": "1", "org": "a", "n": "2"}, None), (2, 1, "insert", {"id": "2", "org": "a", "note": "y"}, None))
    assert cdc.start_mode(store, "s") == "snapshot"
    assert cdc.apply(store, first, specs, "s") == 2
    rows = lambda: {(r.id, r.org, r.note, r.n) for r in store.scan(MIRROR, None).collect()}
    assert rows() == {(1, "a", "x", 2), (2, "a", "y", None)}
    cdc.apply(store, _changes(spark, (2, 5, "delete", None, {"id": "1", "org": "a"})), specs, "s")  # replayed: nothing
    assert rows() == {(1, "a", "x", 2), (2, "a", "y", None)}
    cdc.apply(store, _changes(spark, (3, 0, "update", {"id": "1", "org": "b", "note": "moved"}, {"id": "1", "org": "a"}), (4, 0, "delete", None, {"id": "2", "org": "a"})), specs, "s")
    assert rows() == {(1, "b", "moved", None)} and store.watermark("s") == 4
    for bad, reason in (((5, 0, "truncate", None, None), "truncate_halted"), ((5, 0, "insert", {"id": "3", "org": " "}, None), "tenant_required"), ((5, 0, "insert", {"org": "a"}, None), "key_required")):
        with pytest.raises(CdcError) as e:
            cdc.apply(store, _changes(spark, (5, 0, "insert", {"id": "8", "org": "a"}, None), bad), specs, "s")
        assert e.value.reason == reason
    assert rows() == {(1, "b", "moved", None)} and store.watermark("s") == 4


def test_change_stream_by_structured_streaming(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    _changes(spark, (1, 0, "insert", {"id": "1", "org": "a"}, None), (2, 0, "insert", {"id": "2", "org": "a"}, None)).write.parquet(str(tmp_path / "in"))
    stream_ = spark.readStream.schema(cdc.SCHEMA).parquet(str(tmp_path / "in"))
    for k in range(2):  # a lost stream checkpoint delivers everything again
        run = cdc.start(store, stream_, [cdc.MirrorSpec(MIRROR, "t")], "s", str(tmp_path / f"check{k}"), available_now=True)
        run.awaitTermination(120)
        assert store.scan(MIRROR, None).count() == 2 and store.watermark("s") == 2


@pytest.fixture(scope="module")
def staff(spark):
    """Vector rows of two tenants, with a field that actors may not see."""
    attributes = (A("id", "integer", pk=True), A("org"), A("e", "vector"), A("tokens", "array_integer"), A("weights", "array_float"), A("body"), A("salary", "integer"), A("key", "binary", sensitive=True))
    r = Resource("v", attributes, "attribute", "org", vector_indexes=(VectorIndex("e", 2, "euclidean"),), sparse_indexes=(SparseIndex("s", "tokens", "weights"),), policy=Policy(row=lambda actor: F.col("id") < 90, fields={"salary": lambda actor: actor == "boss"}))
    data = [(1, "b", [0.0, 0.0], [1], [1.0], "red fox", 100), (2, "a", [3.0, 4.0], [1, 2], [2.0, 1.0], "red red hen", 200), (3, "a", [6.0, 8.0], [2], [1.0], "blue hen", 300), (99, "a", [0.0, 0.0], [1], [9.0], "red", 400)]
    return Query(r, MemorySource({(None, "v"): spark.createDataFrame(data, "id long, org string, e array<float>, tokens array<long>, weights array<double>, body string, salary long")}), "a", "clerk")


def test_vector_results_are_masked_and_scoped(staff):
    searches = (lambda q, **more: knn(q, "e", [0, 0], 5, **more), lambda q, **more: sparse(q, "s", [1, 2], [1.0, 1.0], 5, **more), lambda q, **more: fulltext(q, "body", "red hen", 5, **more))
    for search in searches:
        rows = search(staff).collect()
        assert {r.id for r in rows} == {2, 3} and {r.salary for r in rows} == {None} and "key" in rows[0]
        assert {r.salary for r in search(staff.as_actor("boss")).collect()} == {200, 300}
        assert {r.id for r in search(staff.for_tenant(None), allow_global=True).collect()} == {1, 2, 3}
        assert {r.id for r in search(staff.filter(ref("id") == 3)).collect()} == {3}
        for refused in (lambda s=search: s(staff.for_tenant(None)), lambda s=search: s(staff, max_candidates=1), lambda s=search: s(staff.for_tenant(None), allow_global=True, max_candidates=2)):
            with pytest.raises(GraphError):
                refused()
        assert search(staff, max_candidates=2).count() == 2 and search(staff, max_candidates="2").count() == 2
    for refused in (lambda: sparse(staff, "s", [1], [1.0], 5, group_by="salary"), lambda: sparse(staff, "s", [1], [1.0], 5, group_by="key"), lambda: fulltext(staff, "key", "x", 5), lambda: fulltext(staff, "nothing", "x", 5)):
        with pytest.raises(QueryFailed):
            refused()


def test_strict_searches_within_a_tenant_have_a_ceiling(spark, staff):
    many = spark.range(10_001).selectExpr("id % 80 AS id", "'a' AS org", "array(1.0F, 2.0F) AS e")
    q = Query(staff.resource, MemorySource({(None, "v"): many}), "a", "clerk")
    with pytest.raises(QueryFailed) as e:
        knn(q, "e", [0, 0], 1)
    assert e.value.reason == "too_many_candidates"
    assert knn(Query(q.resource, q.source, "a", "clerk", strict=False), "e", [0, 0], 1).count() == 1 and knn(q, "e", [0, 0], 1, max_candidates=20_000).count() == 1


@pytest.mark.parametrize("kind", ["union", "union_all", "intersect", "except"])
def test_keyset_walk_over_a_combination_is_the_full_read(q, kind):
    for first, second in ((q.sort(("amount", "desc_nils_last")).limit(4), q.filter(ref("id") > 2)), (q.sort("name").limit(3), q.sort(("name", "desc")).limit(3))):
        both = q.combine("base", first).combine(kind, second).sort(("amount", "asc"))
        full = [r.id for r in both.collect()]
        if len(set(full)) == len(full):
            for size in (1, 2, 5):
                assert [r.id for r in stream(both, size)] == full


def test_limits_of_related_rows_hold_for_each_parent(q, rows):
    r = Resource("doc", tuple(a for a in DOC.attributes if a.name in rows.columns), "attribute", "org", relationships=(Relationship("same", "has_many", "doc", "amount", "amount"),))
    s = Query(r, q.source, "o1")
    of = {x.id: [y.id for y in x.same] for x in load(s, "same", s.sort(("id", "desc")).offset(1).limit(1)).collect()}
    assert of == {0: [], 1: [], 2: [4], 3: [], 4: [4], 5: [], 6: [4]}
    assert {(x["__tg_key"], x["__tg_nth"], x.id) for x in related_rows(s, "same", s.filter(ref("amount") == 10).limit(2)).collect()} == {(10, 1, 2), (10, 2, 4)}
    for refused in (lambda: load(s, "same", s.distinct("name")), lambda: related(s, "same", s.limit(1)), lambda: exists(s, "same", s.offset(1)), lambda: relationship_aggregates(s, "same", s.limit(1), Aggregate("n", "count")), lambda: load(s, "same", s.combine("base", s))):
        with pytest.raises(QueryFailed):
            refused()


def test_a_load_across_strategies(spark, rows):
    """Parents of a discriminator, children of a storage root each by its own tenant."""
    parent = Resource("doc", tuple(a for a in DOC.attributes if a.name in rows.columns), "attribute", "org", relationships=(Relationship("notes", "has_many", "note", "id", "doc_id"),))
    note = Resource("note", (A("id", "integer", pk=True), A("doc_id", "integer"), A("say")), "context")
    notes = lambda *x: spark.createDataFrame(x, "id long, doc_id long, say string")
    source = MemorySource({(None, "doc"): rows, ("t_o1", "note"): notes((1, 2, "mine"), (2, 9, "odd")), ("t_o2", "note"): notes((1, 2, "theirs"))})
    out = load(Query(parent, source, "o1"), "notes", Query(note, source, "o1")).collect()
    assert {x.id: [y.say for y in x.notes] for x in out if x.notes} == {2: ["mine"]}
    with pytest.raises(TenantRequired):
        load(Query(parent, source, "o1"), "notes", Query(note, source))


def brute_reach(edges, sources, direction, low, high):
    """Pairs by trails, walked one by one."""
    steps = [(e, a, b) for e, a, b in edges] * (direction != "incoming") + [(e, b, a) for e, a, b in edges] * (direction != "outgoing")
    out = set()

    def walk(source, node, used):
        if low <= len(used):
            out.add((source, node))
        if len(used) < high:
            for e, a, b in steps:
                if a == node and e not in used:
                    walk(source, b, used | {e})

    for x in sources:
        walk(x, x, frozenset())
    return out


@pytest.mark.parametrize("direction", ["outgoing", "incoming", "both"])
@pytest.mark.parametrize("low", [1, 2])
def test_traversal_by_trails(spark, direction, low):
    rng = random.Random(5)
    plain = Resource("p", (A("id", "string", pk=True),))
    people = spark.createDataFrame([(f"p{i}",) for i in range(9)], "id string")
    edges = [(f"e{k}", f"p{rng.randrange(9)}", f"p{rng.randrange(9)}") for k in range(10)] + [("x1", "p0", "p1"), ("x2", "p0", "p1"), ("x3", "p2", "p2")]
    df = spark.createDataFrame(edges, "edge_id string, src string, dst string")
    q = Query(plain, MemorySource({(None, "p"): people}))
    got = {(r.source_id, r.id) for r in traverse(q, Traversal("E", 3, direction, low), df, q).collect()}
    assert got == brute_reach(edges, [f"p{i}" for i in range(9)], direction, low, 3)


def test_traversal_over_labels(spark):
    person = Resource("person", (A("id", "integer", pk=True), A("org")), "attribute", "org")
    city = Resource("city", (A("id", "integer", pk=True), A("org"), A("size", "integer")), "attribute", "org", policy=Policy(row=lambda actor: F.col("size") > actor))
    road = Resource("road", (A("id", "integer", pk=True), A("org")), "attribute", "org")
    make = lambda s, *x: spark.createDataFrame(x, s)
    source = MemorySource({
        (None, "person"): make("id long, org string", (1, "a"), (2, "a"), (3, "b")), (None, "city"): make("id long, org string, size long", (1, "a", 10), (2, "a", 1), (4, "b", 10)),
        (None, "road"): make("id long, org string", (1, "a"), (2, "b")),
    })
    edges = make("edge_id long, src_label string, src long, dst_label string, dst long, tenant string", (1, "person", 1, "city", 1, "a"), (2, "person", 2, "road", 1, "a"), (3, "road", 1, "city", 1, "a"), (4, "person", 1, "city", 2, "a"), (5, "person", 2, "road", 2, "a"), (6, "road", 2, "city", 1, "a"), (7, "person", 1, "city", 4, "a"))
    q, to, by = Query(person, source, "a"), Query(city, source, "a", actor=5), Query(road, source, "a")
    pairs = lambda **more: {(r.source_id, r.id) for r in traverse(q, Traversal("E", 2, **more.pop("t", {})), edges, to, **more).collect()}
    assert pairs() == {(1, 1)} and pairs(through=(by,)) == {(1, 1), (2, 1)} and pairs(through=(by,), t={"min_depth": 2}) == {(2, 1)}
    plain = edges.drop("src_label", "dst_label").where("edge_id IN (1, 4)")
    assert {(r.source_id, r.id) for r in traverse(q, Traversal("E", 1), plain, to).collect()} == {(1, 1)}


def brute_upsert(old, batch, fields, where, atomics):
    """Rows of a batch one after another; rows: key -> dict."""
    out = {k: dict(v) for k, v in old.items()}
    told = {}
    for row in batch:
        k = row["id"]
        if k not in out:
            out[k] = dict(row)
            told[k] = "created"
        elif where is None or where(out[k]):
            out[k] |= {f: row[f] for f in fields} | {f: g(out[k]) for f, g in atomics.items()}
            told[k] = told.get(k) if told.get(k) == "created" else "updated"
        else:
            told.setdefault(k, "skipped")
    return out, told


def test_upserts_of_a_batch_act_in_turn(spark):
    r = Resource("t", (A("id", "integer", pk=True), A("name"), A("n", "integer")))
    rng = random.Random(6)
    for conditional in (False, True):
        for _ in range(4):
            old = {i: {"id": i, "name": rng.choice("abc"), "n": rng.randrange(6)} for i in range(4)}
            batch = [{"id": rng.randrange(8), "name": rng.choice("xyz"), "n": rng.randrange(6), "o": o} for o in range(14)]
            df = spark.createDataFrame([tuple(x.values()) for x in rng.sample(batch, len(batch))], "id long, name string, n long, o int").repartition(3)
            rows = spark.createDataFrame([tuple(x.values()) for x in old.values()], "id long, name string, n long")
            want, told = brute_upsert(old, [{k: v for k, v in x.items() if k != "o"} for x in batch], ["name"], (lambda x: x["n"] < 4) if conditional else None, {"n": lambda x: x["n"] + 1} if conditional else {})
            got = W.upsert(r, rows, df, fields=["name"], where=ref("n") < 4 if conditional else None, update_atomics={"n": ref("n") + 1} if conditional else None, order="o", outcome="told").collect()
            assert {x.id: (x.name, x.n) for x in got} == {k: (v["name"], v["n"]) for k, v in want.items()}
            assert {x.id: x.told for x in got if x.told and (conditional or x.told == "created")} == {k: v for k, v in told.items() if conditional or v == "created"}
    new = spark.createDataFrame([(1, "k", 5), (1, "l", 6)], "id long, name string, n long").coalesce(1)
    made = W.upsert(r, spark.createDataFrame([], "id long, name string, n long"), new, fields=["name"], create_atomics={"n": ref("n") * 2}, guard=False)
    assert [(x.name, x.n) for x in made.collect()] == [("l", 10)]
    one = W.upsert(r, made, new.limit(1), fields=["name"], update_atomics={"name": if_(ref("n") > 9, "big", "small")})
    assert [(x.name, x.n) for x in one.collect()] == [("big", 10)]


def test_guards_of_writes(spark, rows):
    r = Resource("doc", (A("id", "integer", pk=True), A("org"), A("name"), A("secret", "binary", sensitive=True), A("draft", skip=True)), "attribute", "org")
    old = spark.createDataFrame([(1, "a", "x", b"s"), (1, "b", "y", None), (2, "a", "z", None), (2, "a", "again", None)], "id long, org string, name string, secret binary")
    change = lambda i: spark.createDataFrame([(i, "new")], "id long, name string")
    assert {(x.id, x.org, x.name) for x in W.update_many(r, old, change(1), tenant="a").collect()} == {(1, "a", "new"), (1, "b", "y"), (2, "a", "z"), (2, "a", "again")}
    for refused in (
        lambda: W.update_many(r, old, change(2), tenant="a"), lambda: W.update_many(r, old, change(1).unionByName(change(1)), tenant="a"), lambda: W.upsert(r, old, change(2), tenant="a"), lambda: W.update_query(r, old, F.lit(True), {"org": "b"}),
        lambda: W.update_query(r, old, F.lit(True), {"draft": "b"}), lambda: W.update_query(r, old, F.lit(True), {}), lambda: W.update_query(r, old, F.lit(True), None, {"secret": ref("name")}),
    ):
        with pytest.raises(UpdateFailed):
            refused()
    assert {bytes(x.secret) for x in W.update_query(r, old, F.lit(True), {"secret": b"t"}).collect()} == {b"t"}
    with pytest.raises(QueryFailed):
        W.update_query(r, old, F.lit(True), {"secret": "text"})
    whole, made = W.create(r, old, change(7), "a")
    assert whole.count() == 5 and [(x.id, x.org) for x in made.collect()] == [(7, "a")]
    for n in (0, 2):
        with pytest.raises(CreateFailed):
            W.create(r, old, spark.range(n).selectExpr("id", "'x' AS name"), "a")


def test_edges(spark):
    edge = lambda *x: spark.createDataFrame(x, "label string, src long, dst long, tenant string, since long")
    people = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (3, "b")], "id long, tenant string")
    old = edge(("K", 1, 2, "a", 5), ("K", 2, 3, "a", 6))
    merged = W.create_edges(old, edge(("K", 1, 2, "a", None), ("K", 2, 1, "a", 9)), people, multiple=False)
    assert {tuple(x) for x in merged.collect()} == {("K", 1, 2, "a", 5), ("K", 2, 3, "a", 6), ("K", 2, 1, "a", 9)}
    for bad in (edge(("K", 1, 9, "a", 1)), edge(("K", 3, 1, "b", 1)), edge(("K", 1, 2, "a", 1), ("K", None, 2, "a", 1))):
        with pytest.raises(InvalidRelationship):
            W.create_edges(old, bad, people, multiple=True)
    r = Resource("p", (A("id", "integer", pk=True), A("since", "binary", sensitive=True)))
    with pytest.raises(InvalidRelationship):
        W.create_edges(old, edge().limit(0), people, multiple=True, resource=r)
    pair = lambda *x: spark.createDataFrame(x, "label string, src long, dst long, tenant string")
    assert W.destroy_edges(old, pair(("K", 2, 1, "a"), ("K", 2, 3, "a")), direction="both").count() == 0
    assert W.destroy_edges(old, pair(("K", 2, 1, "a")), direction="incoming").count() == 1
    for direction, gone in (("outgoing", pair(("K", 1, 2, "a"), ("K", 2, 1, "a"))), ("both", pair(("K", 1, 2, "a"), ("K", 1, 3, "a"))), ("outgoing", pair(("K", 1, 2, "b")))):
        with pytest.raises(StaleRecord):
            W.destroy_edges(old, gone, direction=direction)
    vertex = Resource("p", (A("id", "integer", pk=True), A("tenant")), "attribute", "tenant")
    left, edges = W.destroy(vertex, people, old, {"id": 2}, tenant="a")
    assert left.count() == 3 and edges.count() == 0


def test_store_rewrites_touched_buckets_alone(spark, tmp_path):
    r = Resource("doc", (A("id", "integer", pk=True), A("org"), A("n", "integer")), "attribute", "org")
    store = Store(spark, str(tmp_path), buckets=8)
    store.write(r, None, lambda old: old.unionByName(spark.range(100).selectExpr("id", "'a' AS org", "0L AS n")))
    before, reader = store.manifest()["labels"]["doc"]["paths"], store.pinned()
    assert len(before) == 8 and reader.scan(r, None).count() == 100
    new = spark.createDataFrame([(5, "a", 1), (500, "a", 1)], "id long, org string, n long")
    store.write(r, None, lambda old: W.upsert(r, old, new, tenant="a"), keys=new)
    after = store.manifest()["labels"]["doc"]["paths"]
    assert 1 <= sum(before.get(b) != p for b, p in after.items()) <= 2
    assert store.scan(r, None).count() == 101 and {x.id for x in store.scan(r, None).where("n = 1").collect()} == {5, 500}
    assert reader.scan(r, None).count() == 100 and reader.scan(r, None).where("n = 1").isEmpty()
    with store.transaction():  # writes of one transaction see each other
        store.write(r, None, lambda old: W.update_query(r, old, F.col("id") == 7, {"n": 7}), keys=spark.createDataFrame([(7, "a")], "id long, org string"))
        store.write(r, None, lambda old: W.update_query(r, old, F.col("id").isin(7, 8), None, {"n": ref("n") + 10}), keys=spark.createDataFrame([(7, "a"), (8, "a")], "id long, org string"))
        assert store.scan(r, None).where("n > 9").count() == 2
        store.write(r, None, lambda old: W.destroy_query(old, F.col("id") == 500)[0])
    assert {(x.id, x.n) for x in store.scan(r, None).where("n > 0").collect()} == {(5, 1), (7, 17), (8, 10)} and store.scan(r, None).count() == 100
    assert store.vacuum(keep=1) == 0 and store.vacuum(keep=1, age=-5) >= 1 and store.scan(r, None).count() == 100 and len(store._versions(None)) == 1
    store.clear(r)
    assert store.scan(r, None).count() == 0
    q = Query(r, store, "a")
    store.write(r, None, lambda old: old.unionByName(spark.createDataFrame([(1, "a", 1)], "id long, org string, n long")))
    assert q.combine("base", q).combine("union", q).collect()[0].id == 1


def test_a_second_applier_undoes_nothing(spark, tmp_path, monkeypatch):
    store, specs = Store(spark, str(tmp_path)), [cdc.MirrorSpec(MIRROR, "t")]
    put = lambda lsn, note: _changes(spark, (lsn, 0, "update", {"id": "1", "org": "a", "note": note}, None))
    cdc.apply(store, put(1, "old"), specs, "s")
    again = {"n": 0}
    check = cdc.check

    def between(changes, by):  # another applier commits while this one works
        check(changes, by)
        if not again["n"]:
            again["n"] = 1
            from tenantgraph.sources import store as module

            token = module._current.set(None)
            try:
                cdc.apply(store, put(2, "old").unionByName(put(3, "new")), specs, "s")
            finally:
                module._current.reset(token)

    monkeypatch.setattr(cdc, "check", between)
    assert cdc.apply(store, put(2, "old"), specs, "s") == 3
    assert [x.note for x in store.scan(MIRROR, None).collect()] == ["new"] and store.watermark("s") == 3
    with pytest.raises(UpdateFailed), store.transaction() as tx:
        tx.watermarks["s"] = 2
    assert store.watermark("s") == 3


def test_snapshot_is_checked_as_changes_are(spark, tmp_path):
    r = Resource("m", (A("id", "integer", pk=True), A("org"), A("note"), A("key", "binary", sensitive=True)), "attribute", "org")
    store = Store(spark, str(tmp_path))
    table = lambda s, *x: spark.createDataFrame(x, s)
    good = table("id long, org string, note string", (1, "a", "x"), (2, "b", None))
    for rows, reason in (
        (table("id long, org string", (None, "a")), "key_required"), (table("id long, org string", (1, " ")), "tenant_required"), (table("id long, note string", (1, "x")), "tenant_required"), (good.withColumn("key", F.lit(b"k")), "sensitive_column"),
        (good.unionByName(good), "repeated_key"),
    ):
        with pytest.raises(CdcError) as e:
            cdc.snapshot(store, {"t": rows}, [cdc.MirrorSpec(r, "t")], "s", 5)
        assert e.value.reason == reason and cdc.start_mode(store, "s") == "snapshot"
    other = Resource("o", MIRROR.attributes, "attribute", "org")
    skipping = [cdc.MirrorSpec(r, "t", skip=("key",)), cdc.MirrorSpec(other, "t", schema="more")]
    cdc.snapshot(store, {("public", "t"): good.withColumn("key", F.lit(b"k")), ("more", "t"): good.limit(1)}, skipping, "s", 5)
    assert {x.key for x in store.scan(r, None).collect()} == {None} and store.scan(other, None).count() == 1 and cdc.start_mode(store, "s") == "resume"
    change = spark.createDataFrame([(6, 0, "update", None, "t", {"id": "1", "org": "a", "key": "plain", "note": "y"}, None)], cdc.SCHEMA)
    cdc.apply(store, change, skipping, "s")
    assert {(x.id, x.note, x.key) for x in store.scan(r, None).collect()} == {(1, "y", None), (2, None, None)}
    with pytest.raises(CdcError):
        cdc.snapshot(store, {"t": good}, skipping, "s2", 1)  # two schemas have it


def test_shared_folder(spark):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: None)

    with pytest.raises(RuntimeError):
        shared_dir(Session())
    assert shared_dir(spark) == shared_dir(spark) and (spark.conf.get("spark.checkpoint.dir", None) or True)
