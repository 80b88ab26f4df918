"""Resources over the TPC-H-like tables, and one query per operator with the SQL that says the same."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantgraph.functions.expr import call, if_, lit, ref
from tenantgraph.operators import writes as W
from tenantgraph.operators.aggregates import Aggregate, aggregate
from tenantgraph.operators.paging import page
from tenantgraph.operators.relate import exists, load, related, relationship_aggregates
from tenantgraph.operators.traverse import Traversal, traversal_aggregates, traverse
from tenantgraph.operators.vector import Arm, fulltext, hybrid, knn, sparse
from tenantgraph.plans.query import Query
from tenantgraph.resource import Attribute as A
from tenantgraph.resource import Edge, Policy, Relationship, Resource, SparseIndex, VectorIndex
from tenantgraph.scratch import shared_dir
from tenantgraph.sources.scan import MemorySource, ParquetSource, decoded
from tenantgraph.sources.store import Store
from tenantgraph.streaming import cdc

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Run], Run]:
    def register(f: Run) -> Run:
        RUNS[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


# Resources

CUSTOMER = Resource(
    "customer",
    (A("c_custkey", "integer", pk=True), A("c_name"), A("c_nationkey", "integer"), A("c_acctbal", "float"), A("c_mktsegment"), A("bal", "float"), A("parent", "integer")),
    tenancy="attribute", discriminator="c_mktsegment", edges=(Edge("parent_of", "PARENT_OF"),),
    relationships=(
        Relationship("nation", "belongs_to", "nation", "c_nationkey", "n_nationkey"), Relationship("orders", "has_many", "orders", "c_custkey", "o_custkey"),
        Relationship("first_order", "has_one", "orders", "c_custkey", "o_custkey", sort=(("o_totalprice", "desc_nils_last"),)),
    ),
    calculations={
        "net": ref("c_acctbal") * 0.9, "ratio": ref("c_custkey") / 2, "both": ref("bal") + ref("c_nationkey"), "greeting": ref("c_name").concat("/").concat(ref("c_mktsegment")),
        "grade": if_(ref("bal") > 5000, "high", if_(ref("bal") > 0, "low", "debt")), "some": if_(ref("bal") > 5000, ref("c_name")), "missing": ref("bal").is_nil(),
        "low_name": call("string_downcase", ref("c_name")), "name_length": call("string_length", call("string_trim", ref("c_name"))), "rounded": call("round", ref("c_acctbal")),
        "starts": ref("c_name").starts_with("Customer#0000001"), "has_nine": ref("c_name").contains("9"), "per_nation": ref("c_acctbal") / ref("c_nationkey"),
        "rich_or_far": (ref("bal") > 5000) | ~(ref("c_nationkey") < 10), "rich_and_far": (ref("bal") > 5000) & (ref("c_nationkey") >= 10), "nation_text": call("type", ref("c_nationkey"), "string"),
        "shout": lambda df: F.upper(F.col("c_name")),
    },
)
NATION = Resource("nation", (A("n_nationkey", "integer", pk=True), A("n_name"), A("n_regionkey", "integer")), relationships=(Relationship("region", "belongs_to", "region", "n_regionkey", "r_regionkey"),))
REGION = Resource("region", (A("r_regionkey", "integer", pk=True), A("r_name")))
ORDERS = Resource("orders", (A("o_orderkey", "integer", pk=True), A("o_custkey", "integer"), A("o_orderstatus"), A("o_totalprice", "float"), A("o_orderdate", "naive_datetime"), A("o_orderpriority")))
TENANT_ORDERS = Resource("orders", ORDERS.attributes, tenancy="attribute", discriminator="o_orderpriority")
PART = Resource("part", (A("p_partkey", "integer", pk=True), A("p_name"), A("p_brand"), A("p_type"), A("p_size", "integer"), A("p_retailprice", "float")), relationships=(
    Relationship("suppliers", "many_to_many", "supplier", "p_partkey", "s_suppkey", through="lineitem", through_source="l_partkey", through_destination="l_suppkey"),))
SUPPLIER = Resource("supplier", (A("s_suppkey", "integer", pk=True), A("s_name"), A("s_nationkey", "integer"), A("s_acctbal", "float")))
LINEITEM = Resource("lineitem", (A("l_orderkey", "integer", pk=True), A("l_linenumber", "integer", pk=True), A("l_partkey", "integer"), A("l_suppkey", "integer"), A("l_quantity", "float"), A("l_returnflag")))
DOCUMENT = Resource("documents", (A("doc_id", "integer", pk=True), A("text"), A("lang"), A("source"), A("n_chars", "integer")), tenancy="attribute", discriminator="lang",
    relationships=(Relationship("label", "has_one", "labels", "doc_id", "doc_id"),))
LABEL = Resource("labels", (A("doc_id", "integer", pk=True), A("quality", "integer"), A("toxic", "integer")))
VECTOR = Resource("embeddings", (A("vec_id", "integer", pk=True), A("embedding", "vector"), A("label", "integer"), A("tokens", "array_integer"), A("weights", "array_float")),
    vector_indexes=(VectorIndex("embedding", 64),), sparse_indexes=(SparseIndex("terms", "tokens", "weights"),))
DOT = Resource("embeddings", VECTOR.attributes, vector_indexes=(VectorIndex("embedding", 64, "dot_product"),))
L2 = Resource("embeddings", VECTOR.attributes, vector_indexes=(VectorIndex("embedding", 64, "euclidean"),))
VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customer": lambda s, d: s.read.parquet(f"{d}/customer.parquet").withColumn("bal", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))).withColumn("parent", F.floor(F.col("c_custkey") / 3)),
    "embeddings": lambda s, d: s.read.parquet(f"{d}/embeddings.parquet")
    .withColumn("__p", F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("long").alias("t"), x.cast("double").alias("w"))), lambda p: p["w"] > 0.1))
    .withColumns({"tokens": F.transform("__p", lambda p: p["t"]), "weights": F.transform("__p", lambda p: p["w"])}),
}
CUST = "(SELECT *, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS bal, c_custkey // 3 AS parent FROM customer)"


def on(r: Resource, spark: SparkSession, d: str, tenant: str | None = None, **more) -> Query:
    return Query(r, ParquetSource(spark, d, VIEWS), tenant, **more)


def building(spark: SparkSession, d: str) -> Query:
    return on(CUSTOMER, spark, d, "BUILDING")


def cust_filter(name: str, e, where: str, columns: str = "c_custkey, c_name, c_acctbal") -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return building(spark, d).filter(e).to_df().select(*columns.split(", "))

    run.__name__ = name
    query(f"SELECT {columns} FROM {CUST} WHERE c_mktsegment = 'BUILDING' AND ({where})")(run)


# Filters

cust_filter("filter_eq", ref("c_nationkey") == 7, "c_nationkey = 7")
cust_filter("filter_neq", ref("bal") != 0, "bal <> 0")
cust_filter("filter_range", (ref("c_acctbal") >= 1000) & (ref("c_acctbal") < 5000), "c_acctbal >= 1000 AND c_acctbal < 5000")
cust_filter("filter_in", ref("c_nationkey").is_in([1, 2, 3]), "c_nationkey IN (1, 2, 3)")
cust_filter("filter_is_nil", ref("bal").is_nil(), "bal IS NULL")
cust_filter("filter_is_not_nil", ref("bal").is_nil(False), "bal IS NOT NULL")
cust_filter("filter_bool_tree", ((ref("c_nationkey") == 1) | (ref("bal") > 9000)) & ~(ref("c_nationkey") == 3), "(c_nationkey = 1 OR bal > 9000) AND NOT (c_nationkey = 3)")
cust_filter("filter_not", ~(ref("bal") > 0), "NOT (bal > 0)")
cust_filter("filter_literal_false", lit(False), "FALSE")
cust_filter("filter_contains", ref("c_name").contains("12"), "contains(c_name, '12')")
cust_filter("filter_prefix", ref("c_name").starts_with("Customer#00000"), "starts_with(c_name, 'Customer#00000')")
cust_filter("filter_suffix", ref("c_name").ends_with("7"), "ends_with(c_name, '7')")
cust_filter("filter_expr_both_sides", ref("c_acctbal") + ref("c_nationkey") > ref("bal") * 0.5 + 100, "c_acctbal + c_nationkey > bal * 0.5 + 100")
cust_filter("filter_calculation", ref("net") > 4500, "c_acctbal * 0.9::DOUBLE > 4500")
cust_filter("filter_divide_by_zero", ref("per_nation") > 3000, "CASE WHEN c_nationkey = 0 THEN c_acctbal > 0 ELSE c_acctbal / c_nationkey > 3000 END")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'")
def filter_temporal_range(spark, d):
    e = (ref("o_orderdate") >= dt.datetime(1995, 1, 1)) & (ref("o_orderdate") < dt.datetime(1996, 1, 1))
    return on(TENANT_ORDERS, spark, d, "1-URGENT").filter(e).to_df().select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate IN (TIMESTAMP '1995-01-01', TIMESTAMP '1996-06-01', TIMESTAMP '1997-03-05')")
def filter_temporal_in(spark, d):
    return on(ORDERS, spark, d).filter(ref("o_orderdate").is_in([dt.datetime(1995, 1, 1), dt.datetime(1996, 6, 1), dt.datetime(1997, 3, 5)])).to_df().select("o_orderkey")


# Calculations


def cust_calc(name: str, calcs: dict[str, str]) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = building(spark, d).load(*calcs).to_df()
        return rows.select("c_custkey", *[F.round(c, 6).alias(c) if rows.schema[c].dataType.simpleString() == "double" else c for c in calcs])

    run.__name__ = name
    query(f"SELECT c_custkey, {', '.join(f'{e} AS {c}' for c, e in calcs.items())} FROM {CUST} WHERE c_mktsegment = 'BUILDING'")(run)


cust_calc("expr_arith", {"net": "round(c_acctbal * 0.9::DOUBLE, 6)", "both": "round(bal + c_nationkey, 6)"})
cust_calc("expr_div_float", {"ratio": "round(c_custkey / 2::DOUBLE, 6)"})
cust_calc("expr_concat", {"greeting": "c_name || '/' || c_mktsegment"})
cust_calc("expr_if_else", {"grade": "CASE WHEN bal > 5000 THEN 'high' WHEN bal > 0 THEN 'low' ELSE 'debt' END"})
cust_calc("expr_if_null", {"some": "CASE WHEN bal > 5000 THEN c_name END"})
cust_calc("expr_is_nil", {"missing": "bal IS NULL"})
cust_calc("expr_lower_len_trim", {"low_name": "lower(c_name)", "name_length": "length(trim(c_name))"})
cust_calc("expr_round", {"rounded": "round(c_acctbal)"})
cust_calc("expr_match_value", {"starts": "starts_with(c_name, 'Customer#0000001')", "has_nine": "contains(c_name, '9')"})


cust_calc("expr_bool_value", {"rich_or_far": "bal > 5000 OR NOT c_nationkey < 10", "rich_and_far": "bal > 5000 AND c_nationkey >= 10"})
cust_calc("expr_type", {"nation_text": "CAST(c_nationkey AS VARCHAR)"})
cust_calc("calc_module", {"shout": "upper(c_name)"})


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey > 20")
def tenant_context(spark, d):
    """A storage root for each tenant: the rows of the others aren't there to be read."""
    whole = VIEWS["customer"](spark, d)
    r = Resource("customer", CUSTOMER.attributes, "context")
    source = MemorySource({(f"t_{t}", "customer"): whole.where(F.col("c_mktsegment") == t) for t in ("BUILDING", "MACHINERY")})
    return Query(r, source, "MACHINERY").filter(ref("c_nationkey") > 20).to_df().select("c_custkey", "c_name")


@query("SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n FROM embeddings WHERE len(list_filter(embedding, lambda x: x::DOUBLE > 0.1)) > 10")
def expr_list_length(spark, d):
    r = Resource("embeddings", VECTOR.attributes, calculations={"n": call("length", ref("embedding"))})
    return on(r, spark, d).filter(call("length", ref("tokens")) > 10).load("n").to_df().select("vec_id", "n")


# Sort and paging

for _name, _dir, _sql in (("sort_nulls_asc", "asc", "ASC NULLS LAST"), ("sort_nulls_desc", "desc", "DESC NULLS FIRST"), ("sort_asc_nils_first", "asc_nils_first", "ASC NULLS FIRST"), ("sort_desc_nils_last", "desc_nils_last", "DESC NULLS LAST")):

    def _run(spark, d, _dir=_dir):
        return building(spark, d).sort(("bal", _dir)).limit(25).to_df().select("c_custkey", "bal")

    _run.__name__ = _name
    query(f"SELECT c_custkey, bal FROM {CUST} WHERE c_mktsegment = 'BUILDING' ORDER BY bal {_sql}, c_custkey LIMIT 25")(_run)


@query(f"SELECT c_custkey, c_acctbal FROM {CUST} WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal * 0.9::DOUBLE DESC NULLS FIRST, c_custkey LIMIT 20")
def sort_calc(spark, d):
    return building(spark, d).sort(("net", "desc")).limit(20).to_df().select("c_custkey", "c_acctbal")


@query(f"SELECT c_custkey, c_acctbal FROM {CUST} WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal, c_custkey LIMIT 15 OFFSET 10")
def limit_offset(spark, d):
    return building(spark, d).sort("c_acctbal").offset(10).limit(15).to_df().select("c_custkey", "c_acctbal")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND (c_nationkey > 5 OR c_nationkey = 5 AND c_custkey > 60) ORDER BY c_nationkey, c_custkey LIMIT 30")
def keyset_after(spark, d):
    return page(building(spark, d).sort("c_nationkey"), 30, after={"c_nationkey": 5, "c_custkey": 60}).select("c_custkey", "c_nationkey")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND (c_nationkey < 5 OR c_nationkey = 5 AND c_custkey < 60) ORDER BY c_nationkey DESC, c_custkey DESC LIMIT 30")
def keyset_before(spark, d):
    return page(building(spark, d).sort("c_nationkey"), 30, before={"c_nationkey": 5, "c_custkey": 60}).select("c_custkey", "c_nationkey")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND (c_nationkey < 20 OR c_nationkey = 20 AND c_custkey > 0) ORDER BY c_nationkey DESC, c_custkey LIMIT 40")
def keyset_dup_values(spark, d):
    return page(building(spark, d).sort(("c_nationkey", "desc_nils_last")), 40, after={"c_nationkey": 20, "c_custkey": 0}).select("c_custkey", "c_nationkey")


@query(f"SELECT c_custkey, bal FROM {CUST} WHERE c_mktsegment = 'BUILDING' AND (bal IS NULL AND c_custkey > 21 OR bal IS NOT NULL) ORDER BY bal ASC NULLS FIRST, c_custkey LIMIT 60")
def keyset_null_values(spark, d):
    return page(building(spark, d).sort(("bal", "asc_nils_first")), 60, after={"bal": None, "c_custkey": 21}).select("c_custkey", "bal")


# Distinct

_ON = "SELECT {c} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS rn FROM {t} WHERE {w}) WHERE rn = 1"
_B = "c_mktsegment = 'BUILDING'"


@query(_ON.format(c="c_custkey, c_nationkey, c_acctbal", k="c_nationkey", o="c_acctbal DESC, c_custkey", t=CUST, w=_B))
def distinct_rep_sort(spark, d):
    return building(spark, d).distinct("c_nationkey").distinct_sort(("c_acctbal", "desc")).to_df().select("c_custkey", "c_nationkey", "c_acctbal")


@query(_ON.format(c="c_custkey, c_nationkey", k="c_nationkey", o="c_acctbal, c_custkey", t=CUST, w=_B))
def distinct_query_sort(spark, d):
    return building(spark, d).distinct("c_nationkey").sort("c_acctbal").to_df().select("c_custkey", "c_nationkey")


@query(_ON.format(c="o_orderkey, o_orderstatus, o_orderpriority", k="o_orderstatus, o_orderpriority", o="o_totalprice DESC, o_orderkey", t="orders", w="TRUE"))
def distinct_multi_key(spark, d):
    return on(ORDERS, spark, d).distinct("o_orderstatus", "o_orderpriority").distinct_sort(("o_totalprice", "desc")).to_df().select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(_ON.format(c="c_custkey, c_nationkey", k="c_nationkey", o="c_custkey", t=CUST, w=_B + " AND c_acctbal > 5000"))
def distinct_filter_first(spark, d):
    return building(spark, d).filter(ref("c_acctbal") > 5000).distinct("c_nationkey").to_df().select("c_custkey", "c_nationkey")


@query(_ON.format(c="c_custkey, bal", k="bal", o="c_custkey", t=CUST, w=_B))
def distinct_null_group(spark, d):
    return building(spark, d).distinct("bal").to_df().select("c_custkey", "bal")


@query("SELECT c_custkey, c_nationkey FROM (" + _ON.format(c="*", k="c_nationkey", o="c_acctbal DESC, c_custkey", t=CUST, w=_B) + ") ORDER BY c_nationkey DESC, c_custkey LIMIT 7")
def distinct_outer_limit(spark, d):
    return building(spark, d).distinct("c_nationkey").distinct_sort(("c_acctbal", "desc")).sort(("c_nationkey", "desc")).limit(7).to_df().select("c_custkey", "c_nationkey")


@query("SELECT count(*) AS n, round(sum(c_acctbal), 4) AS total FROM (" + _ON.format(c="*", k="c_nationkey", o="c_acctbal DESC, c_custkey", t=CUST, w=_B) + ")")
def agg_over_distinct(spark, d):
    q = building(spark, d).distinct("c_nationkey").distinct_sort(("c_acctbal", "desc"))
    return aggregate(q, Aggregate("n", "count"), Aggregate("total", "sum", "c_acctbal")).withColumn("total", F.round("total", 4))


# Set operations


def _branches(spark, d):
    q = building(spark, d)
    return q, q.filter(ref("c_nationkey").is_in([1, 2, 3])), q.filter(ref("c_acctbal") > 6000), q.filter(ref("c_nationkey") == 2)


_A, _C, _N2 = (f"SELECT c_custkey FROM customer WHERE {_B} AND {w}" for w in ("c_nationkey IN (1, 2, 3)", "c_acctbal > 6000", "c_nationkey = 2"))


@query(f"{_A} UNION {_C}")
def combine_union(spark, d):
    q, a, b, _ = _branches(spark, d)
    return q.combine("base", a).combine("union", b).to_df().select("c_custkey")


@query(f"{_A} UNION ALL {_C}")
def combine_union_all(spark, d):
    q, a, b, _ = _branches(spark, d)
    return q.combine("base", a).combine("union_all", b).to_df().select("c_custkey")


@query(f"{_A} INTERSECT {_C}")
def combine_intersect(spark, d):
    q, a, b, _ = _branches(spark, d)
    return q.combine("base", a).combine("intersect", b).to_df().select("c_custkey")


@query(f"{_A} EXCEPT {_C}")
def combine_except(spark, d):
    q, a, b, _ = _branches(spark, d)
    return q.combine("base", a).combine("except", b).to_df().select("c_custkey")


@query(f"SELECT * FROM ({_A} UNION {_C}) UNION ALL SELECT * FROM ({_N2})")
def combine_union_then_union_all(spark, d):
    q, a, b, c = _branches(spark, d)
    return q.combine("base", a).combine("union", b).combine("union_all", c).to_df().select("c_custkey")


@query(f"SELECT * FROM ({_A} UNION {_C}) INTERSECT {_N2}")
def combine_mixed_chain(spark, d):
    q, a, b, c = _branches(spark, d)
    return q.combine("base", a).combine("union", b).combine("intersect", c).to_df().select("c_custkey")


@query(f"SELECT c_custkey FROM ({_C} ORDER BY c_acctbal DESC, c_custkey LIMIT 5) UNION SELECT * FROM ({_N2})")
def combine_branch_limit_scoped(spark, d):
    q, _, b, c = _branches(spark, d)
    return q.combine("base", b.sort(("c_acctbal", "desc")).limit(5)).combine("union", c).to_df().select("c_custkey")


@query(_ON.format(c="c_custkey, c_nationkey", k="c_nationkey", o="c_acctbal, c_custkey", t=CUST, w=_B + " AND (c_nationkey IN (1, 2, 3) OR c_acctbal > 6000)"))
def combine_outer_distinct(spark, d):
    q, a, b, _ = _branches(spark, d)
    return q.combine("base", a).combine("union", b).distinct("c_nationkey").distinct_sort("c_acctbal").to_df().select("c_custkey", "c_nationkey")


_KC = f"SELECT c_custkey, c_acctbal FROM ({_C.replace('c_custkey', 'c_custkey, c_acctbal')} ORDER BY c_acctbal DESC, c_custkey LIMIT 30) UNION SELECT c_custkey, c_acctbal FROM customer WHERE {_B} AND c_nationkey = 2"


@query(f"SELECT c_custkey, c_acctbal FROM ({_KC}) WHERE c_acctbal > 3000 OR c_acctbal = 3000 AND c_custkey > 10 ORDER BY c_acctbal, c_custkey LIMIT 12")
def keyset_combination(spark, d):
    """The cursor moves over the whole, not over a branch before its limit."""
    q, _, b, c = _branches(spark, d)
    both = q.combine("base", b.sort(("c_acctbal", "desc")).limit(30)).combine("union", c).sort("c_acctbal")
    return page(both, 12, after={"c_acctbal": 3000.0, "c_custkey": 10}).select("c_custkey", "c_acctbal")


# Aggregates


def cust_agg(name: str, aggregates: list[Aggregate], sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = aggregate(building(spark, d), *aggregates)
        for c, kind in out.dtypes:
            if kind.startswith("array"):
                out = out.withColumn(c, F.array_join(F.transform(c, lambda x: x.cast("string")), ","))
            elif kind == "double":
                out = out.withColumn(c, F.round(c, 4))
        return out

    run.__name__ = name
    query(f"SELECT {sql} FROM {CUST} WHERE {_B}")(run)


cust_agg("agg_count", [Aggregate("n", "count")], "count(*) AS n")
cust_agg("agg_count_field", [Aggregate("n", "count", "bal")], "count(bal) AS n")
cust_agg("agg_count_uniq", [Aggregate("n", "count", "c_nationkey", uniq=True)], "count(DISTINCT c_nationkey) AS n")
cust_agg("agg_exists", [Aggregate("e", "exists"), Aggregate("none", "exists", where=ref("c_acctbal") > 1e9)], "count(*) > 0 AS e, count(*) FILTER (c_acctbal > 1e9) > 0 AS none")
cust_agg("agg_sum", [Aggregate("s", "sum", "bal"), Aggregate("i", "sum", "c_nationkey")], "round(sum(bal), 4) AS s, CAST(sum(c_nationkey) AS BIGINT) AS i")
cust_agg("agg_avg", [Aggregate("a", "avg", "bal")], "round(avg(bal), 4) AS a")
cust_agg("agg_min_max", [Aggregate("lo", "min", "bal"), Aggregate("hi", "max", "c_name")], "round(min(bal), 4) AS lo, max(c_name) AS hi")
cust_agg("agg_first_sorted", [Aggregate("f", "first", "c_name", sort=(("c_acctbal", "desc"),)), Aggregate("g", "first", "bal", sort=(("c_name", "desc"),))], "arg_max(c_name, c_acctbal) AS f, round(arg_max(bal, c_name) FILTER (bal IS NOT NULL), 4) AS g")
cust_agg("agg_list", [Aggregate("l", "list", "c_nationkey", sort=(("c_custkey", "asc"),))], "string_agg(c_nationkey, ',' ORDER BY c_custkey) AS l")
cust_agg("agg_list_uniq", [Aggregate("l", "list", "c_nationkey", uniq=True)], "array_to_string(list_sort(list_distinct(list(c_nationkey))), ',') AS l")
cust_agg("agg_empty_defaults", [Aggregate("s", "sum", "bal", default=0.0, where=ref("c_acctbal") > 1e9), Aggregate("m", "max", "bal", where=ref("c_acctbal") > 1e9), Aggregate("n", "count", where=ref("c_acctbal") > 1e9)], "coalesce(sum(bal) FILTER (c_acctbal > 1e9), 0.0::DOUBLE) AS s, max(bal) FILTER (c_acctbal > 1e9) AS m, count(*) FILTER (c_acctbal > 1e9) AS n")
cust_agg("agg_per_filter", [Aggregate("a", "count", where=ref("c_nationkey") == 1), Aggregate("b", "sum", "c_acctbal", where=ref("bal") > 0)], "count(*) FILTER (c_nationkey = 1) AS a, round(sum(c_acctbal) FILTER (bal > 0), 4) AS b")


@query(f"SELECT CAST(count(*) AS BIGINT) AS total FROM {CUST} WHERE {_B} AND c_acctbal > 0")
def page_count(spark, d):
    return aggregate(building(spark, d).filter(ref("c_acctbal") > 0).limit(10), Aggregate("total", "count"))


# Relationships


@query(f"SELECT c_custkey, n_name FROM {CUST} LEFT JOIN nation ON n_nationkey = c_nationkey WHERE {_B}")
def rel_belongs_to(spark, d):
    return load(building(spark, d), "nation", on(NATION, spark, d)).select("c_custkey", F.col("nation.n_name").alias("n_name"))


@query("SELECT n_name, r_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey")
def rel_belongs_to_chain(spark, d):
    return load(on(NATION, spark, d), "region", on(REGION, spark, d)).select("n_name", F.col("region.r_name").alias("r_name"))


@query(f"SELECT c_custkey, coalesce(string_agg(o_orderkey, ',' ORDER BY o_orderkey), '') AS orders FROM {CUST} LEFT JOIN orders ON o_custkey = c_custkey WHERE {_B} GROUP BY c_custkey")
def rel_has_many(spark, d):
    return load(building(spark, d), "orders", on(ORDERS, spark, d)).select("c_custkey", F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), ",").alias("orders"))


@query(f"SELECT c_custkey, coalesce(string_agg(o_orderkey, ',' ORDER BY o_totalprice DESC, o_orderkey), '') AS orders FROM {CUST} LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) ON o_custkey = c_custkey AND rn BETWEEN 2 AND 4 WHERE {_B} GROUP BY c_custkey")
def rel_has_many_top(spark, d):
    """A limit and an offset of the destination hold for each parent."""
    out = load(building(spark, d), "orders", on(ORDERS, spark, d).sort(("o_totalprice", "desc")).offset(1).limit(3))
    return out.select("c_custkey", F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), ",").alias("orders"))


@query(f"SELECT c_custkey, arg_max(o_orderkey, o_totalprice) AS o FROM {CUST} LEFT JOIN orders ON o_custkey = c_custkey WHERE {_B} GROUP BY c_custkey")
def rel_has_one(spark, d):
    return load(building(spark, d), "first_order", on(ORDERS, spark, d)).select("c_custkey", F.col("first_order.o_orderkey").alias("o"))


@query("SELECT p_partkey, coalesce(string_agg(s, ',' ORDER BY s), '') AS suppliers FROM part LEFT JOIN (SELECT DISTINCT l_partkey, l_suppkey AS s FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) ON l_partkey = p_partkey GROUP BY p_partkey")
def rel_m2m(spark, d):
    out = load(on(PART, spark, d), "suppliers", on(SUPPLIER, spark, d), on(LINEITEM, spark, d))
    return out.select("p_partkey", F.array_join(F.transform("suppliers", lambda s: s["s_suppkey"].cast("string")), ",").alias("suppliers"))


def rel_filter(name: str, e, where: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return related(building(spark, d), "nation", on(NATION, spark, d), e).select("c_custkey")

    run.__name__ = name
    query(f"SELECT c_custkey FROM customer WHERE {_B} AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE {where})")(run)


rel_filter("rel_filter_eq", ref("n_name") == "NATION_3", "n_name = 'NATION_3'")
rel_filter("rel_filter_neq", ref("n_regionkey") != 2, "n_regionkey <> 2")
rel_filter("rel_filter_in", ref("n_regionkey").is_in([0, 4]), "n_regionkey IN (0, 4)")


@query(f"SELECT c_custkey FROM customer WHERE {_B} AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def rel_exists(spark, d):
    return exists(building(spark, d), "orders", on(ORDERS, spark, d), ref("o_totalprice") > 300000).select("c_custkey")


@query(f"SELECT c_custkey FROM customer WHERE {_B} AND FALSE")
def rel_exists_empty(spark, d):
    return exists(building(spark, d), "orders", on(ORDERS, spark, d), ref("o_totalprice") < -1).select("c_custkey")


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en'")
def rel_partial_has_one(spark, d):
    return load(on(DOCUMENT, spark, d, "en"), "label", on(LABEL, spark, d)).select("doc_id", F.col("label.quality").cast("int").alias("quality"))


@query(f"SELECT c_custkey, count(o_orderkey) AS n, round(sum(o_totalprice), 4) AS total, arg_max(o_orderkey, o_totalprice) AS best, coalesce(string_agg(o_orderkey, ',' ORDER BY o_totalprice), '') AS l, count(o_orderkey) > 0 AS e FROM {CUST} LEFT JOIN orders ON o_custkey = c_custkey WHERE {_B} GROUP BY c_custkey")
def relagg_count_sum_first_list(spark, d):
    out = relationship_aggregates(
        building(spark, d), "orders", on(ORDERS, spark, d), Aggregate("n", "count"), Aggregate("total", "sum", "o_totalprice"), Aggregate("best", "first", "o_orderkey", sort=(("o_totalprice", "desc"),)),
        Aggregate("l", "list", "o_orderkey", sort=(("o_totalprice", "asc"),)), Aggregate("e", "exists"),
    )
    return out.select("c_custkey", "n", F.round("total", 4).alias("total"), "best", F.array_join(F.transform("l", lambda x: x.cast("string")), ",").alias("l"), "e")


@query(f"SELECT c_custkey, round(coalesce(max(o_totalprice), 0.0), 4) AS hi, count(o_orderkey) AS n FROM {CUST} LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON o_custkey = c_custkey WHERE {_B} GROUP BY c_custkey")
def relagg_empty_default(spark, d):
    out = relationship_aggregates(building(spark, d), "orders", on(ORDERS, spark, d).filter(ref("o_totalprice") > 400000), Aggregate("hi", "max", "o_totalprice", default=0.0), Aggregate("n", "count"))
    return out.select("c_custkey", F.round("hi", 4).alias("hi"), "n")


# Traversal: a tree and a cyclic graph of all customers


def tree(spark: SparkSession, d: str) -> DataFrame:
    c = VIEWS["customer"](spark, d).where("c_custkey > 0")
    return c.select(F.col("c_custkey").alias("edge_id"), F.col("parent").alias("src"), F.col("c_custkey").alias("dst"), F.when(F.col("c_custkey") % 5 != 0, F.lit("BUILDING")).alias("tenant"))


def cyclic(spark: SparkSession, d: str) -> DataFrame:
    """Two edges from every customer, c to 2 c + 1 and c to c // 2: cycles of two edges everywhere, and a loop at 0."""
    c = F.col("c_custkey").cast("long")
    edges = F.array(*[F.struct((2 * c + i).alias("edge_id"), c.alias("src"), to.cast("long").alias("dst")) for i, to in enumerate((2 * c + 1, F.floor(c / 2)))])
    return spark.read.parquet(f"{d}/customer.parquet").select(F.inline(edges))


FREE = Resource("customer", CUSTOMER.attributes)
_TREE = "tree AS (SELECT c_custkey AS edge_id, c_custkey // 3 AS src, c_custkey AS dst, CASE WHEN c_custkey % 5 <> 0 THEN 'BUILDING' END AS tenant FROM customer WHERE c_custkey > 0)"
_CYCLIC = "tree AS (SELECT 2 * c_custkey AS edge_id, c_custkey AS src, 2 * c_custkey + 1 AS dst FROM customer UNION ALL SELECT 2 * c_custkey + 1, c_custkey, c_custkey // 2 FROM customer)"


def _walk(edges: str, sources: str, depth: int, least: int = 1, node: str = "TRUE") -> str:
    """Trails in SQL; node: a condition on the vertex v."""
    return f"""WITH RECURSIVE {edges}, walk AS (
      SELECT v AS source_id, v AS node, 0 AS depth, CAST([] AS BIGINT[]) AS seen FROM ({sources}) WHERE {node}
      UNION ALL SELECT source_id, v, depth + 1, list_append(seen, CAST(edge_id AS BIGINT)) FROM (SELECT walk.*, e.dst AS v, e.edge_id FROM walk JOIN e ON e.src = walk.node WHERE depth < {depth} AND NOT list_contains(seen, CAST(e.edge_id AS BIGINT))) WHERE {node})
      SELECT DISTINCT source_id, node AS node_id FROM walk WHERE depth >= {least}"""


def _reach(spark, d, t: Traversal, q: Query, dest: Query, edges: DataFrame) -> DataFrame:
    return traverse(q, t, edges, dest).select("source_id", F.col(dest.resource.pk[0]).alias("node_id"))


_SEGMENT = "v IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
_ALL = "SELECT c_custkey AS v FROM customer"
_ANY_CUSTOMER = "v IN (SELECT c_custkey FROM customer)"


@query(_walk(f"{_TREE}, e AS (SELECT * FROM tree)", _ALL, 3, node="v IN (SELECT c_custkey FROM customer)"))
def traverse_out_1_3(spark, d):
    q = on(FREE, spark, d)
    return _reach(spark, d, Traversal("PARENT_OF", 3), q, q, tree(spark, d))


@query(_walk(f"{_TREE}, e AS (SELECT edge_id, dst AS src, src AS dst FROM tree)", _ALL, 3, node="v IN (SELECT c_custkey FROM customer)"))
def traverse_in(spark, d):
    q = on(FREE, spark, d)
    return _reach(spark, d, Traversal("PARENT_OF", 3, "incoming"), q, q, tree(spark, d))


@query(_walk(f"{_CYCLIC}, e AS (SELECT * FROM tree UNION SELECT edge_id, dst, src FROM tree)", _ALL, 2, node=_ANY_CUSTOMER))
def traverse_both(spark, d):
    q = on(FREE, spark, d)
    return _reach(spark, d, Traversal("NEXT", 2, "both"), q, q, cyclic(spark, d))


@query(_walk(f"{_CYCLIC}, e AS (SELECT * FROM tree)", _ALL, 3, 2, _ANY_CUSTOMER))
def traverse_min2(spark, d):
    q = on(FREE, spark, d)
    return _reach(spark, d, Traversal("NEXT", 3, min_depth=2), q, q, cyclic(spark, d))


@query(_walk(f"{_CYCLIC}, e AS (SELECT * FROM tree)", _ALL, 3, node=_ANY_CUSTOMER))
def traverse_cycle_trail(spark, d):
    q = on(FREE, spark, d)
    return _reach(spark, d, Traversal("NEXT", 3), q, q, cyclic(spark, d))


@query(_walk(f"{_TREE}, e AS (SELECT * FROM tree)", _ALL, 3, node=_SEGMENT))
def traverse_node_scoped(spark, d):
    q = building(spark, d)
    return _reach(spark, d, Traversal("PARENT_OF", 3, scope_edges=False), q, q, tree(spark, d))


@query(_walk(f"{_TREE}, e AS (SELECT * FROM tree WHERE tenant = 'BUILDING')", _ALL, 3, node=_SEGMENT))
def traverse_edge_scoped(spark, d):
    q = building(spark, d)
    return _reach(spark, d, Traversal("PARENT_OF", 3), q, q, tree(spark, d))


@query(_walk(f"{_TREE}, e AS (SELECT * FROM tree)", _ALL, 2, node=_SEGMENT + " AND v NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"))
def traverse_hop_policy(spark, d):
    r = Resource("customer", CUSTOMER.attributes, "attribute", "c_mktsegment", policy=Policy(row=lambda actor: F.col("c_acctbal") >= actor))
    q = on(r, spark, d, "BUILDING", actor=0)
    return _reach(spark, d, Traversal("PARENT_OF", 2, scope_edges=False), q, q, tree(spark, d))


@query(f"SELECT source_id, node_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY c_acctbal DESC, c_custkey) AS rn FROM ({_walk(f'{_TREE}, e AS (SELECT * FROM tree)', _ALL, 3, node='v IN (SELECT c_custkey FROM customer)')}) JOIN customer ON c_custkey = node_id) WHERE rn BETWEEN 2 AND 3")
def traverse_top_n(spark, d):
    q = on(FREE, spark, d)
    return _reach(spark, d, Traversal("PARENT_OF", 3, limit=2, offset=1), q, q.sort(("c_acctbal", "desc")), tree(spark, d))


@query(f"SELECT c.c_custkey, count(node_id) AS n, round(coalesce(sum(x.c_acctbal), 0.0), 4) AS s FROM customer c LEFT JOIN ({_walk(f'{_TREE}, e AS (SELECT * FROM tree)', _ALL, 2, node='v IN (SELECT c_custkey FROM customer)')}) ON source_id = c.c_custkey LEFT JOIN customer x ON x.c_custkey = node_id GROUP BY c.c_custkey")
def traverse_agg(spark, d):
    q = on(FREE, spark, d)
    out = traversal_aggregates(q, Traversal("PARENT_OF", 2), tree(spark, d), q, Aggregate("n", "count"), Aggregate("s", "sum", "c_acctbal", default=0.0))
    return out.select("c_custkey", "n", F.round("s", 4).alias("s"))


def homes(spark: SparkSession, d: str) -> DataFrame:
    """Edges from customers to their nations, and from nations to their regions: keys of three labels that overlap, ids of text."""
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("edge_id"), F.lit("customer").alias("src_label"), F.col("c_custkey").cast("long").alias("src"), F.lit("nation").alias("dst_label"), F.col("c_nationkey").cast("long").alias("dst"))
    n = spark.read.parquet(f"{d}/nation.parquet").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("edge_id"), F.lit("nation").alias("src_label"), F.col("n_nationkey").cast("long").alias("src"), F.lit("region").alias("dst_label"), F.col("n_regionkey").cast("long").alias("dst"))
    return c.unionByName(n)


@query("SELECT c_custkey AS source_id, n_regionkey AS node_id FROM customer JOIN nation ON n_nationkey = c_nationkey")
def traverse_labels(spark, d):
    q, dest = on(FREE, spark, d), on(REGION, spark, d)
    return traverse(q, Traversal("IN", 2), homes(spark, d), dest, through=(on(NATION, spark, d),)).select("source_id", F.col("r_regionkey").cast("int").alias("node_id"))


@query("SELECT n_nationkey AS source_id, x.n_nationkey AS node_id FROM nation JOIN nation x USING (n_regionkey) WHERE nation.n_nationkey <> x.n_nationkey".replace("SELECT n_nationkey", "SELECT nation.n_nationkey"))
def traverse_labels_both(spark, d):
    """Nations of the same region, over the region: never back along the same edge."""
    q = on(NATION, spark, d)
    out = traverse(q, Traversal("IN", 2, "both"), homes(spark, d), q, through=(on(REGION, spark, d),))
    return out.select(F.col("source_id").cast("int").alias("source_id"), F.col("n_nationkey").cast("int").alias("node_id"))


@query("SELECT n_nationkey AS source_id, r_regionkey AS node_id FROM nation JOIN region ON r_regionkey = n_regionkey")
def traverse_labels_direct(spark, d):
    """Two labels, nothing between them."""
    q, dest = on(NATION, spark, d), on(REGION, spark, d)
    return traverse(q, Traversal("IN", 1), homes(spark, d), dest).select(F.col("source_id").cast("int").alias("source_id"), F.col("r_regionkey").cast("int").alias("node_id"))


# Vector search

_QV = [round(((i * 37) % 64 - 32) / 64, 6) for i in range(64)]
_QS = f"CAST({_QV} AS DOUBLE[])"
_E = "CAST(embedding AS DOUBLE[])"


def vector(name: str, r: Resource, expression: str, where: str = "TRUE", k: int = 10, e=None, **more) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        q = on(r, spark, d)
        return knn(q if e is None else q.filter(e), "embedding", _QV, k, **more).select("vec_id", F.round("distance", 6).alias("distance"))

    run.__name__ = name
    query(f"SELECT vec_id, round({expression}, 6) AS distance FROM embeddings WHERE {where} ORDER BY {expression}, vec_id LIMIT {k}")(run)


vector("knn_cosine", VECTOR, f"list_cosine_distance({_E}, {_QS})")
vector("knn_dot", DOT, f"-list_inner_product({_E}, {_QS})")
vector("knn_l2", L2, f"list_distance({_E}, {_QS})")
vector("knn_filtered", VECTOR, f"list_cosine_distance({_E}, {_QS})", "label = 3", e=ref("label") == 3)
vector("knn_max_distance", VECTOR, f"list_cosine_distance({_E}, {_QS})", f"list_cosine_distance({_E}, {_QS}) <= 0.95", k=1000, max_distance=0.95)
_T, _TW = [3, 17, 40, 63], [1.0, 0.5, 2.0, 0.25]
_HITS = " + ".join(f"CASE WHEN embedding[{t + 1}]::DOUBLE > 0.1 THEN embedding[{t + 1}]::DOUBLE * {w} ELSE 0 END" for t, w in zip(_T, _TW, strict=True))
_ANY = " OR ".join(f"embedding[{t + 1}]::DOUBLE > 0.1" for t in _T)


@query(f"SELECT vec_id, round({_HITS}, 6) AS score FROM embeddings WHERE {_ANY} ORDER BY {_HITS} DESC, vec_id LIMIT 10")
def sparse_topk(spark, d):
    return sparse(on(VECTOR, spark, d), "terms", _T, _TW, 10).select("vec_id", F.round("score", 6).alias("score"))


@query(f"SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS rn, max(s) OVER (PARTITION BY label) AS top FROM (SELECT vec_id, label, {_HITS} AS s FROM embeddings WHERE {_ANY})) WHERE rn <= 2 AND label IN (SELECT label FROM (SELECT label, max({_HITS}) AS m FROM embeddings WHERE {_ANY} GROUP BY label ORDER BY m DESC, label LIMIT 3))")
def sparse_grouped(spark, d):
    return sparse(on(VECTOR, spark, d), "terms", _T, _TW, 3, group_by="label", group_size=2).select("vec_id", F.col("label").cast("int").alias("label"))


_BM = """WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '([\\p{L}\\p{N}]+)', 1) AS w FROM documents WHERE lang = 'en'),
 f AS (SELECT doc_id, len(w)::DOUBLE AS n, len(list_filter(w, lambda x: x = 'nation'))::DOUBLE AS f0, len(list_filter(w, lambda x: x = 'stes'))::DOUBLE AS f1, len(list_filter(w, lambda x: x = 'thou'))::DOUBLE AS f2 FROM w),
 s AS (SELECT count(*)::DOUBLE AS docs, avg(n) AS a, sum((f0 > 0)::INT)::DOUBLE AS d0, sum((f1 > 0)::INT)::DOUBLE AS d1, sum((f2 > 0)::INT)::DOUBLE AS d2 FROM f),
 r AS (SELECT doc_id, """ + " + ".join(f"ln(1 + (docs - d{i} + 0.5::DOUBLE) / (d{i} + 0.5::DOUBLE)) * f{i} * 2.2::DOUBLE / (f{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / a))" for i in range(3)) + " AS score FROM f, s WHERE f0 > 0 OR f1 > 0 OR f2 > 0) "


def _bm25(spark, d):
    """Over all of a tenant's documents, however many: the ceiling of strict searches would refuse them."""
    return fulltext(on(DOCUMENT, spark, d, "en", strict=False), "text", "Nation stes THOU", 10)


@query(_BM + "SELECT doc_id, round(score, 6) AS score FROM r ORDER BY r.score DESC, doc_id LIMIT 10")
def fulltext_bm25(spark, d):
    return _bm25(spark, d).select("doc_id", F.round("score", 6).alias("score"))


_OWNED = Resource("embeddings", VECTOR.attributes, "attribute", "label", vector_indexes=VECTOR.vector_indexes, sparse_indexes=VECTOR.sparse_indexes, policy=Policy(row=lambda actor: F.col("vec_id") % 2 == actor, fields={"tokens": lambda actor: actor > 1}))
_OPEN = Resource("embeddings", VECTOR.attributes, "attribute", "label", sparse_indexes=VECTOR.sparse_indexes, policy=Policy(row=lambda actor: F.col("vec_id") % 2 == actor, fields={"embedding": lambda actor: actor > 1}))


@query(f"SELECT vec_id, round(list_cosine_distance({_E}, {_QS}), 6) AS distance, TRUE AS tokens_hidden, 64 AS n FROM embeddings WHERE label = 3 AND vec_id % 2 = 1 ORDER BY list_cosine_distance({_E}, {_QS}), vec_id LIMIT 10")
def knn_tenant_policy(spark, d):
    """Within a tenant, under row and field policy: the hidden field is null in the result as in any read."""
    out = knn(on(_OWNED, spark, d, 3, actor=1), "embedding", _QV, 10)
    return out.select("vec_id", F.round("distance", 6).alias("distance"), F.col("tokens").isNull().alias("tokens_hidden"), F.size("embedding").alias("n"))


@query(f"SELECT vec_id, round({_HITS}, 6) AS score, TRUE AS embedding_hidden FROM embeddings WHERE ({_ANY}) AND label = 3 AND vec_id % 2 = 0 ORDER BY {_HITS} DESC, vec_id LIMIT 10")
def sparse_tenant_policy(spark, d):
    return sparse(on(_OPEN, spark, d, 3, actor=0), "terms", _T, _TW, 10).select("vec_id", F.round("score", 6).alias("score"), F.col("embedding").isNull().alias("embedding_hidden"))


@query(_BM.replace("lang = 'en'", "lang = 'en' AND doc_id % 2 = 1") + "SELECT doc_id, round(score, 6) AS score, TRUE AS source_hidden FROM r ORDER BY r.score DESC, doc_id LIMIT 10")
def fulltext_policy(spark, d):
    r = Resource("documents", DOCUMENT.attributes, "attribute", "lang", policy=Policy(row=lambda actor: F.col("doc_id") % 2 == actor, fields={"source": lambda actor: False}))
    return fulltext(on(r, spark, d, "en", actor=1, strict=False), "text", "Nation stes THOU", 10).select("doc_id", F.round("score", 6).alias("score"), F.col("source").isNull().alias("source_hidden"))


_ARMS = f"WITH a AS (SELECT vec_id, -list_cosine_distance({_E}, {_QS}) AS s FROM embeddings ORDER BY s DESC, vec_id LIMIT 20), b AS (SELECT vec_id, {_HITS} AS s FROM embeddings WHERE {_ANY} ORDER BY s DESC, vec_id LIMIT 20)"
_FUSED = {
    "rrf": "1.0::DOUBLE / (60 + row_number() OVER (ORDER BY s DESC, vec_id))",
    "linear": "coalesce((s - min(s) OVER ()) / nullif(max(s) OVER () - min(s) OVER (), 0), 1.0)",
    "dbsf": "least(greatest(coalesce((s - (avg(s) OVER () - 3 * stddev_pop(s) OVER ())) / nullif(6 * stddev_pop(s) OVER (), 0), 0.5), 0.0), 1.0)",
}


def _hybrid(fusion: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        q = on(VECTOR, spark, d)
        arms = [Arm(knn(q, "embedding", _QV, 20)), Arm(sparse(q, "terms", _T, _TW, 20), 0.5)]
        return hybrid(q, arms, 20, fusion).select("vec_id", F.round("score", 6).alias("score"))

    run.__name__ = f"hybrid_{fusion}"
    x = _FUSED[fusion]
    query(f"{_ARMS}, u AS (SELECT vec_id, {x} AS p FROM a UNION ALL SELECT vec_id, 0.5::DOUBLE * ({x}) FROM b), t AS (SELECT vec_id, sum(p) AS total FROM u GROUP BY vec_id) SELECT vec_id, round(total, 6) AS score FROM t ORDER BY total DESC, vec_id LIMIT 20")(run)


for _f in _FUSED:
    _hybrid(_f)


# Writes: each returns the rows after it

_COLS = "c_custkey, c_name, c_nationkey, c_mktsegment"
WRITTEN = Resource("customer", tuple(a for a in CUSTOMER.attributes if a.name in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")), "attribute", "c_mktsegment")


def _old(spark, d):
    return decoded(spark.read.parquet(f"{d}/customer.parquet"), WRITTEN)


def _incoming(spark, d):
    """New balances for every fourth customer, and customers that aren't there yet."""
    c = _old(spark, d)
    return c.where("c_custkey % 4 = 0").withColumn("c_name", F.lit("seen")).unionByName(c.where("c_custkey % 4 = 1").withColumns({"c_custkey": F.col("c_custkey") + 10_000_000, "c_name": F.lit("new")}))


_IN = "(SELECT c_custkey, 'seen' AS c_name, c_nationkey, c_acctbal, 'BUILDING' AS c_mktsegment FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT c_custkey + 10000000, 'new', c_nationkey, c_acctbal, 'BUILDING' FROM customer WHERE c_custkey % 4 = 1)"
_HIT = "EXISTS (SELECT 1 FROM i WHERE i.c_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING')"


@query(f"SELECT {_COLS} FROM customer UNION ALL SELECT {_COLS} FROM {_IN} WHERE c_name = 'new'")
def write_bulk_create(spark, d):
    return W.bulk_create(WRITTEN, _old(spark, d), _incoming(spark, d).where("c_name = 'new'"), "BUILDING").select(*_COLS.split(", "))


@query(f"WITH i AS {_IN} SELECT c_custkey, CASE WHEN {_HIT} THEN 'seen' ELSE c_name END AS c_name, c_nationkey, c_mktsegment FROM customer c UNION ALL SELECT {_COLS} FROM i WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = i.c_custkey AND c.c_mktsegment = 'BUILDING')")
def write_upsert(spark, d):
    return W.upsert(WRITTEN, _old(spark, d), _incoming(spark, d), tenant="BUILDING", fields=["c_name"]).select(*_COLS.split(", "))


@query(f"WITH i AS {_IN} SELECT c_custkey, CASE WHEN {_HIT} AND c_acctbal > 0 THEN 'seen' ELSE c_name END AS c_name, c_nationkey, c_mktsegment FROM customer c UNION ALL SELECT {_COLS} FROM i WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = i.c_custkey AND c.c_mktsegment = 'BUILDING')")
def write_upsert_condition(spark, d):
    return W.upsert(WRITTEN, _old(spark, d), _incoming(spark, d), tenant="BUILDING", fields=["c_name"], where=ref("c_acctbal") > 0).select(*_COLS.split(", "))


_TWICE = "(SELECT c_custkey + 20000000 * (c_custkey % 2) AS k, c_custkey, c_acctbal FROM customer WHERE c_custkey % 5 = 0)"


def _twice(spark, d):
    """Each of these customers in three versions, half of them not there yet."""
    c = _old(spark, d).where("c_custkey % 5 = 0").withColumn("c_custkey", F.col("c_custkey") + 20_000_000 * (F.col("c_custkey") % 2))
    versions = F.explode(F.array(*[F.lit(i) for i in range(3)]))
    return c.withColumn("n", versions).withColumns({"c_name": F.concat(F.lit("v"), F.col("n").cast("string")), "c_nationkey": F.col("n").cast("long")})


@query(f"SELECT c_custkey, CASE WHEN {_B} AND c_custkey % 10 = 0 THEN 'v2' ELSE c_name END AS c_name, c_nationkey FROM customer UNION ALL SELECT k, 'v2', 0 FROM {_TWICE} WHERE k <> c_custkey UNION ALL SELECT k, 'v2', 0 FROM {_TWICE} JOIN customer USING (c_custkey) WHERE k = c_custkey AND c_mktsegment <> 'BUILDING'")
def write_upsert_repeated(spark, d):
    """Rows of one identity in turn: the first creates, with its own nation, and the later ones set the name alone."""
    out = W.upsert(WRITTEN, _old(spark, d), _twice(spark, d), tenant="BUILDING", fields=["c_name"], order="n")
    return out.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))


@query(f"SELECT c_custkey, CASE WHEN {_B} AND c_custkey % 10 = 0 THEN 'v1' ELSE c_name END AS c_name FROM customer UNION ALL SELECT k, 'v1' FROM {_TWICE} WHERE k <> c_custkey UNION ALL SELECT k, 'v1' FROM {_TWICE} JOIN customer USING (c_custkey) WHERE k = c_custkey AND c_mktsegment <> 'BUILDING'")
def write_upsert_condition_repeated(spark, d):
    """The condition looks at what the batch itself has made: after v1 no further version is taken."""
    return W.upsert(WRITTEN, _old(spark, d), _twice(spark, d), tenant="BUILDING", fields=["c_name"], where=~(ref("c_name") == "v1"), order="n").select("c_custkey", "c_name")


def _store(spark: SparkSession) -> Store:
    return Store(spark, f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}", buckets=8)


@query(SQL["write_upsert"])
def store_upsert(spark, d):
    """Committed to a store and read back; the second commit rewrites the touched buckets alone."""
    store, new = _store(spark), _incoming(spark, d)
    store.write(WRITTEN, None, lambda rows: rows.unionByName(_old(spark, d)))
    store.write(WRITTEN, None, lambda rows: W.upsert(WRITTEN, rows, new, tenant="BUILDING", fields=["c_name"]), keys=W.scoped_rows(WRITTEN, new, "BUILDING"))
    return store.scan(WRITTEN, None).select(*_COLS.split(", "))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3")
def store_destroy(spark, d):
    store = _store(spark)
    store.write(WRITTEN, None, lambda rows: rows.unionByName(_old(spark, d)))
    gone = _old(spark, d).where("c_custkey % 10 = 3")
    store.write(WRITTEN, None, lambda rows: W.destroy_query(rows, F.col("c_custkey") % 10 == 3)[0], keys=gone)
    return store.scan(WRITTEN, None).select("c_custkey")


@query(f"SELECT c_custkey, CASE WHEN {_B} AND c_nationkey > 10 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey, CASE WHEN {_B} AND c_nationkey > 10 THEN 'x' ELSE c_name END AS c_name FROM customer")
def write_update_query_atomic(spark, d):
    hit = W.scope(WRITTEN, "BUILDING") & (F.col("c_nationkey") > 10)
    return W.update_query(WRITTEN, _old(spark, d), hit, {"c_name": "x"}, {"c_nationkey": ref("c_nationkey") + 100}).select("c_custkey", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_name")


@query(f"SELECT c_custkey, CASE WHEN {_B} AND c_custkey % 3 = 0 THEN 'many' || c_custkey ELSE c_name END AS c_name FROM customer")
def write_update_many(spark, d):
    changes = _old(spark, d).where("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("many"), F.col("c_custkey").cast("string")).alias("c_name"))
    return W.update_many(WRITTEN, _old(spark, d), changes, tenant="BUILDING").select("c_custkey", "c_name")


@query(f"SELECT c_custkey FROM customer WHERE NOT ({_B} AND c_acctbal < 0)")
def write_destroy_query(spark, d):
    return W.destroy_query(_old(spark, d), W.scope(WRITTEN, "BUILDING") & (F.col("c_acctbal") < 0))[0].select("c_custkey")


def _edge_rows(spark, d):
    return VIEWS["customer"](spark, d).where("c_custkey > 0").select(F.lit("KNOWS").alias("label"), F.col("parent").alias("src"), F.col("c_custkey").alias("dst"), F.lit("t").alias("tenant"), F.col("c_nationkey").cast("long").alias("since"))


def _people(spark, d):
    return VIEWS["customer"](spark, d).select(F.col("c_custkey").alias("id"), F.lit("t").alias("tenant"))


@query("SELECT c_custkey // 3 AS src, c_custkey AS dst, CASE WHEN c_custkey % 2 = 0 THEN 1900 ELSE c_nationkey END AS since FROM customer WHERE c_custkey > 0")
def edge_merge(spark, d):
    new = _edge_rows(spark, d).where("dst % 2 = 0").withColumn("since", F.lit(1900).cast("long"))
    return W.create_edges(_edge_rows(spark, d), new, _people(spark, d), multiple=False).select("src", "dst", F.col("since").cast("int").alias("since"))


@query("SELECT c_custkey // 3 AS src, c_custkey AS dst FROM customer WHERE c_custkey > 0 UNION ALL SELECT c_custkey // 3, c_custkey FROM customer WHERE c_custkey > 0 AND c_custkey % 2 = 0")
def edge_parallel(spark, d):
    e = _edge_rows(spark, d)
    return W.create_edges(e, e.where("dst % 2 = 0"), _people(spark, d), multiple=True).select("src", "dst")


@query("SELECT c_custkey // 3 AS src, c_custkey AS dst FROM customer WHERE c_custkey > 0 AND c_custkey % 2 <> 0")
def edge_destroy(spark, d):
    e = _edge_rows(spark, d)
    gone = e.where("dst % 2 = 0").select("label", F.col("dst").alias("src"), F.col("src").alias("dst"), "tenant")
    return W.destroy_edges(e, gone, direction="both").select("src", "dst")


# Change streams: events fold into a mirror of users

MIRROR = Resource("mirror", (A("id", "integer", pk=True), A("org"), A("note")), "attribute", "org")
SPEC = cdc.MirrorSpec(MIRROR, "users", on_truncate="mirror")


def _changes(spark, d, truncate: str | None = None) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    record = F.create_map(F.lit("id"), F.col("user_id").cast("string"), F.lit("org"), F.lit("a"), F.lit("note"), F.col("event_id").cast("string"))
    op = F.when(F.col("event_id") % 7 == 3, "delete").otherwise("update")
    if truncate:
        op = F.when(F.expr(truncate), "truncate").otherwise(op)
    return e.select(F.col("event_id").alias("commit_lsn"), F.lit(0).cast("long").alias("seq"), op.alias("op"), F.lit("public").alias("schema"), F.lit("users").alias("table"), record.alias("record"), F.lit(None).cast("map<string,string>").alias("old_record"))


def _empty(spark):
    return spark.createDataFrame([], MIRROR.schema)


_LAST = "SELECT user_id AS id, CAST(max(event_id) AS VARCHAR) AS note FROM events WHERE {w} GROUP BY user_id HAVING max(event_id) FILTER (event_id % 7 = 3) IS NULL OR max(event_id) > max(event_id) FILTER (event_id % 7 = 3)"


@query(_LAST.format(w="TRUE"))
def cdc_apply(spark, d):
    return cdc.mirrored(_empty(spark), _changes(spark, d), SPEC).select("id", "note")


@query(_LAST.format(w="TRUE"))
def cdc_two_batches(spark, d):
    c = _changes(spark, d)
    first = cdc.mirrored(_empty(spark), c.where("commit_lsn < 5000"), SPEC)
    return cdc.mirrored(first, c.where("commit_lsn >= 5000"), SPEC).select("id", "note")


@query("SELECT * FROM (" + _LAST.format(w="event_id > (SELECT max(event_id) FROM events WHERE event_id % 1000 = 500) AND event_id % 1000 <> 500") + ")")
def cdc_truncate(spark, d):
    return cdc.mirrored(_empty(spark), _changes(spark, d, "event_id % 1000 = 500"), SPEC, truncated=True).select("id", "note")


@query("SELECT user_id + 1000000 AS id, CAST(arg_max(event_id, event_id) AS VARCHAR) AS note FROM events WHERE event_id % 2 = 1 GROUP BY user_id UNION ALL SELECT user_id, CAST(max(event_id) AS VARCHAR) FROM events WHERE event_id % 2 = 0 GROUP BY user_id HAVING max(event_id) > coalesce((SELECT max(x.event_id) FROM events x WHERE x.user_id = events.user_id AND x.event_id % 2 = 1), -1)")
def cdc_pk_move(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    moved = F.col("event_id") % 2 == 1
    to = F.when(moved, F.col("user_id") + 1_000_000).otherwise(F.col("user_id")).cast("string")
    record = lambda i: F.create_map(F.lit("id"), i, F.lit("org"), F.lit("a"), F.lit("note"), F.col("event_id").cast("string"))
    changes = e.select(F.col("event_id").alias("commit_lsn"), F.lit(0).cast("long").alias("seq"), F.lit("update").alias("op"), F.lit("public").alias("schema"), F.lit("users").alias("table"), record(to).alias("record"), F.when(moved, record(F.col("user_id").cast("string"))).alias("old_record"))
    return cdc.mirrored(_empty(spark), changes, SPEC).select("id", "note")


@query(_LAST.format(w="TRUE"))
def cdc_store(spark, d):
    """Through the store, in batches of which one comes twice and one overlaps what is there."""
    store, c = _store(spark), _changes(spark, d)
    for low, high in ((0, 3000), (0, 3000), (2000, 6000), (6000, 1 << 40)):
        cdc.apply(store, c.where(f"commit_lsn >= {low} AND commit_lsn < {high}"), [SPEC], "users")
    return store.scan(MIRROR, None).select("id", "note")


@query("SELECT user_id AS id, CAST(max(event_id) AS VARCHAR) AS note FROM events GROUP BY user_id")
def cdc_snapshot(spark, d):
    """The bootstrap from a table, and then what came after it."""
    store, e = _store(spark), spark.read.parquet(f"{d}/events.parquet")
    before = e.where("event_id < 5000").groupBy(F.col("user_id").alias("id")).agg(F.max("event_id").cast("string").alias("note")).withColumn("org", F.lit("a"))
    cdc.snapshot(store, {"users": before}, [SPEC], "users", 4999)
    cdc.apply(store, _changes(spark, d).withColumn("op", F.lit("update")), [SPEC], "users")
    return store.scan(MIRROR, None).select("id", "note")
