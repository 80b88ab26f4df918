"""Exact vector ranking: dense, sparse, full text, and their fusion. Scope comes before the score, top k after it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantgraph import tenancy
from tenantgraph.errors import QueryFailed
from tenantgraph.plans.query import Query

MAX_CANDIDATES = 10_000
UNROLL = 256
RRF = 60
K1, B = 1.2, 0.75


def candidates(q: Query, allow_global: bool = False, max_candidates: int | None = None) -> DataFrame:
    """The rows that may be ranked. A ceiling refuses; it never truncates. Strict searches within a tenant have one of MAX_CANDIDATES
    unless another is given; without strict, only a given one holds."""
    r = q.resource
    if q.branches or q.limit_ is not None or q.offset_ or q.loads or q.distincts:
        raise QueryFailed("unsupported_vector_query")
    everyone = r.tenancy == "attribute" and q.tenant is None
    if everyone and allow_global is not True:
        raise QueryFailed("tenant_required")
    if r.tenancy and not everyone:
        tenancy.normalise(q.tenant)
    df = q.filtered(everyone)
    if isinstance(max_candidates, bool) or max_candidates is not None and (not isinstance(max_candidates, int) or max_candidates < 1):
        max_candidates = MAX_CANDIDATES  # a wrong setting must not open the ceiling
    if max_candidates is None and q.strict and r.tenancy and not everyone:
        max_candidates = MAX_CANDIDATES
    if max_candidates is not None and df.limit(max_candidates + 1).count() > max_candidates:
        raise QueryFailed("too_many_candidates")
    return df


def _visible(q: Query, *names: str) -> None:
    """Ranking and grouping tell of a field's values, so they need one that is stored, not sensitive, and not hidden."""
    for name in names:
        a = q.resource.by_name.get(name)
        if a is None or a.skip or a.sensitive:
            raise QueryFailed("field_not_stored", field=name)
        if name in q.hidden():
            raise QueryFailed("field_not_visible", field=name)


def _vector(values: Sequence[float], dimensions: int) -> list[float]:
    if len(values) != dimensions or any(isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(v) for v in values):
        raise QueryFailed("invalid_vector")
    return [float(v) for v in values]


def _sum(c: Column, q: Sequence[float], term: Any) -> Column:
    """Up to UNROLL dimensions the sum is spelled out, so that it is compiled; beyond that it is a fold."""
    if len(q) <= UNROLL:
        return reduce(lambda a, b: a + b, [term(F.get(c, F.lit(i)).cast("double"), F.lit(x)) for i, x in enumerate(q)])
    return F.aggregate(F.zip_with(c, F.lit(list(q)), lambda a, b: term(a.cast("double"), b)), F.lit(0.0), lambda a, b: a + b)


def distance(c: Column, q: Sequence[float], similarity: str) -> Column:
    dot = _sum(c, q, lambda a, b: a * b)
    if similarity == "dot_product":
        return -dot
    if similarity == "euclidean":
        return F.sqrt(_sum(c, q, lambda a, b: (a - b) * (a - b)))
    return F.lit(1.0) - F.try_divide(dot, F.sqrt(_sum(c, q, lambda a, b: a * a)) * F.lit(math.sqrt(sum(x * x for x in q))))


def _k(k: Any) -> int:
    if isinstance(k, bool) or not isinstance(k, int) or k < 1:
        raise QueryFailed("invalid_k")
    return k


def knn(q: Query, attribute: str, vector: Sequence[float], k: int, *, max_distance: float | None = None, ef_search: int | None = None, allow_global: bool = False, max_candidates: int | None = None) -> DataFrame:
    """The k nearest rows, closest first, with their distance. ef_search is taken for compatibility: the search is exact."""
    index = next((v for v in q.resource.vector_indexes if v.attribute == attribute), None)
    if index is None:
        raise QueryFailed("no_vector_index", field=attribute)
    _visible(q, attribute)
    d = distance(F.col(f"`{attribute}`"), _vector(vector, index.dimensions), index.similarity)
    df = candidates(q, allow_global, max_candidates).withColumn("distance", d).where(F.col("distance").isNotNull())
    if max_distance is not None:
        df = df.where(F.col("distance") <= max_distance)
    return q.masked(df.orderBy("distance", *q.resource.pk).limit(_k(k)), "distance")


def sparse(q: Query, name: str, tokens: Sequence[int], weights: Sequence[float], k: int, *, group_by: str | None = None, group_size: int = 1, allow_global: bool = False, max_candidates: int | None = None) -> DataFrame:
    """The k rows (or, with group_by, up to group_size rows of each of the k best groups) of the highest score."""
    index = next((s for s in q.resource.sparse_indexes if s.name == name), None)
    if index is None or len(tokens) != len(weights) or not tokens or len(set(tokens)) != len(tokens):
        raise QueryFailed("invalid_sparse_query")
    _visible(q, index.tokens, index.weights, *([group_by] if group_by is not None else []))
    asked = F.create_map(*[x for t, w in zip(tokens, weights, strict=True) for x in (F.lit(int(t)), F.lit(float(w)))])
    pairs = F.filter(F.arrays_zip(F.col(index.tokens).alias("t"), F.col(index.weights).alias("w")), lambda p: F.array_contains(F.lit([int(t) for t in tokens]), p["t"].cast("int")))
    score = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["w"].cast("double") * F.element_at(asked, p["t"].cast("int")))
    df = candidates(q, allow_global, max_candidates).withColumn("__tg_hits", F.size(pairs)).where("__tg_hits > 0").withColumn("score", score).drop("__tg_hits")
    best = [F.desc("score"), *q.resource.pk]
    if group_by is None:
        return q.masked(df.orderBy(*best).limit(_k(k)), "score")
    within = F.row_number().over(Window.partitionBy(group_by).orderBy(*best))
    df = df.withColumn("__tg_n", within).where(F.col("__tg_n") <= group_size).drop("__tg_n")
    leaders = df.groupBy(group_by).agg(F.max("score").alias("__tg_top")).orderBy(F.desc("__tg_top"), group_by).limit(_k(k))
    return q.masked(df.join(leaders.select(F.col(group_by).alias("__tg_g")), F.col(group_by).eqNullSafe(F.col("__tg_g")), "left_semi"), "score")


def fulltext(q: Query, attribute: str, text: str, k: int, *, allow_global: bool = False, max_candidates: int | None = None) -> DataFrame:
    """BM25 over lower-case runs of letters and digits, on the statistics of the rows in scope.

    Runs are counted, not cut out: all of them once, and those of a term only in texts that contain it.
    """
    terms = sorted({t for t in _words(text)})
    if not terms:
        raise QueryFailed("empty_text")
    _visible(q, attribute)
    low = F.lower(F.col(f"`{attribute}`"))
    df = candidates(q, allow_global, max_candidates).withColumn("__tg_n", F.regexp_count(low, F.lit(r"[\p{L}\p{N}]+")).cast("double"))
    for i, t in enumerate(terms):
        df = df.withColumn(f"__tg_f{i}", F.when(low.contains(t), F.regexp_count(low, F.lit(rf"(?<![\p{{L}}\p{{N}}]){t}(?![\p{{L}}\p{{N}}])"))).otherwise(F.when(low.isNotNull(), F.lit(0))).cast("double"))
    stats = df.agg(F.count(F.lit(1)).cast("double").alias("__tg_docs"), F.avg("__tg_n").alias("__tg_avg"), *[F.sum((F.col(f"__tg_f{i}") > 0).cast("double")).alias(f"__tg_d{i}") for i in range(len(terms))])
    df = df.where(reduce(lambda a, b: a | b, [F.col(f"__tg_f{i}") > 0 for i in range(len(terms))])).join(F.broadcast(stats))  # one row
    parts = []
    for i in range(len(terms)):
        f, d = F.col(f"__tg_f{i}"), F.col(f"__tg_d{i}")
        idf = F.ln(F.lit(1.0) + (F.col("__tg_docs") - d + 0.5) / (d + 0.5))
        parts.append(idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("__tg_n") / F.col("__tg_avg"))))
    df = df.withColumn("score", reduce(lambda a, b: a + b, parts))
    return q.masked(df.orderBy(F.desc("score"), *q.resource.pk).limit(_k(k)), "score")


def _words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+", text.lower())


@dataclass(frozen=True)
class Arm:
    """rows: a ranked result with `distance` (lower is better) or `score` (higher is better)."""

    rows: DataFrame
    weight: float = 1.0


def hybrid(q: Query, arms: Sequence[Arm], k: int, fusion: str = "rrf") -> DataFrame:
    """(key, score): arms of at most k rows each, fused by reciprocal ranks, by scaled scores, or by scores in units of spread."""
    if len(arms) < 2 or fusion not in ("rrf", "linear", "dbsf"):
        raise QueryFailed("invalid_hybrid_query")
    pk = q.resource.pk
    parts = []
    for arm in arms:
        better = -F.col("distance") if "distance" in arm.rows.columns else F.col("score")
        df = arm.rows.select(*pk, better.alias("__tg_s"))
        everything = Window.partitionBy(F.lit(0))  # an arm has k rows at most
        if fusion == "rrf":
            own = F.lit(1.0) / (RRF + F.row_number().over(everything.orderBy(F.desc("__tg_s"), *pk)))
        elif fusion == "linear":
            low, high = F.min("__tg_s").over(everything), F.max("__tg_s").over(everything)
            own = F.coalesce(F.try_divide(F.col("__tg_s") - low, high - low), F.lit(1.0))
        else:
            mean, spread = F.avg("__tg_s").over(everything), F.stddev_pop("__tg_s").over(everything)
            own = F.least(F.greatest(F.coalesce(F.try_divide(F.col("__tg_s") - (mean - 3 * spread), 6 * spread), F.lit(0.5)), F.lit(0.0)), F.lit(1.0))
        parts.append(df.select(*pk, (own * arm.weight).alias("__tg_part")))
    return reduce(DataFrame.unionByName, parts).groupBy(*pk).agg(F.sum("__tg_part").alias("score")).orderBy(F.desc("score"), *pk).limit(_k(k))
