"""SimHash near-dedup over a byte-position inverted index with count filtering.

Fingerprints that differ in at most 3 of 64 bits differ in at most 3 of 8 bytes, so they share at least 5 positional
bytes. A posting of one byte would hold a 256th of all fingerprints and pairs from it would grow with the square of
the corpus; postings are therefore cut to three positional bytes each. Of any 5 positions out of 8, at least three lie
in one half (0-3 or 4-7), so the 8 triples inside the halves meet every pair that shares 5 bytes. In a posting,
shared positional bytes are tallied for each pair, pairs under the guaranteed 5 are dropped, the rest are verified by
the differing bits. A posting hands on the edges of a spanning forest, never its pairs.

Equal fingerprints are one node from the start, whatever their number. A posting of more than `posting_limit` different
fingerprints (near copies by the thousand) is cut further: its members are dealt by the 560 ways to leave out 3 of 16
nibbles. A pair within 3 bits agrees on 13 nibbles, and different fingerprints that agree on 52 bits number 4096 at most,
so no task ever holds more; nothing is capped.

That pairs are met by triples of bytes and not by tallies of single ones is a deviation from the plain index, for the sizes of
its postings; the tally then confirms what a triple has met.

Components: alternating large-star and small-star rounds, each written to the shared folder in place of the one before.

Defined results: a text with no words (null, empty, blank) has fingerprint zero and links like any other; one with fewer
words than a shingle is hashed whole. Repeated rows share a fingerprint, so they share a component. A null id never
becomes a component's name unless the component has no other. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantgraph.llm.shared import mark, named, release, slices, stash

TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
NIBBLES = list(combinations(range(16), 3))
_ROWS = 1 << 17


def shingle_hashes(text: bytes | None, width: int = 3, seed: int = 42) -> list[int]:
    words = text.lower().split() if text else []  # bytes.lower() changes A-Z alone
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[: len(words) - width]].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]


def fingerprints(texts: list[bytes | None], width: int = 3) -> np.ndarray:
    """A 64-bit fingerprint for each text, as signed longs."""
    out = np.zeros(len(texts), np.uint64)
    held: list[int] = []
    docs: list[tuple[int, int]] = []
    power = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))

    def bits(hashes: list[int]) -> np.ndarray:
        return np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")

    def flush() -> None:
        if docs:
            sizes = np.array([n for _, n in docs])
            sums = np.add.reduceat(bits(held), np.r_[0, np.cumsum(sizes)[:-1]], axis=0, dtype=np.int32)
            out[[i for i, _ in docs]] = ((2 * sums > sizes[:, None]) * power).sum(axis=1, dtype=np.uint64)
            held.clear()
            docs.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, width)
        if len(hashes) > _ROWS:  # one very long text: add up its parts
            total = sum(bits(hashes[a : a + _ROWS]).sum(axis=0, dtype=np.int64) for a in range(0, len(hashes), _ROWS))
            out[i] = ((2 * total > len(hashes)) * power).sum(dtype=np.uint64)
        elif hashes:
            docs.append((i, len(hashes)))
            held += hashes
        if len(held) >= _ROWS:
            flush()
    flush()
    return out.view(np.int64)


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    read = docs.select(named(id_col).alias("id"), named(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 1, 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(texts, width))], ["id", "fp"])

    return read.mapInArrow(run, f"id {read.schema['id'].dataType.simpleString()}, fp long")


def forest(members: np.ndarray, max_bits: int = 3) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph that links different fingerprints within max_bits.

    Each member is held once against those not yet reached: tally shared positional bytes, keep pairs with at least
    8 - max_bits, verify by bits.
    """
    fps = np.unique(members.view(np.uint64))
    edges = []
    left = fps
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            differing = left ^ queue.pop()
            shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            linked = shared >= 8 - max_bits
            linked[linked] = np.bitwise_count(differing[linked]) <= max_bits
            if linked.any():
                reached = left[linked]
                left = left[~linked]
                queue += list(reached)
                edges += [(x, int(root.view(np.int64))) for x in reached.view(np.int64).tolist()]
    return edges


def posting_edges(postings: DataFrame) -> DataFrame:
    """postings (key, fp), dealt and sorted by key, to the edges of each posting's forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def edges(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            found = [e for a, b in zip(cut[:-1], cut[1:], strict=True) if b - a > 1 for e in forest(fp[a:b])]
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in found], pa.int64()), pa.array([e[1] for e in found], pa.int64())], ["u", "v"])

        for batch in batches:
            key, fp = (np.concatenate([a, batch.column(i).to_numpy()]) for i, a in enumerate((rest_key, rest_fp)))
            if len(key):
                whole = np.searchsorted(key, key[-1])  # the last posting may go on in the next batch
                rest_key, rest_fp = key[whole:], fp[whole:]
                if whole:
                    yield edges(key[:whole], fp[:whole])
        if len(rest_key):
            yield edges(rest_key, rest_fp)

    return postings.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def _key(fp: Column, n: int, mask: int) -> Column:
    return F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)))


def candidate_edges(distinct: DataFrame, posting_limit: int) -> DataFrame:
    """distinct (fp), different fingerprints. Keys are hashed; two postings that fall together only add checks."""
    fp = F.col("fp")
    keys = F.array(*[_key(fp, n, sum(0xFF << 8 * p for p in t)) for n, t in enumerate(TRIPLES)])
    postings = distinct.select("fp", F.explode(keys).alias("key")).select("key", "fp")
    large = stash(postings.groupBy("key").count().where(F.col("count") > posting_limit).select("key"), "simhash-large")
    if large.isEmpty():
        return posting_edges(postings)
    full = (1 << 64) - 1
    finer = F.array(*[_key(fp, n, full ^ sum(0xF << 4 * p for p in t)) for n, t in enumerate(NIBBLES)])
    hot = postings.join(large, "key", "left_semi").select("fp").distinct()
    return posting_edges(postings.join(large, "key", "left_anti")).unionByName(posting_edges(hot.select(F.explode(finer).alias("key"), "fp")))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): each node that has an edge, and the smallest node it reaches."""

    def sums(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    spark = edges.sparkSession
    begin = mark(spark)
    edges = stash(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "simhash-edges")
    before = sums(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stash(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "simhash-edges")
        release(spark, begin, but=1)  # of the rounds only the last is read again
        if (now := sums(edges)) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"no fixed point in {max_rounds} rounds")


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, posting_limit: int = 8192) -> DataFrame:
    """(id_col, fp long, component_id): the smallest id that links of at most 3 differing bits reach."""
    marked = stash(with_fingerprints(docs, id_col, text_col, width), "simhash-fp")
    nodes = stash(marked.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-nodes")
    roots = components(candidate_edges(nodes.select("fp"), posting_limit))
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents whose component has a smaller id. Rows that share an id stay or go together; rows without one stay.
    Columns of any name pass through."""
    found = simhash_components(docs.select(named(id_col).alias("id"), named(text_col).alias("text")), id_col="id", text_col="text")
    gone = stash(found.where("id <> component_id").select(F.col("id").alias("__tg_gone")).distinct(), "simhash-gone")
    return docs.join(gone, named(id_col) == F.col("__tg_gone"), "left_anti")
