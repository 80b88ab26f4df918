"""Quality rules from repetition inside a text, found with suffix arrays.

The symbols are words. One suffix array covers a whole slice of documents: the document's number is part of the
first rank, so suffixes of two documents never share a prefix. Prefix doubling gives ranks for prefixes of 1, 2, 4 ...
words and re-sorts only suffixes that are still tied. Walking those ranks from long to short gives the longest common
prefix of neighbours in the suffix array. The interval that holds a suffix is as deep as the larger of its two
neighbouring values, which is the longest repeat that starts there; where the repeat isn't the tail of the one that
starts a word earlier, it is a maximal repeated substring. The union of their spans is the covered part of the text.

Defined results: a null or empty text has no words and fails the base rules. Repeated rows are judged alike, each for
itself. An empty table gives none; other columns, whatever their names, are ignored unless `keep` names them. No row looks at
another, so there are no groups, no shuffles and no skew. Memory is bounded by a slice of about two megabytes of text, or by one
text if that is longer: some twenty numbers for each word, and one more for each doubling up to the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tenantgraph.llm.shared import named, slices

SYMBOLS = b"#*$%&|<>"
_NOT_IN_WORDS = bytes([*range(0x80, 0xC0), *b" \t\n\x0b\x0c\r"])  # with the continuation bytes gone, bytes are code points


def suffix_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position the length of the longest substring that starts there and also starts elsewhere in its document.

    ids: the symbols of all documents, one after another. doc: the document of each, ascending.
    """
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    end = np.searchsorted(doc, doc, side="right")
    first = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    order = np.argsort(first, kind="stable")
    tied, rank = order, np.zeros(n, np.int64)
    heads = np.r_[True, first[order][1:] != first[order][:-1]]
    rank[order] = np.maximum.accumulate(np.where(heads, at, 0))
    levels, width = [rank.astype(np.int32)], 1
    tied = tied[~(heads & np.r_[heads[1:], True])]
    while len(tied):
        after = tied + width
        pair = rank[tied] * (n + 1) + np.where(after < end[tied], rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(pair, kind="stable")
        tied, pair = tied[by], pair[by]
        group = rank[tied]
        spot = np.arange(len(tied))
        heads = np.r_[True, pair[1:] != pair[:-1]]
        starts = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], spot, 0))
        rank[tied] = group + np.maximum.accumulate(np.where(heads, spot, 0)) - starts
        levels.append(rank.astype(np.int32))
        width *= 2
        tied = tied[~(heads & np.r_[heads[1:], True])]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = at
    lcp = np.zeros(n + 1, np.int64)  # lcp[k]: of the suffixes at k - 1 and k
    left, right = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[near], right[near]
    depth = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = left + depth, right + depth
        inside = (i < end[left]) & (j < end[right])
        same = inside & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        depth += same.astype(np.int64) << k
    lcp[near + 1] = depth
    longest = np.empty(n, np.int64)
    longest[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in the union of the spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


def measure(texts: list[bytes | None], window: int, min_repeat: int) -> dict[str, np.ndarray]:
    k = len(texts)
    out = {c: np.zeros(k, np.int64) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")}
    words: list[bytes] = []
    for i, text in enumerate(texts):
        if not text:
            continue
        own = text.split()
        words += own
        out["n_words"][i] = len(own)
        out["word_chars"][i] = len(text.translate(None, _NOT_IN_WORDS))
        out["n_symbols"][i] = len(text) - len(text.translate(None, SYMBOLS))
        lines = [x for x in text.split(b"\n") if x.strip()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    if not words:
        return out
    number = dict(zip(distinct := dict.fromkeys(words), range(len(distinct)), strict=True))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    doc = np.repeat(np.arange(k), out["n_words"])
    longest = suffix_repeats(ids, doc)
    n = len(ids)
    starts = np.flatnonzero(longest >= window)
    out["n_repeat_words"] = np.bincount(doc, covered(starts, np.full(len(starts), window), n), k).astype(np.int64)
    tail = np.r_[False, (longest[1:] + 1 == longest[:-1]) & (doc[1:] == doc[:-1])]
    starts = np.flatnonzero((longest >= min_repeat) & ~tail)
    out["covered_words"] = np.bincount(doc, covered(starts, longest[starts], n), k).astype(np.int64)
    np.maximum.at(out["longest_repeat"], doc, longest)
    return out


def quality_rules(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), min_words: int = 10, window: int = 5,
    max_repeat_percent: int = 20, min_repeat: int = 10, max_covered_percent: int = 15, max_longest: int = 50,
) -> DataFrame:
    """One row per row of docs: the measures, base_failed and kept, and the columns named in keep.

    Base rules: at least min_words words, and at most max_repeat_percent of them in windows of `window` words that the
    text holds twice or more. The method's verdict: maximal repeated substrings of min_repeat words or more cover at
    most max_covered_percent of the words, and the longest has at most max_longest words.
    """
    read = docs.select(named(id_col).alias(id_col), named(text_col).cast("binary").alias("__tg_text"), *[named(c).alias(f"__tg_keep{i}") for i, c in enumerate(keep)])
    kinds = {f.name: f.dataType.simpleString() for f in read.schema}
    measures = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long, base_failed boolean, kept boolean"
    schema = ", ".join([f"`{id_col}` {kinds[id_col]}", *[f"`{c}` {kinds[f'__tg_keep{i}']}" for i, c in enumerate(keep)], measures])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 1):
            m = measure(texts, window, min_repeat)
            failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"])
            kept = ~failed & (100 * m["covered_words"] <= max_covered_percent * m["n_words"]) & (m["longest_repeat"] <= max_longest)
            arrays = [batch.column(0), *[batch.column(2 + i) for i in range(len(keep))], *map(pa.array, m.values()), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, *keep, *m, "base_failed", "kept"])

    return read.mapInArrow(run, schema)
