"""Substring dedup by hashing the lines of texts.

A line is a unit. With `inside` also the lines of that many words or more are cut, into pieces, so that a passage that two
texts hold in the middle of long lines (a paragraph on one line, say) is found at any offset: a piece begins where a key of two
neighbouring words falls in an eighth of its range, so equal passages are cut alike but for a few words at their ends. Units
are normalised (lower case, single spaces) and hashed to 128 bits. Digests are grouped over the whole corpus; the earliest
ranked occurrence stays, the others are repeats. Every repeated line goes, however short. Pieces of lines, which are short and
may agree by chance, go where a run of neighbouring repeats has `min_run` words in all. What goes are spans of the source text,
whose offsets are kept.

The rank is by id (nulls last), and inside a row by place. A row, not an id, is a document: rows are numbered when their units
are written, once, and all that follows works on that table. Rows that share an id rank among each other by those numbers.

The groups are a few numbers per digest (count, first row), summed where the rows are, so a line that a third of all texts
hold is one row of each task. Units then meet the repeated digests in a sort-merge join, where adaptive execution splits a hot
digest. A document's own repeats are the only group that is collected, and they are bounded by its text.

Defined results: null, empty and blank texts have no units and no spans. Of rows that repeat (or share an id) one keeps a unit
and the others lose it. A null id ranks last. Columns of any name pass through drop_repeats; if one is called as the column
that it adds, the added one gets an underscore more. Scripts without blanks count characters as words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantgraph.llm.shared import lowered, named, quoted, slices, stash

#: Blanks, and scripts written without them: each of their characters is a word.
BLANKS = "\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
JOINED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{JOINED}]|[^{BLANKS}{JOINED}]+")
_RANGES = [(ord(m[0]), ord(m[-1])) for m in re.findall(r"(.-.|.)", JOINED)]
_IS_BLANK = np.array([bool(re.match(f"[{BLANKS}]", chr(c))) for c in range(0x3002)])
#: The key of a word is the sum of its first code points times these, by place; that of a pair is _PAIR times the first one's and the second's, modulo _PRIME.
_WEIGHTS = (7, 131, 17, 211, 83, 401, 53, 307)
_PRIME, _PAIR, _CUT = 1009, 37, 126
_PART = 1 << 17  # characters looked at together: arrays that stay in a core's cache
SPANS = "array<struct<start:long,end:long,words:long>>"


def units_of(low: str, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(start, end, words, whether it is a line, digest) of each unit of a lower-case text."""
    cp = np.frombuffer((low + "\0" * len(_WEIGHTS)).encode("utf-32-le", "surrogatepass"), "<u4")
    size = len(low)
    blank = _IS_BLANK[np.minimum(cp, len(_IS_BLANK) - 1)]
    blank[size:] = True
    word = ~blank
    start, end = word.copy(), word.copy()
    start[1:] &= blank[:-1]
    end[:-1] &= blank[1:]
    if size and cp.max() >= _RANGES[0][0]:
        alone = np.zeros(len(cp), bool)
        for a, b in _RANGES:
            alone |= (cp >= a) & (cp <= b)
        start |= word & (alone | np.r_[False, alone[:-1]])
        end |= word & (alone | np.r_[start[1:], False])
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    n = len(starts)
    if not n:
        return starts, ends, starts, np.zeros(0, bool), []
    line = np.searchsorted(np.flatnonzero(cp == 10), starts)
    first = np.ones(n, bool)
    first[1:] = line[1:] != line[:-1]
    cut, is_line = first, np.ones(n, bool)
    if inside:
        held = np.diff(np.append(np.flatnonzero(first), n))
        is_line = np.repeat(held < inside, held)
        length = ends - starts
        key = sum(cp[starts + i].astype(np.int64) * weight * (length > i) for i, weight in enumerate(_WEIGHTS))
        after = np.append(key[1:], 0)
        after[np.append(first[1:], True)] = 0
        cut = first | ~is_line & ((_PAIR * key + after) % _PRIME < _CUT)
    at = np.flatnonzero(cut)
    words = np.diff(np.append(at, n))
    a, b = starts[at], ends[np.append(at[1:], n) - 1]
    odd = np.zeros(n, np.int64)  # gaps other than one space
    odd[1:] = np.cumsum((starts[1:] - ends[:-1] != 1) | (cp[ends[:-1]] != 32))
    plain = odd[np.append(at[1:], n) - 1] == odd[at]
    digest = xxhash.xxh3_128_digest
    texts = (low[i:j] if p else " ".join(_WORD.findall(low[i:j])) for i, j, p in zip(a.tolist(), b.tolist(), plain.tolist(), strict=True))
    return a, b, words, is_line[at], [digest(x.encode("utf-8", "surrogatepass")) for x in texts]


def parts(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], str]]:
    """Whole texts joined by line ends up to a size, and longer ones in parts cut at line ends: (number of the first text,
    [(where each begins, its offset in its own text)], the joined text)."""
    held: list[str] = []
    begins: list[tuple[int, int]] = []
    size, first = 0, 0
    for i, text in enumerate(texts):
        text = text or ""
        if size + len(text) > _PART and held:
            yield first, begins, "\n".join(held)
            held, begins, size, first = [], [], 0, i
        if len(text) > _PART:
            at = 0
            while at < len(text):
                stop = text.rfind("\n", at, at + _PART) + 1 if at + _PART < len(text) else len(text)
                if stop <= at:  # a line longer than a part
                    stop = text.find("\n", at + _PART) + 1 or len(text)
                yield i, [(0, at)], text[at:stop]
                at = stop
            first = i + 1
            continue
        begins.append((size, 0))
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, begins, "\n".join(held)


def batch_units(texts: list[str | None], inside: int) -> dict[str, np.ndarray]:
    """The units of a batch, one text after another, k counting in each; again: whether the text had the unit before."""
    out: list[tuple] = []
    digests: list[bytes] = []
    for first, begins, joined in parts(texts):
        a, b, words, line, own = units_of(lowered(joined), inside)
        begin, offset = np.array(begins, np.int64).T
        of = np.searchsorted(begin, a, side="right") - 1
        shift = offset[of] - begin[of]
        out.append((first + of, a + shift, b + shift, words, line))
        digests += own
    doc, start, end, words, line = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 5
    d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    k = np.arange(len(doc)) - np.searchsorted(doc, doc)
    by = np.lexsort((k, d[:, 1], d[:, 0], doc))
    again = np.zeros(len(doc), bool)
    again[by[1:]] = (doc[by[1:]] == doc[by[:-1]]) & (d[by[1:]] == d[by[:-1]]).all(axis=1)
    return {"doc": doc, "k": k, "start": start, "end": end, "words": words, "line": line.astype(bool), "again": again, "d1": d[:, 0], "d2": d[:, 1]}


def extract(rows: DataFrame, inside: int) -> DataFrame:
    """rows (row, id, text) to (row, id, k, start, end, words, line, again, d1, d2): a row for each unit, and before them one with
    k -1 and no digest for each text."""
    fields = [("k", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("line", pa.bool_()), ("again", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64())]
    kinds = {pa.int32(): T.IntegerType(), pa.bool_(): T.BooleanType(), pa.int64(): T.LongType()}
    schema = quoted([rows.schema["row"], rows.schema["id"], *[T.StructField(n, kinds[t]) for n, t in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 2):
            none = np.full(len(texts), -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(none, t) if n == "k" else pa.nulls(len(texts), t) for n, t in fields]], ["row", "id", *[n for n, _ in fields]])
            units = batch_units(texts, inside)
            of = pa.array(units["doc"])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), *[pa.array(units[n], t) for n, t in fields]], ["row", "id", *[n for n, _ in fields]])

    return rows.mapInArrow(run, schema)


def spans_of(repeats: list[dict], min_run: int) -> list[dict]:
    """The spans to remove, from a text's repeats sorted by k."""
    runs: list[list[dict]] = []
    for u in repeats:
        if runs and runs[-1][-1]["k"] == u["k"] - 1:
            runs[-1].append(u)
        else:
            runs.append([u])
    out: list[dict] = []
    for run in runs:
        enough = sum(u["words"] for u in run) >= min_run
        last = None
        for u in run:
            if enough or u["line"]:
                if last == u["k"] - 1:
                    out[-1].update(end=u["end"], words=out[-1]["words"] + u["words"])
                else:
                    out.append({"start": u["start"], "end": u["end"], "words": u["words"]})
                last = u["k"]
    return out


def row_spans(rows: DataFrame, inside: int, min_run: int) -> DataFrame:
    """rows (row, id, text) to (row, id, spans), one row for each."""
    units = stash(extract(rows, inside), "repeats-units")
    told = units.where("k >= 0")
    firsts = told.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min_by("row", "id"), F.min("row")).alias("first")).where("n > 1").drop("n")
    firsts = stash(firsts, "repeats-digests")
    repeats = told.select("row", "k", "start", "end", "words", "line", "again", "d1", "d2").join(firsts.hint("merge"), ["d1", "d2"]).where("again or row <> first")
    own = F.struct("k", "start", "end", "words", "line")
    listed = units.where("k < 0").select("row", "id", F.lit(None).alias("u")).unionByName(repeats.select("row", F.lit(None).alias("id"), own.alias("u")))
    listed = listed.groupBy("row").agg(F.first("id", ignorenulls=True).alias("id"), F.sort_array(F.collect_list("u")).alias("u"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [spans_of(u, min_run) for u in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], ["row", "id", "spans"])

    return listed.mapInArrow(run, f"{quoted([listed.schema['row'], listed.schema['id']])}, spans {SPANS}")


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", inside: int = 0, min_run: int = 20) -> DataFrame:
    """(id, spans), one row for each row of docs: what goes, as (start, end, words) in order, offsets in code points.

    inside: cut lines of that many words or more, 0 for none. min_run: the words of a run of repeats of which pieces of lines go.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), named(id_col).alias("id"), named(text_col).alias("text"))
    return row_spans(rows, inside, min_run).select(F.col("id").alias(id_col), "spans")


def drop_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", inside: int = 0, min_run: int = 20, out: str = "removed_spans") -> DataFrame:
    """docs with the spans cut from their texts, and a column `out` that keeps their offsets in the original."""
    while out in docs.columns:
        out += "_"
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = stash(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "repeats-rows")
    text = names[docs.columns.index(text_col)]
    spans = row_spans(rows.select("row", F.col(names[docs.columns.index(id_col)]).alias("id"), F.col(text).alias("text")), inside, min_run).select("row", "spans")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.array_join(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: F.substring(F.col(text), (s["a"] + 1).cast("int"), (s["b"] - s["a"]).cast("int"))), "")
    new = F.when(F.size("spans") == 0, F.col(text)).otherwise(kept)
    return rows.join(spans, "row").select(*[(new if n == text else F.col(n)).alias(c) for n, c in zip(names, docs.columns, strict=True)], F.col("spans").alias(out))
