"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

A source's target is its weight's share of all words, at most `cap` times its own words; what lies above is shared out
again by weight until none is above (water filling, in closed form over the sources sorted by cap / weight). A target
is met by complete epochs of the source first; what remains is a fraction of one more epoch. For that fraction each
document gets the exponential key -ln(u) / quality, u a uniform number made from its id, its text and, among rows that have
both in common, its number; documents are sorted by key within the source, and a prefix is taken whose words come nearest to
the fraction. quality is a column of weights (null or not above zero counts as 1e-9), or by default one made from the text.

The prefix ends at a cut key, and finding the cut needs no sort of a whole source: keys fall into `buckets` bands of an
increasing function, bands are summed where the rows are, the sums are accumulated over the bands of a source, and only
the one band in which the fraction runs out is sorted. A source with a third of all rows so costs a task one band of it.
A document's copies then follow from its own key and one row per source. Rows that repeat are numbered by salted parts, so a
third of all rows may be equal; no two rows share a key but by chance.

Defined results: a null text has no words and takes none. A null source is a source, the last in order. Rows that share
an id, or have none, are documents each for itself. A source without words has target zero. An empty table gives none.
Columns of any name pass through `mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantgraph.llm.shared import checked, n_words, named, stash

SYMBOLS = "[#*$%&|<>]"


def uniform(id_: Column, digest: Column, nth: Column) -> Column:
    """A number in (0, 1) made from the id, the text's digest and the number among equal rows: 52 bits of an MD5."""
    either = [F.coalesce(c.cast("string"), F.lit("null")) for c in (id_, digest, nth)]
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *either)), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def text_quality(text: Column, size: Column) -> Column:
    """A document's quality weight: 1, less the more of its characters are markup or filler symbols."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * symbols / F.greatest(size, F.lit(1)).cast("double"))


def weight_of(text: Column, quality: Column | None) -> Column:
    return text_quality(text, n_words(text)) if quality is None else F.greatest(F.coalesce(quality.cast("double"), F.lit(0.0)), F.lit(1e-9))


def sized(docs: DataFrame, id_: Column, source: Column, text: Column, quality: Column | None, row: Column | None = None) -> DataFrame:
    """(row, id, source, size, weight, digest) of each row; row: its number, which holds once this is written."""
    row = F.monotonically_increasing_id() if row is None else row
    return docs.select(row.alias("row"), id_.alias("id"), source.alias("source"), n_words(text).alias("size"), weight_of(text, quality).alias("weight"), F.md5(text).alias("digest"))


def numbers(rows: DataFrame, rows_each: int = 100_000, salts: int = 64) -> DataFrame | None:
    """(row, nth) of the rows whose id and text others have as well, counted from 0 in any order; none if there are none."""
    same = ["id", "digest"]
    repeated = stash(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "mixing-repeated")
    total = repeated.agg(F.sum("n")).first()[0]
    if not total:
        return None
    asked = repeated.select(*[F.col(c).alias(f"of_{c}") for c in same])
    match = F.lit(True)
    for c in same:
        match = match & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    own = rows.join(asked, match, "left_semi").select("row", *same, F.pmod(F.xxhash64("row"), F.lit(max(salts, -(-total // rows_each)))).alias("salt"))
    counts = own.groupBy(*same, "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(*same).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.select(*[F.col(c).alias(f"of_{c}") for c in same], F.col("salt").alias("of_salt"), "before")
    nth = F.row_number().over(Window.partitionBy(*same, "salt").orderBy("row")) - 1
    numbered = own.withColumn("nth", nth).join(counts, match & (F.col("salt") == F.col("of_salt")))
    return stash(numbered.select("row", (F.col("nth") + F.col("before")).cast("long").alias("nth")), "mixing-numbers")


def key_of(id_: Column, digest: Column, nth: Column, weight: Column) -> Column:
    return -F.ln(uniform(id_, digest, nth)) / weight


def with_numbers(rows: DataFrame, nth: DataFrame | None) -> DataFrame:
    if nth is None:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    return rows.join(checked(nth), "row", "left").withColumn("nth", F.coalesce("nth", F.lit(0)))


def keyed(rows: DataFrame, nth: DataFrame | None) -> DataFrame:
    """(id, source, size, key) of the rows of sized()."""
    return with_numbers(rows, nth).select("id", "source", "size", key_of(F.col("id"), F.col("digest"), F.col("nth"), F.col("weight")).alias("key"))


def band(key: Column, buckets: int) -> Column:
    return F.least(F.floor((F.lit(1.0) - F.exp(-key)) * buckets), F.lit(buckets - 1)).cast("int")


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """sizes (source, source_size) to (source, source_size, target). One row per source; sources are few next to documents."""
    everything = Window.partitionBy(F.lit(0))
    ordered = everything.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1))
    w = w.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    filling = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumns({
        "total": F.sum("source_size").over(everything).cast("double"), "weights": F.sum("weight").over(everything),
        "most_before": F.coalesce(F.sum("most").over(before), F.lit(0.0)), "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    w = w.withColumn("full", F.col("most") * (F.col("weights") - F.col("weight_before")) <= F.col("weight") * (F.col("total") - F.col("most_before")))
    rest = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(everything)
    level = F.try_divide(F.col("total") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything), rest)
    return w.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * level)).select("source", "source_size", "target")


def plan(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, buckets: int = 4096) -> DataFrame:
    """rows (source, size, key), read a few times, to one row per source: source_size, target, epochs, cut.

    A document is in the fraction where its key is at most cut.
    """
    rows = rows.withColumn("band", band(F.col("key"), buckets))
    bands = stash(rows.groupBy("source", "band").agg(F.sum("size").alias("words")), "mixing-bands")
    of_source = targets(bands.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0)).cast("long")
    of_source = stash(of_source.withColumn("epochs", epochs).withColumn("part", F.col("target") - F.col("epochs") * F.col("source_size")), "mixing-sources")
    running = Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    ends = bands.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    named = of_source.select(F.col("source").alias("of"), "part")
    ends = ends.join(named, ends.source.eqNullSafe(named.of)).where("before <= part and part < before + words")
    ends = ends.select(F.col("of"), F.col("band").alias("end_band"), "before", "part")
    inside = rows.join(ends, rows.source.eqNullSafe(ends.of) & (rows.band == ends.end_band))
    up_to = Window.partitionBy("of").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("prefix", F.col("before") + F.coalesce(F.sum("size").over(up_to), F.lit(0)))
    cuts = inside.where(F.col("prefix") + F.col("size") / 2 <= F.col("part")).groupBy("of").agg(F.max("key").alias("key_cut"))
    # With no key taken in the last band, the cut lies where that band begins.
    cuts = ends.select("of", "end_band").join(cuts.withColumnRenamed("of", "of2"), F.col("of").eqNullSafe(F.col("of2")), "left").select("of", "end_band", "key_cut")
    return of_source.join(cuts, of_source.source.eqNullSafe(cuts.of), "left").select("source", "source_size", "target", "epochs", "part", "end_band", "key_cut")


def copies(key: Column, of: str = "", buckets: int = 4096) -> Column:
    """How often the mix takes a row with that key; of: the prefix of its source's columns."""
    own, end = band(key, buckets), F.col(f"{of}end_band")
    taken = (F.col(f"{of}part") > 0) & ((own < end) | ((own == end) & (key <= F.col(f"{of}key_cut"))))
    return F.col(f"{of}epochs") + F.coalesce(taken, F.lit(False)).cast("long")


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", quality: Column | None = None, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0
) -> DataFrame:
    """(id, size, source_size, target, taken), one row per row of docs."""
    rows = stash(sized(docs, named(id_col), named(source_col), named(text_col), quality), "mixing-rows")
    rows = stash(keyed(rows, numbers(rows)), "mixing-keys")
    sources = checked(stash(plan(rows.select("source", "size", "key"), weights, cap).withColumnRenamed("source", "of"), "mixing-plan"))
    joined = rows.join(sources, rows.source.eqNullSafe(sources.of))
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * copies(F.col("key"))).alias("taken"))


def mixed(
    docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", quality: Column | None = None, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0
) -> DataFrame:
    """docs as the mix takes them: each row as often as it is taken. Texts are shuffled only where the sources' rows are too many
    to broadcast, or where rows repeat, which then go by the numbers they got when they were written."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = (docs if quality is None else docs.withColumn("__tg_quality", quality)).toDF(*names, *([] if quality is None else ["quality"]))
    id_, source, text = (F.col(names[docs.columns.index(c)]) for c in (id_col, source_col, text_col))
    quality = None if quality is None else F.col("quality")
    rows = stash(sized(own, id_, source, text, quality), "mixing-rows")
    nth = numbers(rows)
    if nth is not None:  # numbers belong to rows that are written
        own = stash(own.withColumn("row", F.monotonically_increasing_id()), "mixing-docs")
        rows = stash(sized(own, id_, source, text, quality, F.col("row")), "mixing-rows")
        nth = numbers(rows)
    sources = stash(plan(stash(keyed(rows, nth), "mixing-keys").drop("id"), weights, cap).select(F.struct("source", "epochs", "part", "end_band", "key_cut").alias("plan")), "mixing-plan")
    own = with_numbers(own, nth).withColumn("key", key_of(id_, F.md5(text), F.col("nth"), weight_of(text, quality)))
    joined = own.join(checked(sources), source.eqNullSafe(F.col("plan.source")))
    times = copies(F.col("key"), "plan.")
    return joined.withColumn("copy", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select(*names).toDF(*docs.columns)
