"""Mixing sources to target weights, in DataFrame operations only.

Every row gets a hash-random key; rows of a source are taken in the order of their keys until the
source's budget of tokens is used up. The keys are uniform, so equal ranges of keys hold equal
shares: a source is cut into as many ranges as its rows call for, and running totals are a window
within a range plus the totals of the ranges before it, which are summed the same way once more:
within a stretch of RANGES ranges, and over the totals of the stretches. So no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.words import WORD_PATTERN
from fieldspark.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST_EPOCHS, RANGE_ROWS, RANGES, SEED = 1.5, 2.0, 500, 1000, "mix"
BROADCAST_ROWS = 10_000


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD_PATTERN))).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """Targets of sources(source, source_size): weight by code-point order of the name, null last.

    Shares go by weight, capped at most_epochs times the source's size; what is over goes to the
    others by weight until none is above its cap. In closed form: with sources sorted by cap / weight,
    those up to some place are full and the rest share what is left. One row a source, so the windows
    over all rows see as many rows as there are sources.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place + 1).cast("int"))
    every = Window.partitionBy()
    t = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most_epochs)))
    t = t.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share))).withColumn("ratio", F.col("cap") / F.col("weight"))
    filled = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("full_caps", F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
    t = t.withColumn("rest_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0)))
    # level if all before this source are full; the source itself is full where that level reaches its ratio
    t = t.withColumn("level", (F.col("total") - F.col("full_caps")) / F.col("rest_weight"))
    t = t.withColumn("full", F.col("level") >= F.col("ratio"))
    t = t.withColumn("final", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
    target = F.when(F.col("full") | F.col("final").isNull(), F.col("cap")).otherwise(F.col("weight") * F.col("final"))
    return t.select("source", "source_size", target.alias("target"))


def mixing_plan(docs: DataFrame, keep: list[str] | None = None, seed: str = SEED, **targets) -> DataFrame:
    """docs(doc_id, text, source) -> kept columns, size, source_size, target, taken.

    taken is in words: whole epochs of the source, then the rows whose keys come first; the row at the
    budget's edge is taken in part, so a source's taken words are its target rounded down. Null text:
    size 0, taken 0. Null source: a source of its own, last in order. Equal rows: told apart by nothing,
    so either may be the one at the edge. Keys come of doc_id and text, so rows that share a doc_id (or have
    none) are spread over all ranges like any others; rows equal in both are in one range, ordered by a hash of
    all columns but those of maps. Empty table: no rows. A source without words gets target 0.
    """
    keep = keep or ["doc_id"]
    said = F.when(F.col("text").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.md5("text")))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), said))
    hashable = [c for c, kind in docs.dtypes if "map<" not in kind]  # maps have no hash
    rows = docs.select(*dict.fromkeys([*keep, "source"]), word_count(F.col("text")).alias("size"), key.alias("mix_key"), F.xxhash64(*hashable).alias("mix_tie"))
    rows = materialize(rows, "mix-keys")
    small = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    plan = source_targets(sizes.select("source", "source_size"), **targets)
    same = F.col("p.source").eqNullSafe(F.col("s.source"))
    plan = plan.alias("p").join(sizes.alias("s"), same).select("p.source", "p.source_size", "p.target", F.ceil(F.col("s.source_rows") / RANGE_ROWS).alias("ranges"))
    plan = materialize(plan, "mix-plan").withColumnRenamed("source", "plan_source")
    # the numbers of sources and ranges are checked before either goes to every executor
    n = plan.agg(F.count(F.lit(1)).alias("sources"), F.coalesce(F.sum("ranges"), F.lit(0)).alias("ranges")).first()
    plan = small(plan, n["sources"])
    rows = rows.join(plan, rows.source.eqNullSafe(plan.plan_source)).drop("plan_source")
    share = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows = rows.withColumn("mix_range", F.floor(share * F.col("ranges")))
    totals = rows.groupBy("source", "mix_range").agg(F.sum("size").alias("range_size")).withColumn("stretch", F.floor(F.col("mix_range") / RANGES))
    totals = materialize(totals, "mix-ranges")
    upto = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda column, *keys: F.coalesce(F.sum(column).over(upto(*keys)), F.lit(0))
    stretches = totals.groupBy(F.col("source").alias("stretch_source"), F.col("stretch").alias("stretch_no")).agg(F.sum("range_size").alias("stretch_size"))
    stretches = stretches.select("stretch_source", "stretch_no", sum_before("stretch_size", "stretch_source", "stretch_no").alias("stretch_before"))
    totals = totals.withColumn("in_stretch", sum_before("range_size", "source", "stretch", "mix_range"))
    totals = totals.join(stretches, totals.source.eqNullSafe(stretches.stretch_source) & (totals.stretch == stretches.stretch_no))
    totals = totals.select(F.col("source").alias("range_source"), F.col("mix_range").alias("range_no"), (F.col("stretch_before") + F.col("in_stretch")).alias("range_before"))
    totals = small(totals, n["ranges"])
    rows = rows.join(totals, rows.source.eqNullSafe(totals.range_source) & (rows.mix_range == totals.range_no)).drop("range_source", "range_no")
    within = Window.partitionBy("source", "mix_range").orderBy("mix_key", "size", "mix_tie").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("range_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.floor(F.try_divide(F.floor("target"), F.col("source_size")))
    left = F.floor("target") - epochs * F.col("source_size") - so_far
    taken = F.col("size") * epochs + F.least(F.greatest(left, F.lit(0)), F.col("size"))
    taken = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(taken).cast("long")
    return rows.withColumn("taken", taken).select(*keep, "size", "source_size", F.round("target", 6).alias("target"), "taken")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as whole epochs say, then the part at the budget's edge.

    Only the one document a source at its budget's edge is shortened, to the words that fit, and its n_chars,
    if there is such a column, is that of the shorter text. Columns are those of docs; names used inside
    cannot clash, as the documents travel in one struct.
    """
    names = docs.columns
    packed = docs.select("doc_id", "text", "source", F.struct(*names).alias("mix_row"))
    plan = mixing_plan(packed, keep=["doc_id", "mix_row"], **options)
    copies = F.floor(F.try_divide(F.col("taken"), F.col("size")))
    rest = F.col("taken") - F.coalesce(copies, F.lit(0)) * F.col("size")
    # words with the white space before each; joined again they give the text up to the last word taken
    pieces = F.split(F.col("mix_row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    first = F.array_join(F.slice(pieces, 1, F.greatest(rest, F.lit(1)).cast("int")), "")
    # rows of size 0 cost nothing: kept once
    whole = F.when(F.col("size") == 0, F.array_repeat(F.col("mix_row.text"), 1)).otherwise(F.array_repeat(F.col("mix_row.text"), copies.cast("int")))
    texts = F.concat(whole, F.when(rest > 0, F.array(first)).otherwise(F.array().cast("array<string>")))
    rows = plan.select("mix_row", F.explode(texts).alias("mix_text"))
    cut = ~F.col("mix_text").eqNullSafe(F.col("mix_row.text"))
    kinds = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("mix_text").alias(c)
        whole = F.col(f"mix_row.`{c}`")
        return (F.when(cut, F.length("mix_text").cast(kinds[c])).otherwise(whole) if c == "n_chars" else whole).alias(c)

    return rows.select(*[column(c) for c in names])
