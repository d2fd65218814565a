r"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

A source's target is its share of `total` times the corpus' words, at most
`most` times its own words; what that cuts off is shared again by weight among
the others. With m = target / words, every document of the source is taken
floor(m) times for certain. The fractional rest is a fixed-size sample of
unequal probability: documents are ranked by random odds u / (1 - u) divided
by inclusion odds f / (1 - f) * sqrt(words / mean words), and are taken in that
order while the middle of the document lies inside the words still wanted.
So a source misses its target by half a document at most.

A source's documents are spread over many tasks: the order (source, rank value)
is range-partitioned and running words come from prefix sums, so no source is
ever held by one task.

Defined results: rows that share source and id are one document, drawn
together; a null text has 0 words; documents without words are never taken;
null source is the last source; null ids are ordinary, equal ids; `u` comes
from an MD5 of id and seed, so reruns agree; extra columns are ignored, and
passed through by `mixed` under any name that does not start with `__mix_`; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordered_totals
from ..sources.scratch import materialize

#: Sources in code point order weigh these, repeating.
WEIGHTS = (5, 2, 1)
TOTAL, MOST, SEED = 1.5, 2, "mix"


def n_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of the key's MD5; the same in any run."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":" + seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """(source, n, source_size, base, target) for each source of `sizes`
    (source, n, source_size); base is the words of all sources before it.

    The sharing ends with target = min(most * size, level * weight). Sources in
    the order of size / weight reach their cap first, so the level follows from
    the running sums in that order.
    """
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = ordered_totals(sizes, [F.col("source").asc_nulls_last()], "place", {"base": "source_size"})
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("fill", F.col("source_size") * most / F.col("weight"))
    filled = materialize(ordered_totals(ranked, [F.col("fill"), F.col("place")], "order", {"full": "source_size", "heavy": "weight"}), "targets")
    words, weight = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = (F.lit(words * total) - F.col("full") * most) / (F.lit(weight) - F.col("heavy"))
    first = filled.select("order", level.alias("level"), "fill").where("fill >= level").agg(F.min_by("level", "order")).first()[0]
    target = F.least(F.col("source_size") * most, F.lit(first if first is not None else 0.0) * F.col("weight")).cast("double")
    if first is None:  # every source is at its cap
        target = (F.col("source_size") * most).cast("double")
    return filled.select("source", "n", "source_size", "base", target.alias("target"))


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights=WEIGHTS, total=TOTAL, most=MOST, seed=SEED
) -> DataFrame:
    """One row per row of `docs`: id, source, size, source_size, target and
    copies (times that the mix takes the document)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    rows = materialize(rows, "sizes")
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    sources = materialize(source_targets(sources, weights, total, most), "sources")
    units = rows.groupBy("source", "id").agg(F.sum("size").alias("words")).join(_keyed(sources), F.col("source").eqNullSafe(F.col("s_source")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    certain = F.floor(share)
    rest = share - certain
    u = uniform(F.col("id"), seed)
    odds = rest / (1 - rest) * F.sqrt(F.col("words") * F.col("n") / F.col("source_size"))
    value = F.when((rest > 0) & (F.col("words") > 0), u / (1 - u) / odds).otherwise(F.lit(float("inf")))
    units = units.select("source", "id", "words", "source_size", "target", "base", certain.alias("certain"), value.alias("value"))
    order = [F.col("source").asc_nulls_last(), F.col("value"), F.col("id")]
    drawn = ordered_totals(units, order, "order", {"before": "words"})
    wanted = F.col("target") - F.col("certain") * F.col("source_size")
    extra = (F.col("words") > 0) & (F.col("before") - F.col("base") + F.col("words") / 2 <= wanted) & (F.col("certain") < most)
    copies = F.when(F.col("words") > 0, F.col("certain") + extra.cast("long")).otherwise(0).cast("long")
    drawn = drawn.select(F.col("source").alias("d_source"), F.col("id").alias("d_id"), "source_size", "target", copies.alias("copies"))
    same = F.col("id").eqNullSafe(F.col("d_id")) & F.col("source").eqNullSafe(F.col("d_source"))
    return rows.join(drawn, same).select("id", "source", "size", "source_size", "target", "copies")


def _keyed(sources: DataFrame) -> DataFrame:
    return sources.withColumnRenamed("source", "s_source")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """`docs` as the mix has them: each row as many times as it is taken."""
    drawn = mixture(docs, id_col, text_col, source_col, **options).where("copies > 0")
    drawn = drawn.groupBy(F.col("id").alias("__mix_id"), F.col("source").alias("__mix_source")).agg(F.max("copies").alias("__mix_copies"))
    same = F.col(id_col).eqNullSafe(F.col("__mix_id")) & F.col(source_col).eqNullSafe(F.col("__mix_source"))
    return (
        docs.join(drawn, same)
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
