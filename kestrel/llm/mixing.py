"""Mixing sources to target weights (operator 8), DataFrame functions only.

Every document gets a hash-random key. Within each source the documents are ranged by key, prefix sums of their word
counts are built in two steps (sums of key ranges, then the one range in which the budget ends), and the source is cut
where its budget is exactly reached. A budget above the source's size repeats the source: whole epochs first, then the
cut on the rest. So a source's mix is fixed by a few numbers (whole epochs, cut key, words left at the cut), and taking
a document is a projection: no text and no row of the table is shuffled to place it.

Hot sources: the sums are partial aggregates over (source, key range); key ranges are as many as the rows need
(``RANGE_ROWS`` each), so no task holds a source. Only tables with one row per source, or per source and range, are
ordered in windows.

Defined results: a NULL text has 0 words and still gets a row; NULL is a source of its own, ranked last; a NULL doc_id is
ordinary. Rows equal in id and text share one key; if the cut falls on such a group, each takes the same share of what
is left (rounded down). An empty table gives an empty result. All columns pass through ``mix``; one named like its
result columns raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import WORD, broadcast_if_small, checkpointed, null_safe_key, refuse_clash

WEIGHTS = (5.0, 2.0, 1.0)  # by rank of the source, repeating
SHARE = 1.5  # words of the whole mix, as a multiple of all words
MAX_EPOCHS = 2  # a source is repeated at most so often
RANGE_ROWS = 8_192  # rows of a key range, about
KEY_BITS = 60

RESULT = "size bigint, source_size bigint, target double, taken bigint"


def n_words(text: str | Column = "text") -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(id_col: str, text_col: str, seed: str) -> Column:
    """60 uniform bits from md5 of seed, id and text: the same in every run."""
    whole = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source_key, source_value, source_size) -> the same plus ``target``.

    Water filling in closed form: with sources ordered by cap / weight, those before the first one that stays under
    its cap are full, and the others share the rest by weight. Taking that step one source later gives a lower level,
    so the level is the highest consistent one. One row per source, so one small ordered window.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source_value").isNull(), "source_value")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    t = sizes.select("*", weight.alias("weight"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy(F.lit(0))
    t = t.select(
        "*", (F.sum("source_size").over(everywhere) * F.lit(float(share))).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full"), F.sum("weight").over(after).alias("open_weight"),
    )
    level = (F.col("total") - F.col("full")) / F.col("open_weight")
    t = t.withColumn("level", level)
    t = t.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everywhere))
    target = F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap")))
    return t.select("source_key", "source_value", "source_size", target.alias("target"))


def plan(sized: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per source: source_key, source_size, target, epochs (whole passes), cut_key, cut_left, cut_size.

    ``sized`` has source_key, source_value, key, size. Documents with key below ``cut_key`` take one pass more;
    those at ``cut_key`` (in all ``cut_size`` words) share the ``cut_left`` words that remain.
    """
    n = sized.count()
    ranges = max(1, -(-n // range_rows))
    width = -(-(1 << KEY_BITS) // ranges)
    ranged = sized.withColumn("range", F.expr(f"key div {width}L"))
    sums = checkpointed(
        ranged.groupBy("source_key", "range").agg(F.first("source_value").alias("source_value"), F.sum("size").alias("size"))
    )
    sizes = sums.groupBy("source_key").agg(F.first("source_value").alias("source_value"), F.sum("size").alias("source_size"))
    t = targets(sizes, weights, share, max_epochs).withColumn("budget", F.round("target").cast("bigint"))
    t = t.withColumn("epochs", F.expr("case when source_size > 0 then budget div source_size else 0L end"))
    t = checkpointed(t.withColumn("budget", F.col("budget") - F.col("epochs") * F.col("source_size")))

    upto = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sums.select("source_key", "range", "size", F.sum("size").over(upto).alias("upto"))
    at_range = (
        running.join(broadcast_if_small(t.select("source_key", "budget")), "source_key")
        .where((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("size") <= F.col("budget")))
        .select("source_key", "range", (F.col("budget") - F.col("upto") + F.col("size")).alias("left"))
    )
    by_key = ranged.join(broadcast_if_small(checkpointed(at_range)), ["source_key", "range"]).groupBy("source_key", "range", "key").agg(
        F.sum("size").alias("size"), F.first("left").alias("left"))
    upto_key = Window.partitionBy("source_key", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        by_key.withColumn("upto", F.sum("size").over(upto_key))
        .where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("size") <= F.col("left")))
        .select("source_key", F.col("key").alias("cut_key"), (F.col("left") - F.col("upto") + F.col("size")).alias("cut_left"),
                F.col("size").alias("cut_size"))
    )
    return t.drop("budget", "source_value").join(cut, "source_key", "left")


def taken() -> Column:
    """Words that the mix takes of a document, repeats counted."""
    part = (
        F.when(F.col("cut_key").isNull(), F.lit(0))
        .when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), F.expr("(size * cut_left) div cut_size"))
        .otherwise(F.lit(0))
    )
    return (F.col("epochs") * F.col("size") + part).cast("bigint")


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, range_rows: int = RANGE_ROWS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns (default: all) of every document plus size, source_size, target (its source's) and taken."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, RESULT)
    own = [F.col(c).alias(f"_in_{c}") for c in keep]
    sized = df.select(
        *own, null_safe_key(source_col).alias("source_key"), F.col(source_col).alias("source_value"),
        random_key(id_col, text_col, seed).alias("key"), n_words(text_col).alias("size"),
    )
    if text_col in keep:  # the plan reads a narrow copy; the texts are read again where they stand
        small = checkpointed(sized.select("source_key", "source_value", "key", "size"))
    else:
        small = sized = checkpointed(sized)
    cuts = checkpointed(plan(small, weights, share, max_epochs, range_rows))
    out = sized.join(broadcast_if_small(cuts), "source_key", "left")
    return out.select(*[F.col(f"_in_{c}").alias(c) for c in keep], "size", "source_size", "target", taken().alias("taken"))


def materialize(mixed: DataFrame, columns: Sequence[str], text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The mix as rows: a document once per pass; the one cut in a source gives its first words, white space as it was.
    Documents of which nothing is taken go. ``length_col`` is set to the text's code points."""
    words = F.col("taken") - F.col("pass") * F.col("size")
    head = F.array_join(F.slice(F.regexp_extract_all(text_col, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), words.cast("int")), "")
    passes = F.expr("sequence(0L, (taken + size - 1) div size - 1)")
    rows = mixed.where("taken > 0").withColumn("pass", F.explode(passes))
    rows = rows.withColumn(text_col, F.when(words >= F.col("size"), F.col(text_col)).otherwise(head))
    if length_col:
        rows = rows.withColumn(length_col, F.char_length(text_col).cast("bigint"))
    return rows.select(*columns)


def oracle_sql(seed: str = "mix") -> str:
    """DuckDB SQL for the query over ``documents``; the water filling takes each source's level by plain
    sub-selects, the prefix sums one plain window per source."""
    return f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         ('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(doc_id::varchar, ''), coalesce(text, ''))), 1, 15))::bigint as key
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         [5.0, 2.0, 1.0][1 + (row_number() over (order by source is null, source) - 1) % 3]::double as w
  from d group by source),
lv as (
  select a.source, (select sum(source_size) * 1.5 - coalesce(sum(2.0 * source_size) filter (2.0 * source_size / w < 2.0 * a.source_size / a.w), 0)
                    from s) / (select sum(w) filter (2.0 * source_size / w >= 2.0 * a.source_size / a.w) from s) as lev,
         2.0 * a.source_size / a.w as r from s a),
t as (
  select s.source, source_size, least(2.0 * source_size, w * coalesce((select max(lev) from lv where lev <= r), 2.0 * source_size / w)) as target from s),
b as (
  select *, round(target)::bigint as budget, case when source_size > 0 then round(target)::bigint // source_size else 0 end as epochs from t),
c as (
  select doc_id, size, d.key, source_size, target, epochs, budget - epochs * source_size as left_over,
         sum(size) over (partition by d.source order by d.key)::bigint as upto,
         sum(size) over (partition by d.source, d.key)::bigint as tie
  from d join b on d.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (epochs * size + case when upto <= left_over then size when upto - tie < left_over then size * (left_over - upto + tie) // tie
        else 0 end)::bigint as taken
from c"""
