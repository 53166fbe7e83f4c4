"""Line dedup (operator 1) by site-relative frequency, DataFrame functions only.

A line is boilerplate on a host when it stands on more than ``max_ratio`` of the host's pages, and on at least
``min_pages`` of them. Without ``min_pages``, a line must stand on ``MIN_PAGES`` pages if it exceeds ``SURE_RATIO``, else
on ``RARE_PAGES``: a small share counts only on hosts where it is many pages, so rare lines stay. Pages are the distinct texts of a host: a page published many times counts once, so a group of
exact copies does not turn its own lines into boilerplate. Lines are compared without leading and trailing spaces; a
line counts once per page; blank lines are never counted and never dropped.

Scale: lines travel as 64-bit hashes (a wrong match needs a hash collision within one host) and are counted by partial
aggregation on (host, line), so a hot host is spread over tasks. A host has at most (mean lines per page) / max_ratio
boilerplate lines, so the list per host is bounded; texts are not shuffled while the lists fit a broadcast of checked
size, and otherwise Spark joins them by host and may split the hot ones.

Defined results: a NULL host is a host of its own; NULL texts stay NULL with 0 lines and are no pages; a text whose
lines are all boilerplate becomes empty; the order of kept lines stays. Repeated rows repeat their result, an empty
table gives an empty result, all other columns pass through; a column named like a result column raises ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import broadcast_if_small, checkpointed, null_safe_key, refuse_clash

MAX_RATIO = 0.01
SURE_RATIO = 0.05
MIN_PAGES = 3
RARE_PAGES = 10


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def boilerplate_lines(
    df: DataFrame, host_col: str, text_col: str, max_ratio: float = MAX_RATIO, min_pages: int | None = None
) -> DataFrame:
    """(host_key, boilerplate: hashes of the host's boilerplate lines), one row per host that has any."""
    hashes = F.array_distinct(
        F.transform(F.filter(_lines(text_col), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(F.trim(x)))
    )
    pages = (
        df.where(F.col(text_col).isNotNull())
        .select(null_safe_key(host_col).alias("host_key"), F.xxhash64(text_col, F.length(text_col)).alias("page"), hashes.alias("lines"))
        .dropDuplicates(["host_key", "page"])
    )
    pages = checkpointed(pages)
    totals = pages.groupBy("host_key").agg(F.count("*").alias("pages"))
    counts = (
        pages.select("host_key", F.explode("lines").alias("line"))
        .groupBy("host_key", "line").agg(F.count("*").alias("n")).where(F.col("n") >= (MIN_PAGES if min_pages is None else min_pages))
    )
    frequent = counts.join(broadcast_if_small(totals), "host_key").where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
    if min_pages is None:
        frequent = frequent.where((F.col("n") >= RARE_PAGES) | (F.col("n") > F.lit(SURE_RATIO) * F.col("pages")))
    return frequent.groupBy("host_key").agg(F.sort_array(F.collect_list("line")).alias("boilerplate"))


def line_dedup(
    df: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO,
    min_pages: int | None = None, length_col: str | None = None,
) -> DataFrame:
    """Every row with its text cleaned, plus ``n_lines`` (before, blank lines included) and ``n_dropped``.
    ``length_col`` is set to the text's new number of code points."""
    refuse_clash(df.columns, "n_lines bigint, n_dropped bigint")
    lists = checkpointed(boilerplate_lines(df, host_col, text_col, max_ratio, min_pages))
    own = [F.col(c).alias(f"_in_{c}") for c in df.columns]
    rows = df.select(*own, null_safe_key(host_col).alias("host_key")).join(broadcast_if_small(lists), "host_key", "left")
    text = F.col(f"_in_{text_col}")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("boilerplate"), F.xxhash64(F.trim(x))))
    rows = rows.withColumn("_kept", F.when(F.col("boilerplate").isNotNull(), kept).otherwise(lines))
    new = F.array_join("_kept", "\n")
    cols = []
    for c in df.columns:
        value = new if c == text_col else F.char_length(new).cast("bigint") if c == length_col else F.col(f"_in_{c}")
        cols.append(value.alias(c))
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("bigint")
    n_lines = F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(n_lines)
    n_kept = F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(F.size("_kept").cast("bigint"))
    return rows.select(*cols, n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"))


def oracle_sql(max_ratio: float = MAX_RATIO, min_pages: int | None = None) -> str:
    """DuckDB SQL for the query over ``documents``, on whole lines instead of hashes."""
    least = f"case when count(*) > {SURE_RATIO} * t.pages then {MIN_PAGES} else {RARE_PAGES} end" if min_pages is None else min_pages
    return f"""
with pages as (select distinct source, text from documents where text is not null),
lines as (
  select distinct source, text, trim(unnest(string_split(text, chr(10))), ' ') as line from pages),
totals as (select source, count(*) as pages from pages group by source),
frequent as (
  select l.source, l.line from lines l join totals t on l.source is not distinct from t.source
  where line <> '' group by l.source, l.line, t.pages having count(*) >= {least} and count(*) > {max_ratio} * t.pages),
lists as (select source, list(line) as boilerplate from frequent group by source),
d as (
  select doc_id, d.source, string_split(d.text, chr(10)) as a, coalesce(boilerplate, []) as boilerplate
  from documents d left join lists l on d.source is not distinct from l.source),
k as (select *, list_filter(a, lambda x: trim(x, ' ') = '' or not list_contains(boilerplate, trim(x, ' '))) as kept from d)
select doc_id, source, array_to_string(kept, chr(10)) as text, coalesce(len(a), 0)::bigint as n_lines,
       coalesce(len(a) - len(kept), 0)::bigint as n_dropped
from k"""
