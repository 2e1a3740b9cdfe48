"""Repeated runs of lines: overlapping windows of consecutive lines, found globally, later occurrences cut out.

DataFrame functions only. Every window is named by two 64-bit hashes of its lines; its first occurrence
is the least (id, row, position) of a map-side combined aggregate, so a window that a third of all documents hold
costs a row per map task. Lines covered by any later occurrence go; covered positions merge because kept
lines are taken as the gaps between the sorted positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh

WINDOW = 3


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """The input rows and columns with the repeated lines cut out of ``text_col``, and two counts.

    A window is ``window`` consecutive lines (parted by \\n, compared as they are), not all empty. Of equal
    windows the first in the order of id (nulls first), row and position stays; the lines of every other are removed, overlapping
    ones once. A text with fewer lines has no window and stays, a null text stays null (0 lines), a text of which all
    lines go becomes empty. Rows that repeat an id are rows of their own, in the order they were read. An
    empty table gives an empty result. Should ``counts`` clash with input columns, rename them there.
    """
    row, cuts, held = (fresh(docs, x) for x in ("row_", "cuts_", "kept_"))
    docs = cut(docs.withColumn(row, F.monotonically_increasing_id()), "lines")
    lines = docs.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.split(F.col(text_col), "\n", -1).alias("l")).filter(F.size("l") >= window)

    def named(i):
        own = F.slice(F.col("l"), i + 1, window)
        return F.struct(i.cast("int").alias("pos"), F.xxhash64(own).alias("h"), F.xxhash64(F.lit("\n"), own).alias("g"), (F.array_join(own, "") != "").alias("text"))

    found = (lines.select("row", "id", F.explode(F.transform(F.sequence(F.lit(0), F.size("l") - window), named)).alias("w"))
             .filter("w.text").select("row", "id", "w.pos", "w.h", "w.g"))
    at = F.struct("id", "row", "pos")
    first = found.groupBy("h", "g").agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = found.join(first, ["h", "g"]).filter((F.col("row") != F.col("first.row")) | (F.col("pos") != F.col("first.pos")))
    gone = later.groupBy("row").agg(F.array_sort(F.collect_list("pos")).alias(cuts)).withColumnRenamed("row", row)

    whole = F.split(F.col(text_col), "\n", -1)
    after = lambda i: F.when(i == 0, 0).otherwise(F.element_at(cuts, i.cast("int")) + window)  # noqa: E731  first line after the window before
    until = lambda i: F.when(i == F.size(cuts), F.size(whole)).otherwise(F.element_at(cuts, (i + 1).cast("int")))
    gaps = F.transform(F.sequence(F.lit(0), F.size(cuts)), lambda i: F.slice(whole, after(i) + 1, F.greatest(F.lit(0), until(i) - after(i))))
    kept = F.flatten(gaps)
    out = docs.join(gone, row, "left").withColumn(held, F.when(F.col(cuts).isNotNull(), kept))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(whole)).cast("long")
    removed = F.when(F.col(held).isNull(), 0).otherwise(F.size(whole) - F.size(held)).cast("long")
    text = F.when(F.col(held).isNull(), F.col(text_col)).otherwise(F.array_join(held, "\n"))
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != row], n_lines.alias(counts[0]), removed.alias(counts[1]))


ORACLE_SQL = """
with split as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
spots as (select doc_id, ls, unnest(range(0, len(ls) - 2)) as pos from split),
windows as (select doc_id, pos, ls[pos + 1:pos + 3] as w from spots where array_to_string(ls[pos + 1:pos + 3], '') <> ''),
ranked as (select doc_id, pos, row_number() over (partition by w order by doc_id, pos) as nth from windows),
gone as (select distinct doc_id, pos + k as line from ranked, (select unnest(range(0, 3)) as k) where nth > 1),
lines as (select doc_id, unnest(ls) as line, unnest(range(0, len(ls))) as pos from split),
kept as (select l.doc_id, count(*) as n_lines, count(g.line) as n_removed,
  coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where g.line is null), '') as text
  from lines l left join gone g on g.doc_id = l.doc_id and g.line = l.pos group by l.doc_id)
select s.doc_id, case when s.text is null then null else k.text end as text,
  coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed
from split s left join kept k on s.doc_id = k.doc_id
"""
