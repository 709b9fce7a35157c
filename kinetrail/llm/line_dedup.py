"""Line dedup by site-relative frequency.

A line is boilerplate of a host when the pages of that host that contain it, divided by all pages of the host, exceed
``ratio``; it must be on ``min_pages`` pages at least, 2 by default: on a host of a few pages a line of one page would exceed any ratio. Boilerplate lines leave every page of that host, and only that host.

Plan: lines become 128-bit keys, distinct within a page, and are counted by (host, key) with partial sums before the
shuffle, so a host or a line that holds a third of all rows costs one row per task. What is boilerplate is small: a host
whose pages have L lines on average has at most L / ratio such lines. Its size is measured; up to ``broadcast_rows`` keys it
is broadcast, beyond that it is joined on (host, salt), the salt from text and input partition, so that a hot host and copies of one text spread over tasks. Texts are never
shuffled on the first path.

Null text stays null and counts as a page without lines. A null host is the host "". Empty lines are never boilerplate.
Repeated rows are pages of their own; an empty table gives an empty table; long texts are taken whole. Other columns pass through untouched; ``n_lines`` and ``n_removed`` win over input columns
of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetrail.llm.common import staged

_HOST, _KEY, _ROW, _HEAVY, _SALT = "host", "key", "row", "heavy", "salt"


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def boilerplate(pages: DataFrame, text: Column, host: Column, ratio: float, min_pages: int) -> DataFrame:
    """(host, key) of every boilerplate line."""
    found = pages.select(F.coalesce(host.cast("string"), F.lit("")).alias(_HOST), text.alias("text"))
    sizes = found.groupBy(_HOST).agg(F.count(F.lit(1)).alias("pages"))
    split = F.filter(F.split("text", "\n", -1), lambda x: x != "")
    keys = found.select(_HOST, F.explode(F.array_distinct(F.transform(split, _key))).alias(_KEY))
    counts = keys.groupBy(_HOST, _KEY).agg(F.count(F.lit(1)).alias("holding")).where(F.col("holding") >= min_pages)
    return counts.join(sizes, _HOST).where(F.col("holding") > F.lit(ratio) * F.col("pages")).select(_HOST, _KEY)


def drop_boilerplate(
    pages: DataFrame, text: str = "text", host: Column | str = "source", ratio: float = 0.1, min_pages: int = 2, broadcast_rows: int = 500_000, salts: int = 64
) -> DataFrame:
    """pages with boilerplate lines taken out of ``text``, plus ``n_lines`` and ``n_removed``."""
    host = pages[host] if isinstance(host, str) else host
    heavy = staged(boilerplate(pages, pages[text], host, ratio, min_pages), "boilerplate")
    by_host = heavy.groupBy(_HOST).agg(F.collect_list(_KEY).alias(_HEAVY))
    rows = pages.select(F.struct(*[pages[x] for x in pages.columns]).alias(_ROW), F.coalesce(host.cast("string"), F.lit("")).alias(_HOST))
    if heavy.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(by_host), _HOST, "left")
    else:
        rows = rows.withColumn(_SALT, F.pmod(F.xxhash64(F.col(_ROW)[text], F.spark_partition_id()), F.lit(salts)))
        spread = by_host.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        joined = rows.join(spread, [_HOST, _SALT], "left")
    old = F.split(F.col(_ROW)[text], "\n", -1)
    none = F.col(_HEAVY).isNull()
    new = F.filter(old, lambda x: ~F.array_contains(F.col(_HEAVY), _key(x)) | (x == ""))
    before, after = F.coalesce(F.size(old), F.lit(0)), F.coalesce(F.size(F.col("new")), F.lit(0))
    out = joined.select(_ROW, F.when(none, old).otherwise(new).alias("new"))
    made = ("n_lines", "n_removed")
    columns = [F.array_join("new", "\n").alias(text) if x == text else F.col(_ROW)[x].alias(x) for x in pages.columns if x not in made]
    null = F.col(_ROW)[text].isNull()
    zero = F.lit(0).cast("bigint")
    return out.select(*columns, F.when(null, zero).otherwise(before.cast("bigint")).alias("n_lines"), F.when(null, zero).otherwise((before - after).cast("bigint")).alias("n_removed"))
