"""Document ids from file names."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.sources.shared import broadcast_if, materialize, partitions_for

#: A slug that is another one with a number behind it; no table has so many rows that a longer number is met.
NUMBERED = r"^(.*)-([1-9][0-9]{0,17})$"
#: Rows of a slug that one task numbers.
WINDOW_ROWS = 1_000_000
WALKED = "slug string, child string, row_kept bigint, lost_kept boolean, row_lost bigint, lost_lost boolean, chain array<string>"


def slugify(name: Column) -> Column:
    """Lower case, runs of other than ASCII letters and digits as one hyphen, none at the ends; ``doc`` if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("doc"))


def base_name(path: Column) -> Column:
    """The last part of a path without its ``.pdf`` endings."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(\.pdf)+$", "")


def _chain(slug: str) -> list[str]:
    """``slug`` and what is left of it as one number after the other is taken off its end."""
    out = [slug]
    while m := re.fullmatch(NUMBERED, out[-1]):
        out.append(m[1])
    return out


def _walk(batches: Iterator) -> Iterator:
    """Which numbered slugs a stem's rows reach, for a stem whose first row keeps the bare slug, and for one that loses it.

    Rows are (slug, child, k, before), by slug and k: ``child`` is slug-k, and ``before`` counts the rows of ``slug``
    that come before the first row of ``child``. A row that reaches k passes it if ``child`` was there first, else takes it.
    """
    import pyarrow as pa

    at, passed = None, [0, 0]
    for batch in batches:
        out = {c: [] for c in ("row_kept", "lost_kept", "row_lost", "lost_lost", "chain")}
        for slug, child, k, before in zip(*(batch.column(c).to_pylist() for c in ("slug", "child", "k", "before")), strict=True):
            if slug != at:
                at, passed = slug, [0, 0]
            lost = []
            for start, name in enumerate(("kept", "lost")):
                row = k - start - passed[start]
                lost.append(row < before)
                passed[start] += row >= before
                out[f"row_{name}"].append(row)
                out[f"lost_{name}"].append(row < before)
            out["chain"].append(_chain(child) if lost[0] != lost[1] else [])
        types = {"row_kept": pa.int64(), "row_lost": pa.int64(), "chain": pa.list_(pa.string())}
        yield pa.RecordBatch.from_arrays(
            [batch.column("slug"), batch.column("child"), *(pa.array(v, types.get(c, pa.bool_())) for c, v in out.items())], names=["slug", "child", *out]
        )


def _losing(walked: DataFrame) -> DataFrame:
    """child: the numbered slugs whose bare name a row of their stem takes first.

    Where that hangs on whether the stem lost its own bare name, the chain of stems above is read from its far end;
    a stem that is not there, or is no numbered slug of another, keeps its name.
    """
    sure = walked.where("lost_kept and lost_lost").select("child")
    above = walked.select("child", F.posexplode("chain").alias("depth", "of")).join(walked.select(F.col("child").alias("of"), "lost_kept", "lost_lost"), "of", "left")
    steps = above.groupBy("child").agg(F.sort_array(F.collect_list(F.struct("depth", "lost_kept", "lost_lost")), asc=False).alias("steps"))
    end = F.aggregate("steps", F.lit(False), lambda lost, s: F.coalesce(F.when(lost, s["lost_lost"]).otherwise(s["lost_kept"]), F.lit(False)))
    return sure.unionByName(steps.where(end).select("child"))


def running_total(rows: DataFrame, value: Column, order: list[str], name: str, hot: bool) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows of its slug up to it, in ``order``.

    If some slug is ``hot``, no task takes all rows of a slug: rows are dealt by ranges of slug and order and written,
    summed within their range, and moved by the sum of the ranges before, which is a row for each end of a range at most.
    """
    if not hot:
        return rows.withColumn(name, F.sum(value).over(Window.partitionBy("slug").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    n = partitions_for(rows)
    dealt = rows.withColumn("__value", value).repartitionByRange(n, "slug", *order).withColumn("__range", F.spark_partition_id())
    dealt = materialize(rows.sparkSession, dealt, "slug-ranges")
    sums = dealt.groupBy("slug", "__range").agg(F.sum("__value").alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy("slug").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    moved = sums.select("slug", "__range", before.alias("__before")).where("__before <> 0")
    here = F.sum("__value").over(Window.partitionBy("slug", "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    joined = dealt.withColumn(name, here).join(broadcast_if(moved, 256 * n), ["slug", "__range"], "left")
    return joined.withColumn(name, F.col(name) + F.coalesce("__before", F.lit(0))).drop("__value", "__range", "__before")


def with_unique_slugs(files: DataFrame, name: Column, order: list, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``files`` with slug and doc_id: a slug met before gets the lowest free suffix -1, -2, ...

    Rows are met in ``order``, those at one place of it by slug. Rows of one slug are numbered by a window. A number may
    clash with a slug that is natural elsewhere (``a``, ``a``, ``a-1``); whichever is met first has the name. A slug's
    numbers only rise, so what decides is how many of its rows come before the first row of each numbered slug: these
    distinct slugs alone are walked, in the order of their numbers, and each that a slug passes moves the numbers of
    its further rows by one. A slug of more than ``window_rows`` rows is numbered by several tasks.
    """
    rows = files.withColumn("slug", slugify(name)).withColumn("__order", F.struct(*order))
    slugs = materialize(files.sparkSession, rows.groupBy("slug").agg(F.min("__order").alias("__order"), F.count("*").alias("n")), "slug-counts")
    hot = (slugs.agg(F.max("n")).first()[0] or 0) > window_rows
    slugs = slugs.drop("n")
    numbered = slugs.select(F.regexp_extract("slug", NUMBERED, 1).alias("stem"), F.col("slug").alias("child"), F.regexp_extract("slug", NUMBERED, 2).alias("k"), "__order").where("stem <> ''")
    clashing = numbered.join(slugs.select(F.col("slug").alias("stem")), "stem", "left_semi").select(F.col("stem").alias("slug"), "child", F.col("k").cast("bigint").alias("k"), "__order")
    own = rows.join(clashing.select("slug"), "slug", "left_semi").select("slug", "__order")
    met = own.unionByName(clashing, allowMissingColumns=True).withColumn("__late", F.col("child").isNotNull())
    met = running_total(met, F.when(F.col("child").isNull(), 1).otherwise(0), ["__order", "__late"], "before", hot)
    by_number = met.where("child is not null").select("slug", "child", "k", "before").repartition("slug").sortWithinPartitions("slug", "k")
    walked = materialize(files.sparkSession, by_number.mapInArrow(_walk, WALKED), "slugs")
    rows = running_total(rows, F.lit(1), ["__order"], "__n", hot).withColumn("__n", F.col("__n") - 1)
    if not walked.isEmpty():
        losing = _losing(walked)
        moved = losing.select(F.col("child").alias("slug"), F.lit(0).alias("__n"))
        stems = walked.join(losing.select(F.col("child").alias("slug"), F.lit(True).alias("lost")), "slug", "left")
        passed = stems.where("if(lost, not lost_lost, not lost_kept)").select("slug", F.expr("if(lost, row_lost, row_kept)").alias("__n"))
        both = rows.withColumn("__move", F.lit(0)).unionByName(moved.unionByName(passed).withColumn("__move", F.lit(1)), allowMissingColumns=True)
        both = both.withColumn("__late", F.col("__move") == 0)  # what moves a row at a number comes before it
        rows = running_total(both, F.col("__move"), ["__n", "__late"], "__moves", hot).where("__move = 0").withColumn("__n", F.col("__n") + F.col("__moves"))
    number = F.col("__n").cast("string")
    return rows.withColumn("doc_id", F.when(F.col("__n") > 0, F.concat_ws("-", "slug", number)).otherwise(F.col("slug"))).select(*files.columns, "slug", "doc_id")
