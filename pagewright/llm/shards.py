"""Sharding by minimax contiguous partition of atomic groups.

Rows with equal texts form a group, which no shard boundary splits. Groups stand in the order of their
text's 64-bit hash (texts that share a hash stay together as well, which keeps the rule). The smallest
feasible capacity is found by binary search; a candidate is checked by filling shards greedily.

The sizes of all groups never meet in one place. The driver holds the order cut into cells of hash
values, 65,536 at first, with the bytes of each. Greedy filling over cells gives a sure answer in two
cases: when cuts at cell ends suffice, or when cuts anywhere would not. Only the cells in which the
answer could turn are then cut finer, by one aggregation over the hashes, until the smallest capacity is
known exactly. Cuts are hash values, so rows find their shard without a join, however large a group is.

Slots come from two-pass prefix sums: each task numbers its rows per shard and writes them to the
shared folder, then the counts of tasks give each task its base.

Defined results: a null text counts as empty, and equals an empty one. Repeated rows keep their shard
and get slots of their own; null ids are rows like others. An empty table gives an empty result. A
group larger than all others together leaves some shards empty. Columns beyond doc_id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.llm.common import broadcast_if, materialize

FIRST_SHIFT, STEP_BITS = 48, 10
#: Cells that one round cuts finer; a round collects at most 2**STEP_BITS numbers for each.
CELLS_A_ROUND = 256


def fill(ends, exact, capacity: int, shards: int, hopeful: bool) -> tuple[bool, list[int]]:
    """Greedy filling over cells: whether ``shards`` suffice, and where the cuts fall.

    ``ends`` are running totals at cell ends; ``exact`` tells cells that hold one group. A capacity that
    ends inside any other cell is cut at the cell's start, or right there if ``hopeful``.
    """
    import numpy as np

    at, cuts, total = 0, [], int(ends[-1]) if len(ends) else 0
    for _ in range(shards):
        reach = at + capacity
        if reach >= total:
            return True, cuts
        i = int(np.searchsorted(ends, reach, side="right"))
        stop = int(ends[i - 1]) if i else 0
        if hopeful and not exact[i]:
            stop = reach
        if stop <= at:
            return False, cuts
        cuts.append(stop)
        at = stop
    return False, cuts


def smallest_capacity(cells, refine, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the last hash of each shard but the final ones that stay empty.

    ``cells``: dict of arrays lo, hi (first and last hash present), bytes and shift, sorted by lo.
    ``refine(prefixes, shift)`` returns such cells for the hashes whose value shifted by ``shift`` is listed.
    """
    import numpy as np

    while True:
        order = np.argsort(cells["lo"], kind="stable")
        cells = {k: v[order] for k, v in cells.items()}
        ends, exact = np.cumsum(cells["bytes"]), cells["lo"] == cells["hi"]
        if not len(ends):
            return 0, []

        def search(hopeful: bool, ends=ends, exact=exact) -> int:
            low, high = 0, int(ends[-1])
            while high - low > 1:
                middle = (low + high) // 2
                if fill(ends, exact, middle, shards, hopeful)[0]:
                    high = middle
                else:
                    low = middle
            return high

        sure, hope = search(False), search(True)
        if sure == hope:
            cuts = fill(ends, exact, sure, shards, False)[1]
            return sure, [int(cells["hi"][np.searchsorted(ends, c)]) for c in cuts]
        low, high = [fill(ends, exact, hope - 1, shards, False)[1], fill(ends, exact, sure, shards, True)[1]]
        doubt = np.zeros(len(ends), dtype=bool)
        starts = ends - cells["bytes"]
        low, high = [0, *low], [0, *high]
        for k in range(len(high)):
            a = low[min(k, len(low) - 1)] + hope - 1
            b = high[k] + sure
            doubt |= ~exact & (starts < b) & (ends > a)
        chosen = np.flatnonzero(doubt if doubt.any() else ~exact)[:CELLS_A_ROUND]
        shift = int(cells["shift"][chosen].max())
        chosen = chosen[cells["shift"][chosen] == shift]
        finer = refine((cells["lo"][chosen] >> shift).tolist(), shift)
        keep = np.ones(len(ends), dtype=bool)
        keep[chosen] = False
        cells = {k: np.concatenate([v[keep], finer[k]]) for k, v in cells.items()}


def _cells(rows: DataFrame, shift: int) -> dict:
    import numpy as np

    found = rows.groupBy(F.shiftright("hash", shift)).agg(F.min("hash").alias("lo"), F.max("hash").alias("hi"), F.sum("size").alias("bytes")).toArrow()
    return {k: found.column(k).to_numpy().astype(np.int64) for k in ("lo", "hi", "bytes")} | {"shift": np.full(found.num_rows, shift, dtype=np.int64)}


def _number(last: list[int], shards: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        seen, cuts, part = np.zeros(shards, dtype=np.int64), np.array(last, dtype=np.int64), TaskContext.get().partitionId()
        for batch in batches:
            shard = np.searchsorted(cuts, batch.column("hash").to_numpy(), side="left")
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            local = np.empty(len(shard), dtype=np.int64)
            local[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "size", "text_crc32")), pa.array(shard.astype(np.int32)), pa.array(np.full(len(shard), part, dtype=np.int32)), pa.array(local)],
                names=["doc_id", "size", "text_crc32", "shard", "part", "local"],
            )

    return run


def assign_shards(spark: SparkSession, docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash")
    )
    rows = materialize(spark, rows, "shards-rows")

    def refine(prefixes: list[int], shift: int) -> dict:
        return _cells(rows.where(F.shiftright("hash", shift).isin(prefixes)), max(0, shift - STEP_BITS))

    _, last = smallest_capacity(_cells(rows, FIRST_SHIFT), refine, shards)
    numbered = materialize(spark, rows.mapInArrow(_number(last, shards), "doc_id bigint, size bigint, text_crc32 bigint, shard int, part int, local bigint"), "shards-numbered")
    counts = numbered.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("base"))
    n_bases = counts.count()
    return numbered.join(broadcast_if(bases, 32 * n_bases), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("local")).alias("slot")
    )


def write_shards(assigned: DataFrame, docs: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """The documents as Parquet, one folder per shard, in files of consecutive slots, each ordered by slot; needs unique doc_ids."""
    rows = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id").withColumn("part", F.floor(F.col("slot") / rows_per_file))
    rows.repartition("shard", "part").sortWithinPartitions("shard", "slot").drop("part").write.partitionBy("shard").parquet(path)
