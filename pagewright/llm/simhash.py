"""SimHash near-dedup with anchor points.

A fingerprint has 64 bits, made of two halves. If two fingerprints differ in at most t bits, one half
differs in at most t // 2. Each half has its own anchors: the words of a Hamming code on 31 bits with
the last bit free, a code of covering radius 1. Two halves that differ in at most 2s bits have a half
within s of both, and an anchor within the covering radius of that one; so a fingerprint is replicated
to every anchor within covering radius plus s (for t = 4: s = 1, at most 17 anchors a half), and every
pair of the threshold meets at an anchor. (Anchors over all 64 bits at once are out of reach: a code of
small radius has too many anchors in range, one of large radius has too few in all.)

Only different fingerprints are compared. An anchor's members are compared with those not yet linked,
so n members give n - 1 links at most. The members of an anchor with more than a block are dealt again, by the
pieces of their other half: of t + 1 pieces, two within t bits have one in common. What is still larger
is cut into blocks, and every pair of blocks is compared by a task of its own; no anchor is capped. Links
join into components by rounds of joins (see ``components``).

Defined results: a null or empty text, or one of blanks, has fingerprint zero, which links like any
other. Repeated rows share a fingerprint. Null ids keep a row each and are ignored in the smallest id
of a component, which is null if it has no other. An empty table gives an empty result. Columns beyond
doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import xxh64
from pagewright.llm.common import map_batches, materialize, slices, warm
from pagewright.llm.components import connected_components

SEED = 42
#: Members of an anchor that one task compares; more are compared block by block.
BLOCK = 4096
#: Hashes, and texts, whose bits are counted at once.
BITS_ROWS, BITS_TEXTS = 1 << 16, 256


def _bytes_of(texts):
    """The bytes of an Arrow string array without nulls, A-Z in lower case and ASCII white space as blanks, and the size of each text."""
    import numpy as np

    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, dtype=np.int32)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    to = np.arange(256, dtype=np.uint8)
    to[65:91] += 32
    to[9:14] = 32
    return to[data], np.diff(offsets).astype(np.int64)


def fingerprints_of(texts, width: int):
    """The fingerprint of each text, as a signed integer: bits that are set in over half of its shingles' hashes."""
    import numpy as np

    n = len(texts)
    data, sizes = _bytes_of(texts)
    # A blank ends each text, and each word; other white space goes.
    apart = np.full(len(data) + n, 32, dtype=np.uint8)
    of_byte = np.repeat(np.arange(n), sizes)
    apart[np.arange(len(data)) + of_byte] = data
    inside = apart != 32
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    keep = inside.copy()
    keep[ends] = True
    joined = apart[keep]
    long = ends - first
    at = np.cumsum(long + 1) - (long + 1)
    text_of = np.searchsorted(np.cumsum(sizes + 1), first, side="right")
    words = np.bincount(text_of, minlength=n)
    shingles = np.where(words > 0, np.maximum(1, words - width + 1), 0)

    owner = np.repeat(np.arange(n), shingles)
    head = np.cumsum(words) - words
    a = head[owner] + np.arange(len(owner)) - (np.cumsum(shingles) - shingles)[owner]
    b = np.minimum(a + width, (head + words)[owner]) - 1
    hashed = xxh64.hashes(joined, at[a], at[b] + long[b] - at[a], SEED)
    # Bytes are counted by text, place and value; a table then turns these counts into counts of bits.
    counts, lo = np.zeros((n, 64), dtype=np.int64), 0
    table = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").astype(np.float64)
    while lo < len(owner):
        base = owner[lo]
        hi = min(lo + BITS_ROWS, int(np.searchsorted(owner, base + BITS_TEXTS)))
        rows = int(owner[hi - 1] - base) + 1
        values = hashed[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(8) * 256 + (owner[lo:hi, None] - base) * 2048
        counts[base : base + rows] += (np.bincount(values.ravel(), minlength=rows * 2048).reshape(rows, 8, 256) @ table).reshape(rows, 64).astype(np.int64)
        lo = hi
    return np.packbits(2 * counts > shingles[:, None], axis=1, bitorder="little").view("<i8").ravel()


def _fingerprints(width: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        warm("simhash", width, dict)  # drops what other operators left in the worker
        for whole in batches:
            for batch in slices(whole, "text"):
                fps = fingerprints_of(pc.fill_null(batch.column("text"), ""), width)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return run


def anchor_masks(half_threshold: int):
    """For each of the 32 syndromes, the masks that lead from a half to its anchors in range; -1 fills up."""
    import numpy as np

    reach = 1 + (half_threshold + 1) // 2
    by_syndrome: list[list[int]] = [[] for _ in range(32)]

    def grow(mask: int, syndrome: int, first: int, left: int) -> None:
        by_syndrome[syndrome].append(mask)
        if left:
            for i in range(first, 31):
                grow(mask | 1 << i, syndrome ^ (i + 1), i + 1, left - 1)

    grow(0, 0, 0, reach)
    found = [m + [x | 1 << 31 for x in m if x.bit_count() < reach] for m in by_syndrome]
    table = np.full((32, max(map(len, found))), -1, dtype=np.int64)
    for s, m in enumerate(found):
        table[s, : len(m)] = m
    return table


def syndromes(half):
    """Of the low 31 bits: the exclusive or of the 1-based places of the bits that are set."""
    import numpy as np

    out = np.zeros(len(half), dtype=np.int64)
    for i in range(31):
        out ^= ((half >> i) & 1) * (i + 1)
    return out


def _to_anchors(threshold: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        masks = anchor_masks(threshold // 2)
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for which in (0, 1):
                half = (fps >> (32 * which)) & 0xFFFFFFFF
                around = masks[syndromes(half)]
                row, k = np.nonzero(around >= 0)
                anchors = (half[row] ^ around[row, k]) | (which << 32)
                for a in range(0, len(row), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(anchors[a : a + 100_000]), pa.array(fps[row[a : a + 100_000]])], names=["anchor", "fp"])

    return run


def distance(a, b):
    """Differing bits; of unsigned numbers, as numpy counts the bits of a signed number's absolute value."""
    import numpy as np

    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(fps, threshold: int) -> list[tuple[int, int]]:
    """Links of distinct fingerprints within ``threshold`` bits, enough to keep their components: fewer than members."""
    import numpy as np

    links, rest, queue = [], np.asarray(fps, dtype=np.int64), []
    while len(rest) or queue:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        near = distance(rest, at) <= threshold
        if near.any():
            queue.extend(found := rest[near])
            links.extend((int(at), int(x)) for x in found)
            rest = rest[~near]
    return links


def _groups(batches: Iterator, keys: list[str], most: int):
    """Runs of equal keys in sorted batches, as (key, fps); runs over ``most`` come in parts, with done False."""
    import numpy as np

    held, key, split = [], None, False
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in keys]
        fps = batch.column("fp").to_numpy()
        if not len(fps):
            continue
        change = np.zeros(len(fps), dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), len(fps)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            new = tuple(int(c[a]) for c in columns)
            if new != key:
                if held:
                    yield key, np.concatenate(held), not split
                held, key, split = [], new, False
            held.append(fps[a:b])
            if sum(map(len, held)) > most:
                yield key, np.concatenate(held), False
                held, split = [], True
    if held:
        yield key, np.concatenate(held), not split


def _compare(threshold: int, most: int):
    """(a, b) links of each anchor, or (a, null) with the anchor where there are too many members."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def rows(links: list, over: list):
            a = [x for x, _ in links] + [int(x) for _, f in over for x in f]
            b = [y for _, y in links] + [None] * (len(a) - len(links))
            at = [None] * len(links) + [k for k, f in over for _ in range(len(f))]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(at, pa.int64())], names=["a", "b", "anchor"])

        links: list = []
        pairs = _pair_runs(batches, threshold, links)
        for (anchor,), fps, whole in _groups(pairs, ["anchor"], most):
            if whole and len(fps) > 1:
                links += forest(np.unique(fps), threshold)
            elif not whole:
                yield rows([], [(anchor, fps)])
            if len(links) > 50_000:
                yield rows(links, [])
                links.clear()
        yield rows(links, [])

    return run


def _pair_runs(batches: Iterator, threshold: int, links: list):
    """Pass on runs of three or more; compare runs of two at once, and drop single members.

    Runs at a batch's ends are passed on as they are.
    """
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        anchor, fps = batch.column("anchor").to_numpy(), batch.column("fp").to_numpy()
        n = len(anchor)
        if n < 8:
            yield batch
            continue
        starts = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        size = np.diff(np.concatenate([starts, [n]]))
        inner = np.ones(len(starts), dtype=bool)
        inner[[0, -1]] = False
        two = starts[inner & (size == 2)]
        near = two[distance(fps[two], fps[two + 1]) <= threshold]
        links.extend(zip(fps[near].tolist(), fps[near + 1].tolist(), strict=True))
        keep = np.repeat(~inner | (size > 2), size)
        yield pa.RecordBatch.from_arrays([pa.array(anchor[keep]), pa.array(fps[keep])], names=["anchor", "fp"])


def _compare_blocks(threshold: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for _, fps, _ in _groups(batches, ["anchor", "low", "high"], 1 << 62):
            links = forest(np.unique(fps), threshold)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return run


def _compared(spark: SparkSession, dealt: DataFrame, threshold: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Links within each anchor's members, and the members of anchors that have more than ``block``."""
    dealt = dealt.repartition("anchor").sortWithinPartitions("anchor")
    found = materialize(spark, map_batches(dealt, _compare(threshold, block), "a bigint, b bigint, anchor bigint"), "simhash-links")
    return found.where("b is not null").select("a", "b"), found.where("b is null").select("anchor", F.col("a").alias("fp"))


def in_pieces(over: DataFrame, threshold: int) -> DataFrame:
    """Members of an anchor of one half, dealt by the pieces of the other half: two within ``threshold`` bits agree in one of threshold + 1.

    An anchor of the result stands for (anchor, piece, bits of the piece), by hash; two that share it are compared in vain.
    """
    other = F.when(F.shiftright("anchor", 32) == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    ends = [32 * k // (threshold + 1) for k in range(threshold + 2)]
    bits = [F.shiftright(other, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("bigint")) for a, b in zip(ends, ends[1:], strict=False)]
    return over.select(F.explode(F.array(*(F.xxhash64("anchor", F.lit(k), x) for k, x in enumerate(bits)))).alias("anchor"), "fp")


def in_blocks(over: DataFrame, block: int) -> DataFrame:
    """Members of an anchor dealt to pairs of blocks (low, high), so that any two meet."""
    sizes = over.groupBy("anchor").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    cut = over.join(sizes.hint("merge"), "anchor").withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select("anchor", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "fp")


def near_links(spark: SparkSession, distinct: DataFrame, threshold: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to keep components; ``distinct`` has fp once each."""
    links, over = _compared(spark, map_batches(distinct.select("fp"), _to_anchors(threshold), "anchor bigint, fp bigint"), threshold, block)
    if over.isEmpty():
        return links
    more, over = _compared(spark, in_pieces(over, threshold), threshold, block)
    links = links.unionByName(more)
    if over.isEmpty():
        return links
    cut = in_blocks(over, block).repartition("anchor", "low", "high").sortWithinPartitions("anchor", "low", "high")
    return links.unionByName(map_batches(cut, _compare_blocks(threshold), "a bigint, b bigint"))


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: int = 4, width: int = 4, block: int = BLOCK) -> DataFrame:
    """doc_id, fp (signed 64 bits) and component_id (smallest doc_id reachable over links) of each row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = materialize(spark, map_batches(rows, _fingerprints(width), "doc_id bigint, fp bigint"), "simhash-fp")
    distinct = materialize(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    stars = connected_components(spark, near_links(spark, distinct, threshold, block), "simhash-components")
    members = stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()
    firsts = members.join(distinct.hint("merge"), F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first").alias("component_id"))
    classes = members.join(firsts.hint("merge"), "root").select(F.col("node").alias("fp"), "component_id", F.lit(True).alias("linked"))
    of = distinct.join(classes.hint("merge"), "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"))
    of = materialize(spark, of, "simhash-classes")  # so that the last join reads two plain shuffles, which a hot key's rows may split
    return marked.join(of.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def hex_of(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
