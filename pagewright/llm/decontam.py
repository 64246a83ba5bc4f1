"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Every passage of every document is a query. Passages are windows of terms that overlap by half and are
at least twice as long as the longest item, so an item that stands in a text stands whole in a passage.
Impacts are BM25 weights divided by what the item scores against itself, so a score is the covered share
of an item, and one threshold fits all items. All items above it are retrieved, then verified: shared
five-term shingles of the item, and terms of its question and its answer (its last sentence).

Block-max WAND skips by upper bounds. Its first bound, whether any item can reach the threshold at all,
is taken for many passages at once: each item has essential terms, and the others together are worth
less than ``others``; a passage that lacks ``threshold - others`` in essential terms of every item is
done. The rest go through posting lists cut into blocks with their maximal impacts. Nothing is capped:
each document is read whole, and no passage above the threshold is missed.

Terms are words in lower case without anything but letters and digits; words without either are left out.
An item of fewer than five terms ("Yes.") is no evidence inside a longer text: it is found only in a text
whose terms are the item's, one for one.

Defined results: a null or empty text has no leaks. Items that are null or without terms are ignored;
repeated items are found under each of their ids. Repeated rows and null ids of documents keep a row
each. An empty table gives an empty result, an empty benchmark no leaks. All columns of the documents
pass through, but for one named item_ids, which the result replaces.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pagewright.llm.common import broadcast_if, local_table, map_batches, materialize, slices, warm

K1, B = 1.2, 0.75
POSTING_BLOCK = 16
SHINGLE, SHARED = 5, 0.8
#: Bytes of items that one index holds, at about ten bytes of memory each; a larger benchmark takes a pass for each index.
INDEX_BYTES = 8 << 20
#: Words that a worker remembers before it starts afresh.
CACHE_WORDS = 250_000

JUNK = re.compile(r"[\W_]+")


def term_of(word: str) -> str:
    low = word.lower()
    return low if low.isalnum() else JUNK.sub("", low)


def terms_of(text: str) -> list[str]:
    return [t for w in text.split() if (t := term_of(w))]


def shingles(terms: Iterable[int], width: int) -> set[tuple[int, ...]]:
    terms = list(terms)
    return {tuple(terms[i : i + width]) for i in range(len(terms) - width + 1)}


class Item:
    """An item's terms as numbers; the last ``answer`` of them are its answer."""

    __slots__ = ("answer", "item_id", "terms")

    def __init__(self, item_id: int, text: str, ids: dict[str, int]) -> None:
        sentences = re.split(r"(?<=[.!?])\s+", text.strip())
        self.item_id, self.terms = item_id, array("i", (ids.setdefault(x, len(ids)) for x in terms_of(text)))
        self.answer = len(terms_of(sentences[-1])) if len(sentences) > 1 else 0

    def stands_in(self, passage: list[int]) -> bool:
        """Whether the passage shares enough shingles of the item, and terms of its question and its answer."""
        there, own = set(passage), shingles(self.terms, SHINGLE)
        cut = len(self.terms) - self.answer
        question, answer = set(self.terms[:cut] or self.terms), set(self.terms[cut:])
        return (
            len(own & shingles(passage, SHINGLE)) >= SHARED * len(own)
            and 2 * len(question & there) >= len(question)
            and 2 * len(answer & there) >= len(answer)
        )


@dataclass(frozen=True)
class Whole:
    """What an index that holds a part of the items must know of all of them: items with terms, their terms in all and at most, items by term."""

    n: int
    terms: int
    longest: int
    df: tuple[tuple[str, int], ...]


class Lists:
    """Lists of (place, impact), one for each term, end to end in two arrays."""

    def __init__(self, terms, places, impacts, n_terms: int) -> None:
        import numpy as np

        order = np.argsort(terms, kind="stable")
        self.first = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=n_terms))]).astype(np.int64)
        self.place, self.impact = places[order], impacts[order]

    def __getitem__(self, term: int) -> list[tuple[int, float]]:
        a, b = self.first[term], self.first[term + 1]
        return list(zip(self.place[a:b].tolist(), self.impact[a:b].tolist(), strict=True))


class Index:
    """Posting lists by term: item places in order, impacts, and the largest impact of each block.

    Weights and the length of passages are those of the ``whole`` benchmark, by default of ``rows`` alone.
    """

    def __init__(self, rows: list[tuple[int, str]], threshold: float, others: float, whole: Whole | None = None) -> None:
        import numpy as np

        self.threshold, self.ids = threshold, {}
        found = [x for i, t in sorted(rows) if (x := Item(i, t, self.ids)).terms]
        df = array("l", bytes(8 * len(self.ids)))
        for item in found:
            for t in set(item.terms):
                df[t] += 1
        n, n_terms, longest = len(found), sum(len(x.terms) for x in found), max((len(x.terms) for x in found), default=0)
        if whole:
            n, n_terms, longest = whole.n, whole.terms, whole.longest
            for t, k in whole.df:
                if t in self.ids:
                    df[self.ids[t]] = k
        average = n_terms / max(1, n)
        self.stride = max(64, longest)
        #: Items by place, and the ids of items too short for shingles by their terms.
        self.items, self.short = [], {}
        for item in found:
            if len(item.terms) < SHINGLE:
                self.short.setdefault(tuple(item.terms), []).append(item.item_id)
            else:
                self.items.append(item)
        terms, places, impacts, needed = array("i"), array("i"), array("d"), array("b")
        self.least = np.zeros(len(self.items))
        for place, item in enumerate(self.items):
            weight = {t: math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(item.terms) / average)) for t, f in Counter(item.terms).items()}
            total, left = sum(weight.values()), 0.0
            for t, w in sorted(weight.items(), key=lambda x: (x[1], x[0])):
                few = left + w / total < others
                left += w / total if few else 0.0
                terms.append(t)
                places.append(place)
                impacts.append(w / total)
                needed.append(not few)
            self.least[place] = threshold - left - 1e-9
        terms, places, impacts, needed = np.array(terms, dtype=np.int32), np.array(places, dtype=np.int32), np.array(impacts), np.array(needed, dtype=bool)
        self.postings = Lists(terms, places, impacts, len(self.ids))
        essential = Lists(terms[needed], places[needed], impacts[needed], len(self.ids))
        self.first, self.essential_item, self.essential_impact = essential.first, essential.place, essential.impact

    def query(self, terms: list[int]) -> list[tuple[list, list, float]]:
        """For each term that is there: its postings, the last place and largest impact of each of their blocks, the largest of all."""
        out = []
        for t in terms:
            if p := self.postings[t]:
                blocks = [(p[min(k + POSTING_BLOCK, len(p)) - 1][0], max(w for _, w in p[k : k + POSTING_BLOCK])) for k in range(0, len(p), POSTING_BLOCK)]
                out.append((p, blocks, max(w for _, w in blocks)))
        return out

    def above(self, terms: list[int]) -> list[int]:
        """Places of the items that distinct ``terms`` score at the threshold or above, by block-max WAND."""
        lists = [[x[0][0][0], 0, x] for x in self.query(terms)]  # the place at hand, its position, the list
        least, end_of_all, found = self.threshold - 1e-9, len(self.items), []
        while lists:
            lists.sort(key=lambda x: x[0])
            bound, pivot = 0.0, -1
            for k, (_, _, x) in enumerate(lists):
                bound += x[2]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                break
            at = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == at:
                pivot += 1
            bound, end = 0.0, end_of_all
            for _, k, (_, blocks, _) in lists[: pivot + 1]:  # the blocks in which the pivot would stand
                b = k // POSTING_BLOCK
                while b < len(blocks) and blocks[b][0] < at:
                    b += 1
                if b < len(blocks):
                    bound += blocks[b][1]
                    end = min(end, blocks[b][0] + 1)
            if bound >= least:
                if lists[0][0] == at:
                    if sum(x[0][k][1] for _, k, x in lists[: pivot + 1]) >= least:
                        found.append(at)
                goal = at + 1 if lists[0][0] == at else at
            else:
                goal = max(at + 1, min(end, lists[pivot + 1][0] if pivot + 1 < len(lists) else end_of_all))
            for x in lists[: pivot + 1]:
                posting = x[2][0]
                while x[1] < len(posting) and posting[x[1]][0] < goal:
                    x[1] += 1
                x[0] = posting[x[1]][0] if x[1] < len(posting) else end_of_all
            lists = [x for x in lists if x[0] < end_of_all]
        return found

    def verified(self, place: int, passage: list[int]) -> bool:
        return self.items[place].stands_in(passage)


class Matcher:
    """Finds the leaked items of a batch of texts."""

    def __init__(self, index: Index) -> None:
        self.index, self.known = index, {}

    def term_ids(self, words: list[str]):
        """Term numbers: -1 for a term of no item, -2 for no term."""
        import numpy as np

        known, ids = self.known, self.index.ids
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = ids.get(t, -1) if (t := term_of(w)) else -2
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def leaks(self, texts) -> dict[int, list[int]]:
        """Item ids by place of the text in an Arrow string array without nulls."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        index = self.index
        if not (index.items or index.short) or not len(texts):
            return {}
        parts = pc.utf8_split_whitespace(texts)
        doc = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        coded = parts.flatten().dictionary_encode()
        term = self.term_ids(coded.dictionary.to_pylist())
        if not len(term):
            return {}
        term = term[coded.indices.to_numpy(zero_copy_only=False)]
        doc, term = doc[term != -2], term[term != -2]
        if not len(term):
            return {}
        begin = np.searchsorted(doc, np.arange(len(texts)))
        out: dict[int, set[int]] = {}
        if index.short:
            n_of = np.bincount(doc, minlength=len(texts))
            for d in np.flatnonzero((n_of > 0) & (n_of < SHINGLE)).tolist():
                if ids := index.short.get(tuple(term[begin[d] : begin[d] + n_of[d]].tolist())):
                    out[d] = set(ids)
        if not index.items:
            return {d: sorted(x) for d, x in out.items()}
        half = (np.arange(len(term)) - begin[doc]) // index.stride
        halves = np.bincount(doc, minlength=len(texts))
        halves = -(-halves // index.stride)
        base = np.cumsum(halves) - halves
        has = np.flatnonzero((term >= 0) & (index.first[term + 1] > index.first[term]))
        # A term counts once in each of the two passages that it lies in: the one that starts with its half, and the one before.
        n_terms = len(index.ids)
        now = (base[doc[has]] + half[has]) * n_terms + term[has]
        pairs = np.unique(np.concatenate([now, now[half[has] > 0] - n_terms]))
        passage, t = pairs // n_terms, pairs % n_terms
        sizes = index.first[t + 1] - index.first[t]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(index.first[t], sizes)
        key, inverse = np.unique(np.repeat(passage, sizes) * len(index.items) + index.essential_item[at], return_inverse=True)
        reached = np.bincount(inverse, weights=index.essential_impact[at], minlength=len(key)) >= index.least[key % len(index.items)]
        of = np.repeat(np.arange(len(texts)), halves)
        for p in np.unique(key[reached] // len(index.items)).tolist():
            d = int(of[p])
            a = int(begin[d]) + (p - int(base[d])) * index.stride
            end = int(begin[d + 1]) if d + 1 < len(texts) else len(term)
            own = term[a : min(end, a + 2 * index.stride)].tolist()
            for place in index.above(sorted({x for x in own if x >= 0})):
                if index.verified(place, own):
                    out.setdefault(d, set()).add(index.items[place].item_id)
        return {d: sorted(x) for d, x in out.items()}


def matcher_of(rows: list[tuple[int, str]], threshold: float, others: float, whole: Whole | None = None) -> Matcher:
    """The worker's matcher for these items, whose memory later tasks of the same worker find warm."""
    return warm("decontamination", hash((tuple(rows), threshold, others, whole)), lambda: Matcher(Index(rows, threshold, others, whole)))


def _match(rows: list[tuple[int, str]], threshold: float, others: float):
    """Batches with item_ids for each row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        matcher = matcher_of(rows, threshold, others)
        for full in batches:
            for batch in slices(full, "text"):
                found = matcher.leaks(pc.fill_null(batch.column("text"), ""))
                items = pa.array([found.get(i, []) for i in range(batch.num_rows)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, items], names=[*batch.schema.names, "item_ids"])

    return run


def _hits(rows: list[tuple[int, str]], threshold: float, others: float, whole: Whole | None):
    """(rid, item_id) of what is found."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        matcher = matcher_of(rows, threshold, others, whole)
        for full in batches:
            for batch in slices(full, "text"):
                found = matcher.leaks(pc.fill_null(batch.column("text"), ""))
                rid = batch.column("rid").to_pylist()
                pairs = [(rid[i], x) for i, ids in found.items() for x in ids]
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["rid", "item_id"])

    return run


def _count_terms(batches: Iterator) -> Iterator:
    """(part, term, null) of each distinct term of an item, and (part, null, terms) of each item with terms."""
    import pyarrow as pa

    for batch in batches:
        out = []
        for part, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if terms := terms_of(text):
                out += [(part, t, None) for t in set(terms)] + [(part, None, len(terms))]
        columns = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()), strict=True)], names=["part", "term", "n_terms"])


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, others: float = 0.3, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` (all columns) with item_ids, the sorted ids of the items that a text contains.

    ``benchmark`` has item_id and text. An index of at most about ``index_bytes`` of items is built in each worker. A
    larger benchmark is dealt by hash of item_id to several indexes, all with the weights and passages of the whole
    benchmark, so that their number changes no result. Each is a pass of its own over the texts, which writes what it
    finds: a worker holds one index at a time, and the driver one part of the items.
    """
    import pyarrow as pa

    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id is not null and text is not null")
    n_bytes = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    rows = docs.drop("item_ids").withColumn("text", F.col("text").cast("string"))
    if n_bytes <= index_bytes:
        schema = StructType([*rows.schema.fields, StructField("item_ids", ArrayType(LongType()))])
        return map_batches(rows, _match([tuple(r) for r in items.select("item_id", "text").collect()], threshold, others), schema)

    passes = -(-n_bytes // index_bytes)
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    counted = map_batches(items.select("part", "text"), _count_terms, "part bigint, term string, n_terms bigint")
    counted = materialize(spark, counted.groupBy("term").agg(F.count("*").alias("n"), F.sum("n_terms").alias("terms"), F.max("n_terms").alias("longest"), F.collect_set("part").alias("parts")), "benchmark-terms")
    total = counted.where("term is null").first()
    kept = materialize(spark, rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid")), "decontam-rows")
    texts, hits = kept.select("rid", F.col("row.text").alias("text")), local_table(spark, rid=pa.array([], pa.int64()), item_id=pa.array([], pa.int64()))
    for k in range(passes if total else 0):
        df = counted.where(F.col("term").isNotNull() & F.array_contains("parts", F.lit(k).cast("bigint"))).select("term", "n")
        whole = Whole(total.n, total.terms, total.longest, tuple(sorted(map(tuple, df.collect()))))
        own = [tuple(r) for r in items.where(F.col("part") == k).select("item_id", "text").collect()]
        hits = hits.unionByName(materialize(spark, map_batches(texts, _hits(own, threshold, others, whole), "rid bigint, item_id bigint"), "decontam-hits"))
    found = materialize(spark, hits.groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")), "decontam-found")
    found_bytes = found.agg(F.coalesce(F.sum(8 * F.size("item_ids") + 32), F.lit(0))).first()[0]
    return kept.join(broadcast_if(found, found_bytes), "rid", "left").select("row.*", F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"))
