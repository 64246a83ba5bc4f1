"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point alone. A letter trigram is the
product of its letters' vectors, rolled by two, one and no places, so that order counts; words have a
blank at both ends. A document is the sum of its trigrams' vectors. A language's prototype is the sum of
its documents' vectors, each scaled to length one. The prediction is the prototype of largest cosine,
the score that cosine (0 if negative).

Prototypes are fitted on a bounded sample: about ``train_rows`` documents for each language, those of
smallest hash of id. Every document is predicted from its whole text.

Defined results: a text that is null, empty or without letters gives ``und`` and score 0, and so does
every text if nothing was learned. Ties go to the language that sorts first. Repeated rows are predicted
row by row, and each teaches as often as it stands in the sample. An empty table gives an empty result. Columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import broadcast_if, map_batches, slices, warm

DIMENSIONS = 1024
SEED = 7
#: Characters of one numpy pass over a batch.
SLICE_BYTES = 1 << 19
#: Up to this many different letters, trigrams are counted in a table; above, by sorting.
TABLE_LETTERS = 160
#: Different trigrams that are bound at once, and prototypes that a batch is compared with at once: a vector each.
GRAMS, PROTOTYPES = 2048, 2048
#: Texts whose counts are one matrix.
TEXTS = 512
#: Languages whose sums a task holds before it hands them on.
HELD = 512


class Profiler:
    """Document vectors of a batch of texts."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        import numpy as np

        self.dimensions = dimensions
        self.letter = np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), dtype=np.int32, count=0x110000)
        self.drawn: dict[int, object] = {}

    def vector(self, letter: int):
        import numpy as np

        if letter not in self.drawn:
            if len(self.drawn) > 8192:
                self.drawn.clear()
            self.drawn[letter] = np.random.default_rng([SEED, letter]).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1
        return self.drawn[letter]

    def trigrams(self, a, b, c):
        """The bound vectors of trigrams, given as letters."""
        import numpy as np

        letters, at = np.unique(np.concatenate([a, b, c]), return_inverse=True)
        one, (x, y, z) = np.stack([self.vector(int(v)) for v in letters]), np.split(at, 3)
        return np.roll(one, 2, axis=1)[x] * np.roll(one, 1, axis=1)[y] * one[z]

    def vectors(self, texts: list[str]):
        """(vectors of unit length, whether there is a letter) for each text.

        Trigrams are bound some at a time, so that a text of many different ones takes no more memory. Counts are
        whole numbers, and so are their sums: the order of addition changes nothing below 2**24.
        """
        import numpy as np

        low = [t.lower() for t in texts]
        points = self.letter[np.frombuffer(" ".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        lengths = np.fromiter(map(len, low), dtype=np.int64, count=len(low)) + 1
        doc = np.repeat(np.arange(len(low)), lengths)[: len(points)]
        points = np.concatenate([[0], points, [0]])
        doc = np.concatenate([[0], doc, [len(low) - 1]]) if len(low) else doc
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
        points, doc = points[keep], doc[keep]
        middle = np.flatnonzero(points[1:-1]) + 1
        out, some = np.zeros((len(texts), self.dimensions), dtype=np.float32), np.zeros(len(texts), dtype=bool)
        if not len(middle):
            return out, some
        letters, small = self._places(points)
        a, b, c, owner = small[middle - 1], small[middle], small[middle + 1], doc[middle]
        some[np.unique(owner)] = True
        k = len(letters)
        code = (a.astype(np.int64) * k + b) * k + c
        if k <= TABLE_LETTERS:
            present = np.zeros(k**3, dtype=np.int32)
            present[code] = 1
            grams = np.flatnonzero(present)
            present[grams] = np.arange(len(grams))
            code = present[code]
        else:
            grams, code = np.unique(code, return_inverse=True)
        first = np.searchsorted(owner, np.arange(len(texts) + 1))
        counted = []  # of each text: its trigrams in order, with their counts
        for i in np.flatnonzero(some).tolist():
            mine = code[first[i] : first[i + 1]]
            if 8 * len(mine) < len(grams):
                there, count = np.unique(mine, return_counts=True)
            else:
                count = np.bincount(mine)
                there = np.flatnonzero(count)
                count = count[there]
            counted.append((i, there, count.astype(np.float32)))
        for lo in range(0, len(grams), GRAMS):
            own = grams[lo : lo + GRAMS]
            bound = self.trigrams(letters[own // (k * k)], letters[own // k % k], letters[own % k]).astype(np.float32)
            here = [(i, there[x:y] - lo, count[x:y]) for i, there, count in counted for x, y in [np.searchsorted(there, (lo, lo + GRAMS)) if len(grams) > GRAMS else (0, len(there))] if y > x]
            for d in range(0, len(here), TEXTS):
                self._add(out, here[d : d + TEXTS], bound)
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        return out, some

    @staticmethod
    def _add(out, here: list, bound) -> None:
        """Add to ``out`` what each text has of the ``bound`` trigrams: as one product of matrices, or row by row if few are there."""
        import numpy as np

        if 16 * sum(len(there) for _, there, _ in here) > len(here) * len(bound):
            counts = np.zeros((len(here), len(bound)), dtype=np.float32)
            for row, (_, there, count) in zip(counts, here, strict=True):
                row[there] = count
            out[[i for i, _, _ in here]] += counts @ bound
        else:
            for i, there, count in here:
                out[i] += count @ bound[there]

    @staticmethod
    def _places(points):
        import numpy as np

        seen = np.zeros(int(points.max()) + 1, dtype=np.int32)
        seen[points] = 1
        letters = np.flatnonzero(seen)
        seen[letters] = np.arange(len(letters), dtype=np.int32)
        return letters, seen[points]


def profiler_of(dimensions: int) -> Profiler:
    """The worker's profiler, which later tasks of the same worker find ready."""
    return warm("language", dimensions, lambda: Profiler(dimensions))


def _bundle(dimensions: int):
    """Sums of vectors by language; a task hands on what it holds when it has met many languages."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        profiler, sums = profiler_of(dimensions), {}
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "bundle"])
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                vectors, some = profiler.vectors(batch.column("text").to_pylist())
                langs = np.array(batch.column("lang").to_pylist(), dtype=object)
                for lang in sorted(set(langs[some])):
                    sums[lang] = sums.get(lang, 0) + vectors[some & (langs == lang)].sum(axis=0, dtype=np.float64)
                    if len(sums) >= HELD:
                        yield rows()
                        sums.clear()
        yield rows()

    return run


def fit_prototypes(docs: DataFrame, train_rows: int = 4000, dimensions: int = DIMENSIONS):
    """(languages, prototypes of unit length) from columns doc_id, text, lang; rows with a null among them teach nothing.

    The sample holds about ``train_rows`` rows for each language (all, if it has fewer). The model that the
    driver gathers is one vector for each language, however many there are; sums of tasks are added by executors.
    """
    import numpy as np

    known = docs.where("doc_id is not null and text is not null and lang is not null").withColumn("lang", F.col("lang").cast("string"))
    scale = 1 << 30
    sizes = known.groupBy("lang").count()
    n_bytes = sizes.agg(F.coalesce(F.sum(F.octet_length("lang") + 32), F.lit(0))).first()[0]
    if not n_bytes:
        return [], np.zeros((0, dimensions), dtype=np.float32)
    shares = sizes.select("lang", F.least(F.lit(scale), F.expr(f"{scale * train_rows}L div count")).alias("__share"))
    chosen = known.select("doc_id", "text", "lang").join(broadcast_if(shares, n_bytes), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(scale)) < F.col("__share"))
    bundles = map_batches(chosen.select("text", "lang"), _bundle(dimensions), "lang string, bundle array<double>")
    added = bundles.select("lang", F.posexplode("bundle").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    whole = added.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda p: p["x"]).alias("bundle"))
    sums = {lang: np.asarray(bundle) for lang, bundle in sorted(map(tuple, whole.collect()))}
    langs = [lang for lang, v in sums.items() if np.linalg.norm(v) > 0]
    return langs, np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs], dtype=np.float32).reshape(len(langs), dimensions)


def nearest(vectors, prototypes):
    """(place of the prototype of largest cosine, the first of equals; that cosine) of each vector."""
    import numpy as np

    best, score = np.zeros(len(vectors), dtype=np.int64), np.full(len(vectors), -np.inf, dtype=np.float32)
    for lo in range(0, len(prototypes), PROTOTYPES):
        near = vectors @ prototypes[lo : lo + PROTOTYPES].T
        at = near.argmax(axis=1)
        own = near[np.arange(len(near)), at]
        best, score = np.where(own > score, lo + at, best), np.maximum(own, score)
    return best, score


def _predict(langs: list[str], prototypes):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        profiler = profiler_of(prototypes.shape[1])
        names = np.array([*langs, "und"], dtype=object)
        for whole in batches:
            for batch in slices(whole, "__text", SLICE_BYTES):
                vectors, some = profiler.vectors(pc.fill_null(batch.column("__text"), "").to_pylist())
                if len(langs):
                    best, score = nearest(vectors, prototypes)
                    best, score = np.where(some, best, len(langs)), np.where(some, np.clip(score, 0, 1), 0)
                else:
                    best, score = np.zeros(len(some), dtype=np.int64), np.zeros(len(some))
                kept = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "__text"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names[best].tolist(), pa.string()), pa.array(score.astype(np.float64))], names=[*(x for x in batch.schema.names if x != "__text"), "lang_pred", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, langs: list[str], prototypes, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with held_out, lang_pred and score of each row, from its text alone.

    Kept columns of these three names are replaced.
    """
    rows = docs.select(*(c for c in keep if c not in ("held_out", "lang_pred", "score")), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, _predict(langs, prototypes), f"{schema}, lang_pred string, score double")
