"""Quality classifier by co-training.

Two logistic regressions see different views of a document. The text view has hashed words, hashed word
shapes and a few ratios, all from the whole text; the metadata view has what a crawler's record tells without
words: source, language, size, lines, and the shares of characters by kind. Each round, both are calibrated on
labelled rows kept out of training, and every document outside the labelled sample is scored by executors. Of
each class, each view takes those it is surest of: a share of all rows by rank, with calibrated probability
``sure`` at least. Histograms of all scores give the cut-off; what lies above it is the other view's
pseudo-labels, of which a bounded sample by hash joins its training rows. Both views are then fitted anew, and
the next round's share is larger. Last, the calibrated log-odds are added, less the prior that both contain: a
view that tells nothing then adds nothing.

Only what a fit reads is bounded (``Limits``): labelled rows, and pseudo-labelled rows of a view and round.

Defined results: a null or empty text has no words and is scored by its other features. Null metadata
are values of their own. Labels that are null, or whose id no document has, teach nothing; of repeated labels
of an id the largest counts, of repeated rows of a labelled id the first. With labels of a single class, or
none, every score is the share of that class, or 0.5. Rows whose scores tie at a cut-off stand or fall
together. Repeated rows and null ids are scored row by row. An empty table gives an empty result. Columns beyond
those named are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import broadcast_if, map_batches, materialize, slices, warm

WORDS, SHAPES, RATIOS = 1 << 13, 1 << 9, 6
SOURCES, LANGS, SIZES, BINS, LAYOUT = 512, 64, 32, 16, 7
#: Columns of the metadata view, and those that a row has: source, language, size, then the layout.
META, META_COLUMNS = SOURCES + LANGS + SIZES + BINS * LAYOUT, 3 + LAYOUT
CACHE_WORDS = 250_000
#: Log-odds are counted in steps of 1/64 below 32.
STEPS, MOST = 64, 32
SCALE = 1 << 30


@dataclass(frozen=True)
class Limits:
    """``labelled`` and ``fit_rows`` bound what is gathered for a fit, up to chance: rows are dealt by hash.

    In round k, a view takes of each class the surest ``k * share`` of the rows that would have it. A pseudo-label
    counts for ``weight`` of a label.
    """

    labelled: int = 3000
    fit_rows: int = 3000
    rounds: int = 2
    share: float = 0.1
    sure: float = 0.9
    weight: float = 0.25
    held_back: float = 0.25


class _Kinds(dict):
    """Letters to x or X, digits to 9, other characters to themselves, worked out once each."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        return kind


KINDS, RUN = _Kinds(), re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Letters as x or X, digits as 9, runs as one."""
    return RUN.sub(r"\1", word.translate(KINDS))


class TextView:
    """Features of a batch of texts: buckets of words and of their shapes, and the dense ratios."""

    width = WORDS + SHAPES

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        import numpy as np

        self.known: dict[str, int] = {}
        self.kinds = np.zeros((1 << 14, 3), dtype=np.int64)

    def look(self, words: list[str]):
        """(bucket of the word, bucket of its shape, letters) of each word; what was seen is remembered."""
        import numpy as np

        if len(self.known) > CACHE_WORDS:
            self.reset()
        known = self.known
        if new := [w for w in words if w not in known]:
            n = len(known)
            if n + len(new) > len(self.kinds):
                self.kinds = np.concatenate([self.kinds[:n], np.zeros((2 * len(self.kinds) + len(new), 3), dtype=np.int64)])
            own = self.kinds[n : n + len(new)]
            own[:, 0] = [zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in new]
            own[:, 1] = [WORDS + zlib.crc32(shape(w).encode("utf-8", "replace")) % SHAPES for w in new]
            own[:, 2] = list(map(len, new))
            known.update(zip(new, range(n, n + len(new)), strict=True))
        return self.kinds[np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))]

    def words(self, texts):
        """(row, word, shape) of each word, and the ratios of each text."""
        import numpy as np
        import pyarrow.compute as pc

        parts = pc.utf8_split_whitespace(texts)
        n = len(texts)
        row = np.repeat(np.arange(n), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        coded = parts.flatten().dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds = self.look(coded.dictionary.to_pylist())
        there = kinds[place]
        there, row, place = there[there[:, 2] > 0], row[there[:, 2] > 0], place[there[:, 2] > 0]
        count = np.bincount(row, minlength=n)
        distinct = np.bincount(np.unique(row * max(1, len(kinds)) + place) // max(1, len(kinds)), minlength=n)
        letters = np.bincount(row, weights=there[:, 2], minlength=n)
        size = np.maximum(1, count)
        bytes_of = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ratios = np.stack([np.log1p(count) / 10, distinct / size, np.sqrt(size) * (1 - distinct / size) / 20, letters / size / 10, (count < 20).astype(float), letters / np.maximum(1, bytes_of)], axis=1)
        return row, there[:, 0], there[:, 1], count, ratios


def text_view() -> TextView:
    """The worker's view, whose memory later tasks of the same worker find warm."""
    return warm("quality", None, TextView)


def _kinds_of_bytes():
    """For each byte: 1 line feed, 2 capital, 3 digit, 4 other ASCII mark, 5 blank, 6 part of a character beyond ASCII, else 0."""
    import numpy as np

    kinds = np.zeros(256, dtype=np.int64)
    for c in range(128):
        x = chr(c)
        kinds[c] = 1 if x == "\n" else 2 if x.isupper() else 3 if x.isdigit() else 5 if x.isspace() else 0 if x.isalpha() else 4
    kinds[128:] = 6
    return kinds


def layout(texts):
    """Of each text in an Arrow string array without nulls: its bytes, and its bytes of the seven kinds."""
    import numpy as np

    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, dtype=np.int32)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    of = np.repeat(np.arange(n, dtype=np.int64) * 8, sizes)
    return sizes, np.bincount(of + _kinds_of_bytes()[data], minlength=8 * n).reshape(n, 8)[:, :7]


def meta_columns(source, lang, texts):
    """The columns of the metadata view that are 1, for each row; all arguments are Arrow arrays."""
    import numpy as np

    def hashed(values, name: str, width: int):
        coded = values.dictionary_encode()
        codes = np.array([zlib.crc32(f"{name}={x}".encode("utf-8", "replace")) % width for x in [*coded.dictionary.to_pylist(), None]], dtype=np.int64)
        return codes[coded.indices.fill_null(len(codes) - 1).to_numpy(zero_copy_only=False)]

    bits = lambda x: np.frexp(x.astype(float))[1]  # noqa: E731  the number of binary digits
    size, kinds = layout(texts)
    lines = kinds[:, 1] + 1
    shares = [np.floor((BINS - 0.001) * np.sqrt(kinds[:, k] / np.maximum(1, size))) for k in (2, 3, 4, 5, 6)]
    own = [hashed(source, "source", SOURCES), SOURCES + hashed(lang, "lang", LANGS), SOURCES + LANGS + np.minimum(SIZES - 1, bits(size))]
    for k, x in enumerate([np.minimum(BINS - 1, bits(lines)), np.minimum(BINS - 1, bits(size // lines)), *shares]):
        own.append(SOURCES + LANGS + SIZES + BINS * k + x)
    return np.stack(own, axis=1).astype(np.int32)


class Logistic:
    """Logistic regression on sparse rows, fitted by full-batch steps that adapt to each weight."""

    def __init__(self, width: int, decay: float = 1e-4) -> None:
        import numpy as np

        self.w, self.b, self.decay = np.zeros(width), 0.0, decay

    def raw(self, x):
        import numpy as np

        row, column, value, n = x
        return np.bincount(row, weights=value * self.w[column], minlength=n) + self.b

    def fit(self, x, y, weight=None, steps: int = 80, rate: float = 0.3) -> None:
        """``weight`` of each row; 1 by default."""
        import numpy as np

        row, column, value, n = x
        weight = np.ones(n) if weight is None else weight
        weight = weight / max(1e-9, weight.sum())
        m, v, self.w, self.b = np.zeros(len(self.w) + 1), np.zeros(len(self.w) + 1), self.w * 0, 0.0
        for k in range(1, steps + 1):
            error = (1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30))) - y) * weight
            g = np.append(np.bincount(column, weights=value * error[row], minlength=len(self.w)) + self.decay * self.w, error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
            self.w -= step[:-1]
            self.b -= step[-1]


def platt(raw, y) -> tuple[float, float]:
    """Slope and offset that turn raw scores into log-odds, by Newton's method with a little damping."""
    import numpy as np

    a, b = 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g = np.array([((p - target) * raw).sum() + 1e-3 * a, (p - target).sum()])
        s = p * (1 - p)
        h = np.array([[(s * raw * raw).sum() + 1e-3, (s * raw).sum()], [(s * raw).sum(), s.sum()]]) + np.eye(2) * 1e-6
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return max(0.0, float(a)), float(b)


def _stack(rows: list, width: int):
    """Sparse rows as (row, column, value, n)."""
    import numpy as np

    row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    column = np.concatenate([np.asarray(c, dtype=np.int64) for c, _ in rows]) if rows else np.zeros(0, dtype=np.int64)
    value = np.concatenate([np.asarray(v, dtype=float) for _, v in rows]) if rows else np.zeros(0)
    return row, column, value, len(rows)


def text_rows(rows: list):
    """The text view of gathered rows of ``FEATURES``."""
    import numpy as np

    dense = TextView.width + np.arange(RATIOS)
    return _stack([(np.append(r.columns, dense), np.append(np.asarray(r.counts, dtype=float) / max(1, r.size), r.ratios)) for r in rows], TextView.width + RATIOS)


def meta_rows(rows: list):
    """The metadata view of gathered rows of ``FEATURES``."""
    import numpy as np

    return _stack([(r.meta, np.ones(META_COLUMNS)) for r in rows], META)


FEATURES = "doc_id bigint, meta array<int>, size int, columns array<int>, counts array<int>, ratios array<float>"


def _features(batches: Iterator) -> Iterator:
    """Features of both views: columns of the metadata; distinct buckets of words and shapes with their counts, number of words, ratios."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    view = text_view()
    lists = lambda sizes, values, kind: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))
    for whole in batches:
        for batch in slices(whole, "text"):
            if not (n := batch.num_rows):
                continue
            texts = pc.fill_null(batch.column("text"), "")
            row, word, shaped, count, ratios = view.words(texts)
            meta = meta_columns(batch.column("source"), batch.column("lang"), texts)
            key, found = np.unique(np.concatenate([row, row]) * view.width + np.concatenate([word, shaped]), return_counts=True)
            sizes = np.bincount(key // view.width, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), lists(np.full(n, META_COLUMNS), meta.ravel(), pa.int32()), pa.array(count, pa.int32()),
                    lists(sizes, key % view.width, pa.int32()), lists(sizes, found, pa.int32()), lists(np.full(n, RATIOS), ratios.ravel(), pa.float32()),
                ],
                names=["doc_id", "meta", "size", "columns", "counts", "ratios"],
            )


@dataclass
class Model:
    """Weights and offsets of both views, their calibration (slope and offset of the log-odds), and the log-odds of the prior.

    ``history`` tells of each fit the round, the view, the pseudo-labels that it was given by class (all of them, and
    those in its sample) and its accuracy on the labelled rows kept out.
    """

    text_w: object
    text_b: float
    meta_w: object
    meta_b: float
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float
    history: list = field(default_factory=list)

    def log_odds(self, batch) -> dict:
        """Calibrated log-odds of each view for a batch of ``FEATURES``."""
        import numpy as np

        n = batch.num_rows
        flat = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(n), batch.column("columns").value_lengths().to_numpy(zero_copy_only=False))
        both = np.bincount(row, weights=flat("counts") * self.text_w[flat("columns")], minlength=n)
        size = np.maximum(1, batch.column("size").to_numpy(zero_copy_only=False))
        text = both / size + flat("ratios").reshape(-1, RATIOS) @ self.text_w[TextView.width :] + self.text_b
        meta = self.meta_w[flat("meta").reshape(-1, META_COLUMNS)].sum(axis=1) + self.meta_b
        return {"text": self.text_scale[0] * text + self.text_scale[1], "meta": self.meta_scale[0] * meta + self.meta_scale[1]}


def steps_of(log_odds, label: int, least: float):
    """How sure of ``label`` these log-odds are, in steps; -1 below the probability ``least``."""
    import math

    import numpy as np

    own = log_odds if label else -log_odds
    return np.where(own >= math.log(least / (1 - least)), np.floor(np.clip(own, 0, MOST - 0.001) * STEPS), -1).astype(np.int64)


def _histogram(model: Model, least: float):
    """(view, label, step, n): rows of a task by how sure each view is of each label."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        counts = {(view, label): np.zeros(STEPS * MOST, dtype=np.int64) for view in ("text", "meta") for label in (0, 1)}
        for batch in batches:
            if batch.num_rows:
                for view, odds in model.log_odds(batch).items():
                    for label in (0, 1):
                        steps = steps_of(odds, label, least)
                        counts[view, label] += np.bincount(steps[steps >= 0], minlength=STEPS * MOST)
        rows = [(view, label, int(k), int(c[k])) for (view, label), c in counts.items() for k in np.flatnonzero(c)]
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["view", "label", "step", "n"])

    return run


def cut_off(counts: dict[int, int], target: float) -> tuple[int, int]:
    """(step, rows at it or above): as many of the surest steps as hold ``target`` rows at most, but the surest one in any case."""
    at, total = -1, 0
    for step in sorted(counts, reverse=True):
        if at >= 0 and total + counts[step] > target:
            break
        at, total = step, total + counts[step]
    return at, total


def _above(model: Model, least: float, cuts: dict):
    """Rows that a view is sure enough of and that the sample takes, with the view and the label; ``cuts`` has (step, bound of the hash)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            for view, odds in model.log_odds(batch).items():
                for label in (0, 1):
                    step, bound = cuts.get((view, label), (-1, 0))
                    chosen = np.flatnonzero((steps_of(odds, label, least) >= step) & (rank < bound)) if step >= 0 else ()
                    if len(chosen):
                        own = batch.take(pa.array(chosen))
                        yield pa.RecordBatch.from_arrays([pa.array([view] * len(chosen)), pa.array([label] * len(chosen), pa.int32()), *own.columns], names=["view", "label", *own.schema.names])

    return run


def _rows(docs: DataFrame) -> DataFrame:
    named = {"doc_id": "bigint", "source": "string", "lang": "string", "text": "string"}
    return docs.select(*(F.col(c).cast(t).alias(c) for c, t in named.items()))


def features_of(docs: DataFrame) -> DataFrame:
    """Both views of each row, as numbers (``FEATURES``) with rid, written once: rounds and scores read them instead of texts."""
    rows = map_batches(_rows(docs), _features, FEATURES).withColumn("rid", F.monotonically_increasing_id())
    return materialize(docs.sparkSession, rows, "cotrain-features")


def _sampled_labels(labels: DataFrame, target: str, limits: Limits) -> DataFrame:
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max(F.col(target).cast("int")) > 0).cast("int").alias("y"))
    share = min(SCALE, SCALE * limits.labelled // max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit("cotrain")), F.lit(SCALE)) < share)


def fit_features(features: DataFrame, labels: DataFrame, target: str = "quality", limits: Limits = Limits()) -> Model:
    """Co-train on a labelled sample and on all other rows; ``labels`` has doc_id and ``target`` (0 or 1)."""
    import numpy as np

    spark = features.sparkSession
    sample = materialize(spark, _sampled_labels(labels, target, limits), "cotrain-labels")
    sample = broadcast_if(sample, 32 * sample.count())
    own = features.join(sample, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("rid", "meta", "size", "columns", "counts", "ratios")).alias("row")).select("doc_id", "y", "row.*")
    labelled = sorted(own.collect(), key=lambda r: r.doc_id)
    y = np.array([float(r.y) for r in labelled])
    width = TextView.width + RATIOS
    if not len(y) or y.min() == y.max():
        odds = 0.0 if not len(y) else (30.0 if y[0] else -30.0)
        return Model(np.zeros(width), 0.0, np.zeros(META), 0.0, (0.0, odds), (0.0, odds), odds)
    back = np.array([zlib.crc32(f"back{r.doc_id}".encode()) % 1000 < 1000 * limits.held_back for r in labelled])
    if back.all() or not back.any() or len(set(y[~back])) < 2 or len(set(y[back])) < 2:
        back[:] = False
    train = [r for r, b in zip(labelled, back, strict=True) if not b]
    test, y_test = ([r for r, b in zip(labelled, back, strict=True) if b], y[back]) if back.any() else (labelled, y)
    base = float(y.mean())
    prior = float(np.log(base / (1 - base)))
    history: list[dict] = []
    seen = {"text": (text_rows, text_rows(test)), "meta": (meta_rows, meta_rows(test))}

    def fitted(taught: dict[str, list], given: dict, number: int) -> Model:
        parts = {}
        for view, (of, tested) in seen.items():
            classifier = Logistic(width) if view == "text" else Logistic(META, 1e-3)
            more = taught.get(view, [])
            weight = np.concatenate([np.ones(len(train)), np.full(len(more), limits.weight)])
            classifier.fit(of(train + more), np.concatenate([y[~back], np.array([float(r.label) for r in more])]), weight)
            raw = classifier.raw(tested)
            scale = platt(raw, y_test)
            accuracy = float(np.mean((scale[0] * raw + scale[1] > 0) == (y_test > 0)))
            history.append({"round": number, "view": view, "given": given.get(view, {}), "sampled": len(more), "accuracy": accuracy})
            parts |= {f"{view}_w": classifier.w, f"{view}_b": classifier.b, f"{view}_scale": scale}
        return Model(**parts, prior=prior, history=history)

    pool = features.join(sample, "doc_id", "left").where("y is null").drop("y").withColumn("rank", F.pmod(F.xxhash64("rid", F.lit("taught")), F.lit(SCALE)))
    n_pool = pool.count()
    other = {"text": "meta", "meta": "text"}
    model = fitted({}, {}, 0)
    for number in range(1, limits.rounds + 1 if n_pool else 1):
        counts: dict[tuple, dict[int, int]] = {}
        histogram = map_batches(pool, _histogram(model, limits.sure), "view string, label int, step int, n bigint")
        for view, label, step, n in histogram.groupBy("view", "label", "step").agg(F.sum("n")).collect():
            counts.setdefault((view, label), {})[step] = n
        cuts, given = {}, {"text": {}, "meta": {}}
        for (view, label), own in counts.items():
            part = base if label else 1 - base
            step, n = cut_off(own, number * limits.share * part * n_pool)
            cuts[view, label] = step, min(SCALE, int(SCALE * limits.fit_rows * part / n))
            given[other[view]][label] = n
        schema = "view string, label int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pool.schema.fields)
        taught: dict[str, list] = {"text": [], "meta": []}
        for r in sorted(map_batches(pool, _above(model, limits.sure, cuts), schema).collect(), key=lambda r: (r.view, r.label, r.rid)):
            taught[other[r.view]].append(r)
        model = fitted(taught, given, number)
    return model


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", limits: Limits = Limits()) -> Model:
    return fit_features(features_of(docs), labels, target, limits)


def _scored(model: Model, least: float):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        chance = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        for batch in batches:
            if batch.num_rows:
                odds = model.log_odds(batch)
                score = chance(odds["text"] + odds["meta"] - model.prior)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(chance(odds["text"])), pa.array(chance(odds["meta"])), pa.array(score), pa.array(score >= least)],
                    names=["doc_id", "p_text", "p_meta", "score", "kept"],
                )

    return run


SCORES = "doc_id bigint, p_text double, p_meta double, score double, kept boolean"


def score_features(features: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, p_text, p_meta (calibrated views), score and kept (score at ``least`` or above) of each row of features."""
    return map_batches(features, _scored(model, least), SCORES)


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The same from documents: their features are not written."""
    return map_batches(_rows(docs), lambda batches: _scored(model, least)(_features(batches)), SCORES)
