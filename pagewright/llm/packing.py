"""Packing by concatenate and cut: prefix sums over token totals, then fixed windows.

Pass one tokenizes each text once and writes its ids to the shared folder, with the number of the task
and the tokens before it in that task. The totals of the tasks, one number each, give every task its
place in the whole stream. Pass two reads the ids, adds both offsets, and cuts at multiples of the
window. All windows but the last are full.

Defined results: a null or empty text is the end id alone. Repeated rows, also of one id, and null ids
are packed row by row. An empty table gives an empty result. Columns beyond doc_id and text are ignored.
A text of any length is cut into as many pieces as it takes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.common import broadcast_if, local_table, map_batches, materialize, slices, warm

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Word pieces that a worker remembers before it starts afresh.
CACHE_WORDS = 250_000


class WordTokenizer:
    """Ids of whole texts from a tokenizer whose pre-tokenizer drops white space.

    No token of such a tokenizer spans white space, so a text's ids are those of its parts between ASCII
    white space. Each different part is encoded once per worker and remembered.

    Two steps leave fewer different parts, and change no id: A-Z become a-z, which the normalizer does
    as well, and a blank is set between a Latin letter and an ASCII mark other than an apostrophe, where
    the pre-tokenizer cuts in any case. Letters that the normalizer takes apart are no part of that: behind
    U+0130 in lower case, or behind a decomposed letter, a combining mark would join the ASCII mark's run.
    Texts with combining marks are left alone, since these compose with some small letters whose capitals
    they do not compose with, and so are texts with ``<|``, which special tokens start with.
    """

    #: Latin letters up to U+024F that stay one letter, but for their case; then an ASCII mark.
    marked = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([.,%*#&$|!?;:])"
    left_alone = r"<\||\pM"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        import numpy as np

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: Whether an id ends a pre-token.
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        import numpy as np

        self.known.clear()
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.ends = 0

    def ids_of(self, parts: list[str]):
        """(ids of all parts together, number of ids of each).

        Parts of letters alone are one pre-token each, as a rule. They are encoded many at a time, and cut
        behind the ids that end a pre-token, if there are as many of those as parts.
        """
        import numpy as np

        joined = self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids if all(map(str.isalpha, parts)) else []
        ids = np.array(joined, dtype=np.uint32)
        cuts = np.flatnonzero(self.is_end[ids]) + 1
        if len(cuts) == len(parts) and len(ids) == cuts[-1]:
            return ids, np.diff(cuts, prepend=0)
        each = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array([i for x in each for i in x], dtype=np.uint32), np.array(list(map(len, each)), dtype=np.int64)

    def learn(self, parts: list[str]) -> None:
        import numpy as np

        parts = sorted(parts, key=str.isalpha)
        first = sum(not p.isalpha() for p in parts)
        runs = [parts[:first], *(parts[k : k + 500] for k in range(first, len(parts), 500))]
        ids, counts = map(np.concatenate, zip(*(self.ids_of(r) for r in runs if r), strict=True))
        if self.ends + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.ends], np.empty(2 * len(self.flat) + len(ids), dtype=np.uint32)])
        self.flat[self.ends : self.ends + len(ids)] = ids
        n = len(self.known)
        if n + len(parts) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts[: n + 1], np.zeros(2 * len(self.starts) + len(parts), dtype=np.int64)])
        self.starts[n + 1 : n + 1 + len(parts)] = self.ends + np.cumsum(counts)
        self.ends += len(ids)
        self.known.update(zip(parts, range(n, n + len(parts)), strict=True))

    def encode(self, texts):
        """(ids of all texts together, number of ids of each text) of an Arrow string array without nulls."""
        import numpy as np
        import pyarrow.compute as pc

        plain = pc.replace_substring_regex(pc.ascii_lower(texts), self.marked, r"\1 \2")
        texts = pc.if_else(pc.match_substring_regex(texts, self.left_alone), texts, plain)
        parts = pc.ascii_split_whitespace(texts)
        per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > CACHE_WORDS:
            self.reset()
        if unknown := [w for w in words if w not in self.known]:
            self.learn(unknown)
        which = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        if not len(words):
            return np.empty(0, dtype=np.uint32), np.zeros(len(per_text), dtype=np.int64)
        at = which[coded.indices.to_numpy(zero_copy_only=False)]
        begin = self.starts[at]
        lengths = self.starts[at + 1] - begin
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.arange(before[-1]) + np.repeat(begin - before[:-1], lengths)]
        text_ends = before[np.cumsum(per_text)]
        return ids, np.diff(text_ends, prepend=0)


def tokenizer_of(path: str) -> WordTokenizer:
    """The worker's tokenizer, which later tasks of the same worker find warm."""
    return warm("packing", path, lambda: WordTokenizer(path))


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        tokenizer, before, part = tokenizer_of(path), 0, TaskContext.get().partitionId()
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, counts = tokenizer.encode(pc.fill_null(batch.column("text"), ""))
                n = counts + 1
                ends = np.cumsum(n)
                out = np.full(int(ends[-1]), end_id, dtype="<u4")
                body = np.ones(len(out), dtype=bool)
                body[ends - 1] = False
                out[body] = ids
                offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
                binary = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), binary, pa.array(n), pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(before + ends - n)],
                    names=["doc_id", "ids", "n", "part", "before"],
                )
                before += int(ends[-1])

    return run


def _cut(window: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n, start = (batch.column(c).to_numpy() for c in ("n", "start"))
            ids = batch.column("ids").to_pylist()
            first, last = start // window, (start + n - 1) // window
            row = np.repeat(np.arange(len(n)), last - first + 1)
            sequence = np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[row]
            a = np.maximum(0, sequence * window - start[row])
            b = np.minimum(n[row], (sequence + 1) * window - start[row])
            pieces = [ids[r][4 * x : 4 * y] for r, x, y in zip(row.tolist(), a.tolist(), b.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(a), pa.array(b - a), pa.array(pieces, pa.binary()), pa.array(n[row]), pa.array(sequence), pa.array(start[row] + a - sequence * window)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of texts in windows of ``window`` tokens: see ``PIECES`` for the columns.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. A piece's document ids are
    those of the text without special tokens, then ``end_id``.
    """
    import pyarrow as pa

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = map_batches(rows, _tokenize(tokenizer_path, end_id), "doc_id bigint, ids binary, n bigint, part int, before bigint")
    coded = materialize(spark, coded, "packing")
    totals, at = [], 0
    for part, n in sorted(map(tuple, coded.groupBy("part").agg(F.sum("n")).collect())):  # a number for each task
        totals.append((part, at))
        at += n
    bases = local_table(spark, part=pa.array([p for p, _ in totals], pa.int32()), base=pa.array([b for _, b in totals], pa.int64()))
    placed = coded.join(broadcast_if(bases, 32 * len(totals)), "part").select("doc_id", "ids", "n", (F.col("base") + F.col("before")).alias("start"))
    return map_batches(placed, _cut(window), PIECES)
