"""Arrow batches in Python workers: text as bytes, words as hashes, without a Python loop per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import shelfledger.llm

# Functions travel with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(shelfledger.llm)

#: A worker looks at no more text than this at once; a single longer text stands alone.
BATCH_BYTES = 1 << 20
#: Rows that travel to a worker at once. Spark's own 10,000 would be gigabytes of long texts.
BATCH_ROWS = 256
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: True for the bytes between words.
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[32, 9, 10, 11, 12, 13]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and where each starts; a null text is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(array.buffers()[1], dtype=np.int64)[
        array.offset:array.offset + len(array) + 1
    ]
    data = np.frombuffer(array.buffers()[2] or b"", dtype=np.uint8)[ends[0]:ends[-1]]
    return data, ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the texts of one are BATCH_BYTES together, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + BATCH_BYTES, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Makes the session send rows to workers in small batches, unless it does already."""
    if not 0 < int(spark.conf.get(_ROWS)) <= rows:
        spark.conf.set(_ROWS, str(rows))


def map_texts(
    docs: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Applies ``work`` to slices of the rows, each with a bounded amount of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            yield work(batch)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values: every input bit changes about half of the output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    steps = np.full(max(n, 1), np.uint64(base), dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_ODD = 0xD6E8FEB86659FD93
_INVERSE = pow(_ODD, -1, 1 << 64)


def runs_of(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each run of bytes that are ``inside`` begins and stops, and its document, for texts
    laid on end; no run goes across the start of a text."""
    n = len(inside)
    none = np.zeros(0, dtype=np.int64)
    if not n:
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = starts[1:-1][starts[1:-1] < n]  # a text's start is a run's start
    first[edges] = inside[edges]
    begin = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    stop = np.flatnonzero(last) + 1
    return begin, stop, np.searchsorted(starts, begin, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the document of each, for texts laid on end.

    A word's hash is a polynomial in its bytes: the difference of two running sums, shifted
    back to place 0 and then spread. The same word hashes the same wherever it stands.
    """
    n = len(data)
    begin, stop, doc = runs_of(~IS_BLANK[data], starts)
    if not len(begin):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * _powers(n, _ODD), out=sums[1:])
        h = (sums[stop] - sums[begin]) * _powers(n, _INVERSE)[begin]
        h = mixed(h ^ ((stop - begin).astype(np.uint64) * _BASE))
    return h, doc


def shingle_hashes(
    words: np.ndarray, doc: np.ndarray, n_docs: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words: their hashes sorted within each document, and
    where each document starts. A document with fewer words has its whole sequence as one."""
    count = np.bincount(doc, minlength=n_docs)
    h = mixed(words ^ _BASE)
    with np.errstate(over="ignore"):
        for k in range(1, width):
            h = h[:-1] if len(h) else h
            h = mixed(h * np.uint64(_ODD) + words[k:k + len(h)])
    full = (
        doc[:len(h)] == doc[width - 1:width - 1 + len(h)] if len(h) else np.zeros(0, dtype=bool)
    )
    short = np.flatnonzero((count > 0) & (count < width))
    places = np.concatenate([[0], np.cumsum(count)])
    extra = np.zeros(len(short), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i, d in enumerate(short):
            x = np.uint64(count[d])
            for w in words[places[d]:places[d + 1]]:
                x = mixed(np.array([x * np.uint64(_ODD) + w], dtype=np.uint64))[0]
            extra[i] = x
    all_h = np.concatenate([h[full], extra])
    all_d = np.concatenate([doc[:len(h)][full], short])
    order = np.lexsort((all_h, all_d))
    all_h, all_d = all_h[order], all_d[order]
    if len(all_h):
        fresh = np.ones(len(all_h), dtype=bool)
        fresh[1:] = (all_h[1:] != all_h[:-1]) | (all_d[1:] != all_d[:-1])
        all_h, all_d = all_h[fresh], all_d[fresh]
    return all_h, np.searchsorted(all_d, np.arange(n_docs + 1))


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; other characters stay."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def list_array(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(starts.astype(np.int32)), pa.array(values).cast(kind)
    )
