"""Array helpers that the corpus operators share: words, hashes and shingles of Arrow batches.

All work is done on the UTF-8 bytes of a few megabytes of whole texts at a time; a text is never
cut, so memory is bounded by the chunk size or by the longest single text.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
#: letters, digits and every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_K = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once, unless PYTHONPATH or the working folder has it."""
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    sc = spark.sparkContext
    if root in {Path(p).resolve() for p in known} or not root.is_dir() or getattr(sc, "_tidelog_shipped", False):
        return
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="spark-"), "tidelog"), "zip", root, "tidelog"))
    sc._tidelog_shipped = True


def tuned(spark: SparkSession) -> SparkSession:
    """Bounds the Arrow batches that Python workers get, by rows and by bytes."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names; only a local session may lack it, as tests do, and gets a new one."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        given = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", given)
    return given


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, CHUNK_BYTES + 1)
        for k, p in enumerate((_P, _P_INV)):
            x = np.full(m, p, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string or binary array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        width = np.int64
    else:
        width = np.int32
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], width)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    data, off = buffers(arr)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values (by sorting, which is faster here than ``np.unique``'s hashing)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def mix(z: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (splitmix's last steps)."""
    z = z ^ (z >> np.uint64(30))
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which any span's hash follows; see ``span_hash``."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * _power(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * _power(len(prefix))[1][start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``table`` bytes, and the n + 1 borders of each text's words in them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = table[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, off)


def windows(hashes: np.ndarray, border: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k words in a row within one text, and the first word's index of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n] * _K[0]
    for j in range(1, k):
        out += hashes[j : n + j] * _K[j]
    whole = np.ones(n, bool)
    for b in np.unique(border[1:-1]):
        whole[max(0, b - k + 1) : b] = False
    at = np.flatnonzero(whole)
    return mix(out[at]), at


def doc_of(border: np.ndarray, n: int) -> np.ndarray:
    """The text of each of the n words (or of what else ``border`` divides)."""
    return np.repeat(np.arange(len(border) - 1), np.diff(border))[:n]


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between the borders."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def sum_vectors(rows: DataFrame, partitions: int) -> DataFrame:
    """Adds (slice, blob of int64) rows by slice: the blobs stream through, one sum of each slice is held."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.frombuffer(blob.as_buffer(), np.int64)
                total[s] = total[s] + x if s in total else x.copy()
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["slice", "blob"])

    return rows.repartition(partitions, "slice").mapInArrow(add, "slice int, blob binary")
