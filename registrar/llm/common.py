"""Shared helpers: tables, scratch space, Arrow blocks of text, word hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task works on at once; one longer text makes a block of its own.
BLOCK_BYTES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package as a zip, unless their Python path or working folder has it."""
    import os
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    root = Path(__file__).resolve().parents[2]
    paths = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if context.applicationId in _shipped or any(p and Path(p).resolve() == root for p in paths):
        return
    target = Path(tempfile.mkdtemp(prefix="registrar-")) / "registrar.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted((root / "registrar").rglob("*.py")):
            archive.write(source, source.relative_to(root))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only in local mode, as in tests, make one where it is unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            import tempfile

            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")

            folder = tempfile.mkdtemp(prefix="registrar-")
        context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder and read from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bucket(column: str, n: int) -> Column:
    """crc32 of an id's text modulo ``n``; the split between learning and held-out rows."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def text_key() -> Column:
    """What tells rows that share a doc_id apart: a hash of the text."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound once, also where it is used inside lambdas."""
    return F.transform(F.array(value), body)[0]


def set_aside(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with columns of these names renamed, to come back with ``put_back``."""
    return df.withColumnsRenamed({c: f"__own_{c}" for c in df.columns if c in names})


def put_back(df: DataFrame, columns: list[str]) -> DataFrame:
    """The original columns, in their order and with their names."""
    return df.select(*[F.col(f"__own_{c}").alias(c) if f"__own_{c}" in df.columns else F.col(c) for c in columns])


def append(
    df: DataFrame, fields: str, work: Callable[[pa.RecordBatch], dict[str, object]]
) -> DataFrame:
    """Add columns that ``work`` makes from each Arrow batch; the others pass through.

    ``fields`` is a DDL list; a column of that name that was there is replaced.
    """
    added = T._parse_datatype_string(fields)
    rest = [c for c in df.columns if c not in added.names]
    source = df.select(*[F.col(f"`{c}`") for c in df.columns])
    schema = T.StructType([df.schema[c] for c in rest] + added.fields)
    types = {f.name: _arrow_type(f.dataType) for f in added.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                made = work(batch)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
                columns += [
                    v if isinstance(v, pa.Array) else pa.array(v, types[k])
                    for k, v in ((k, made[k]) for k in types)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*rest, *types])

    return source.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def blocks(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each."""
    if batch.num_rows == 0:
        return
    _, offsets = raw_text(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def raw_text(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the offsets of the texts; a null is empty."""
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


# Hashes of 64 bits: sums of random byte values times powers of an odd number, then mixed.
_RANDOM = np.random.default_rng(20240601)
_BYTE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASES = [int(x) | 1 for x in _RANDOM.integers(1, 2**64, 2, dtype=np.uint64)]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each values[start:end]; equal ranges get equal hashes wherever they stand."""
    base = _BASES[which]
    inverse = pow(base, -1, 2**64)
    n = len(values) + 1
    total = np.zeros(n, np.uint64)
    np.cumsum(values * _power(base, n - 1), out=total[1:])
    h = (total[ends] - total[starts]) * _power(inverse, n)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[0x30:0x3A] = _WORD_BYTE[0x41:0x5B] = _WORD_BYTE[0x61:0x7B] = _WORD_BYTE[0x80:] = True
#: Bytes of words ``[^\\x20\\x09-\\x0D]+``: all but white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[0x20] = NOT_SPACE[0x09:0x0E] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased (A-Z) texts, or runs of the bytes ``of``.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``starts`` and
    ``ends`` are their places in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, of: np.ndarray = _WORD_BYTE):
        self.data = _LOWER[data]
        inside = of[data]
        at_start = inside.copy()
        at_start[1:] &= ~inside[:-1]
        at_end = inside.copy()
        at_end[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        at_start[edges] = inside[edges]
        at_end[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(at_start)
        self.ends = np.flatnonzero(at_end) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = range_hash(_BYTE[self.data], self.starts, self.ends)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``n`` words inside one text, and the windows' hashes."""
        counts = np.diff(self.first)
        last = np.repeat(self.first[1:], counts)
        at = np.arange(len(self.starts))
        at = at[at + n <= last]
        return at, range_hash(self.hashes, at, at + n, 1)

    def text(self, start: int, end: int) -> bytes:
        return b" ".join(
            self.data[s:e].tobytes() for s, e in zip(self.starts[start:end], self.ends[start:end])
        )


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each pair, on end."""
    ends = np.cumsum(counts)
    out = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    keep = counts > 0
    starts, counts, ends = starts[keep], counts[keep], ends[keep]
    if len(starts):
        out[0] = starts[0]
        out[ends[:-1]] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
