"""Helpers the operators of this subpackage share: shared storage, bounded text chunks, word hashes, components."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK_BYTES = 1 << 20
#: Text of a block: rows that one task looks at together.
BLOCK_BYTES = 1 << 25
#: Rows of a few numbers (about 20 MB) up to which a table is broadcast.
BROADCAST_ROWS = 200_000
#: Rows of two ids that one task handles in no time.
ONE_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- shared storage


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local session (a test)
    gets a temporary folder; a cluster gets an error, because its executors could not see one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="quayside-llm-")
    spark.sparkContext.setCheckpointDir(base)
    return base


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python finds it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="quayside-")), "quayside_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, names in ((top, ["__init__.py"]), (os.path.dirname(os.path.abspath(__file__)), None)):
            for name in names or sorted(n for n in os.listdir(folder) if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.join("quayside", os.path.relpath(folder, top), name))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def carried(df: DataFrame, text_col: str) -> DataFrame:
    """(id, text) with all columns of the row as the id, for operators that pass the id through."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("id"), F.col(text_col).cast("string").alias("text"))


def with_id(df: DataFrame, columns: str) -> StructType:
    """The schema of df's column ``id`` and further columns."""
    return StructType([df.schema["id"], *StructType.fromDDL(columns).fields])


_kept: dict = {}


def free_memory() -> None:
    """Give memory that this worker no longer uses back to the system, which Python and Arrow alone would keep for reuse;
    nothing happens where the C library has no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def forget() -> None:
    """Free what an earlier step left in this worker."""
    _kept.clear()
    gc.collect()
    free_memory()


def kept_model(key, make):
    """What a worker has built for ``key``, the only thing of its kind that it keeps."""
    if key not in _kept:
        forget()
        _kept[key] = make()
        free_memory()
    return _kept[key]


def arrow_map(df: DataFrame, run, schema: str | StructType, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` for functions of this package. Workers serve one step after the other; a step that does not
    use ``kept_model`` (``keeps``) frees what an earlier one left there."""
    ship(df.sparkSession)

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memory() if keeps else forget()
        return run(batches)

    return df.mapInArrow(freed, schema)


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write to shared storage as Parquet and read back, which cuts the lineage; in one folder for each value of ``by``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame, part: str = "") -> None:
    """Delete the table that ``stored`` wrote, or the folder of one part, once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{df.stored_at}/{part}".rstrip("/"))
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps. It does so when the driver's JVM finds that nothing refers to
    them, which in a short loop of many steps would be long after their disk is needed."""
    gc.collect()
    spark._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint on shared storage; for small tables of iterative steps."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    return packed(out, out.count())


def packed(df: DataFrame, rows: int) -> DataFrame:
    """In one partition if ``rows``, its number of rows, is at most ONE_TASK, so that the steps of a small table need
    no shuffles of hundreds of nearly empty files."""
    return df.coalesce(1) if rows <= ONE_TASK else df


def small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """With a broadcast hint if it has at most BROADCAST_ROWS rows, or sums to that in ``weight`` (how many values a row
    holds); this is counted. Else Spark shuffles it."""
    size = df.count() if weight is None else df.agg(F.sum(weight + 1)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_ROWS else df


# ---------------------------------------------------------------- text in bounded chunks


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """The rows in tables of about ``most`` bytes of text (the second column), each with a number no other has. A longer
    text has a table of its own."""
    held, size = [], 0
    task, count = TaskContext.get().partitionId(), 0
    for batch in batches:
        _, offsets = text_bytes(batch.column(1))
        for lo, hi in chunks(offsets, most):
            held.append(batch.slice(lo, hi - lo))
            size += int(offsets[hi] - offsets[lo])
            if size >= most:
                yield task << 32 | count, pa.Table.from_batches(held).combine_chunks()
                held, size, count = [], 0, count + 1
    if held:
        yield task << 32 | count, pa.Table.from_batches(held).combine_chunks()


def planes(values: np.ndarray, size: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Numbers below 2 ** 32, ``size[i]`` of them for row i, as two columns of 16-bit halves, which compress well."""
    ends = np.concatenate([[0], np.cumsum(2 * size)]).astype(np.int64)

    def column(part: np.ndarray) -> pa.Array:
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(part.astype("<u2").tobytes())])

    return column(values & 0xFFFF).cast(pa.binary()), column(values >> 16).cast(pa.binary())


def from_planes(low: pa.ChunkedArray, high: pa.ChunkedArray) -> np.ndarray:
    """The numbers of all rows one after the other."""
    low, high = (np.frombuffer(b"".join(c.to_pylist()), "<u2").astype(np.int64) for c in (low, high))
    return high << 16 | low


# ---------------------------------------------------------------- word hashes

# space, tab, line feed, vertical tab, form feed, carriage return
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the public splitmix64 steps)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def constants(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_RAW_BYTE = constants(13, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, kept for chunk-sized n."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = have
    return have[:n]


def prefix_hash(data: np.ndarray, values: np.ndarray = _RAW_BYTE) -> np.ndarray:
    """Running sums H with H[j] - H[i] a polynomial of the bytes i..j-1."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; equal bytes give equal hashes wherever they stand."""
    back = powers(len(prefix), _BASE_INVERSE)
    return mix((prefix[end] - prefix[start]) * back[start] + (end - start).astype(np.uint64) * _RAW_BYTE[7])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts whose bytes are data[offsets[i]:offsets[i + 1]], offsets from 0: a hash of the word with
    A-Z lower-cased, the text's number, and the word's first and last byte (exclusive). A word is a longest run
    of bytes other than space, tab and line ends."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    inside = ~_BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text begins or ends
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return bytes_hash(_LOWER[data], start, end), doc, start, end


def bytes_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, eight bytes a step: each step mixes what it has with the next eight bytes, so that no
    sum of parts is left for structured texts to cancel."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) + _RAW_BYTE[7])
    at = np.arange(len(start))
    step = 0
    while len(at):
        left = np.minimum(size[at] - step, 8).astype(np.uint64)
        part = eight[start[at] + step] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        h[at] = mix((h[at] ^ part) * _BASE + _RAW_BYTE[8])
        step += 8
        at = at[size[at] > step]
    return h


_TERM = constants(17, 16)


def shingles(word: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of k words inside one text, and the place of its first word."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += mix(word[j : j + n] * _TERM[j])
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(h[at]), at


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) with the smallest node reachable over ``edges`` (a, b), for the nodes that have an edge.

    Alternates two star operations: each node sends its larger neighbours to its smallest neighbour, then its
    smaller ones, until nothing changes. All steps are joins and partial minima; a node with very many
    neighbours is an equi-join key that adaptive skew handling can split. Rounds grow with the logarithm of
    the longest chain. Links of a node to itself and repeated links do no harm."""
    both = edges.where("a is not null and b is not null")
    star = checkpointed(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if star.isEmpty():
        return star.select(F.col("a").alias("node"), F.col("b").alias("component"))
    rows = star.count()
    loops = star.where("a = b").select("a", "b")
    star, before = star.where("a <> b"), None
    while True:
        two = packed(star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"))), rows)
        least = two.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = two.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = checkpointed(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = checkpointed(packed(small.unionByName(least.select("a", F.col("m").alias("b"))), rows).distinct())
        now = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = star.select(F.col("b").alias("a"), "b")
    out = packed(star.unionByName(roots).unionByName(loops), rows)
    return out.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
