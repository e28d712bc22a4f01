"""What several operators share: staging, Arrow map stages, byte-wise words and their hashes, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 1_000_000
CHUNK_BYTES = 1 << 20  # bytes of all text columns that one vectorised step works on; a longer row is a step of its own
STRETCH = 1 << 18  # bytes of a text that are scanned and hashed at a time
BATCH_BYTES = 1 << 22  # of an Arrow batch, where the session sets no limit; a longer row is a batch of its own
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """Writes to the shared folder in ``spark.checkpoint.dir`` and reads it back: later steps, and executors that
    replace lost ones, read it instead of computing it again."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """A written table of a few bytes a row, marked for broadcast where its row count allows it; else it is joined by
    shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids`` (one column); a null doc_id is in no list."""
    name = fresh(docs, "gone")
    gone = stage(ids.toDF(name).distinct())
    return docs.join(small(gone), docs["doc_id"] == F.col(name), "left_anti")


def crc32(c: str) -> Column:
    """crc32 of a number as text."""
    return F.crc32(F.col(c).cast("string").cast("binary"))


def crc32_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with smaller Arrow batches set for its session unless that sets a size itself: both ends of the pipe to
    a Python worker hold whole batches, of 64 MB each where nothing is set."""
    conf = df.sparkSession.conf
    if _LIMIT not in conf.getAll:
        conf.set(_LIMIT, str(BATCH_BYTES))
    return df


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """``mapInArrow`` with ``make()`` called once a task and its result once a batch; it returns columns by name."""
    fields = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in _parts(batch):
                out = step(part)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([_array(out[n], t) for n, t in fields], [n for n, _ in fields])
        step = batch = part = out = None
        give_back()

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    fields = [(f.name, to_arrow_type(f.dataType)) for f in _parse_datatype_string(schema).fields]
    return bounded(df).mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: workers live on beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices with at most ``CHUNK_BYTES`` in all their text columns together (one row at least)."""
    texts = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    if not texts or batch.num_rows < 2:
        yield batch
        return
    ends = np.cumsum(sum(lengths(c) for c in texts))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    column = pa.concat_arrays([column])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lengths(column: pa.Array) -> np.ndarray:
    return np.diff(utf8(column)[1])


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_BYTE = mix((_FOLD + np.uint64(1)) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, STRETCH)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), STRETCH)


def _edges(data: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places where words start and where they end; a word never runs on into the next text."""
    starts, ends, before = [], [], False
    for at in range(0, len(data), STRETCH):
        inside = ~space[data[at : at + STRETCH]]
        previous = np.empty_like(inside)
        previous[0], previous[1:] = before, inside[:-1]
        cut = np.zeros(len(inside), bool)  # a text starts here
        cut[offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(inside))] - at] = True
        starts.append(np.flatnonzero(inside & (~previous | cut)) + at)
        ends.append(np.flatnonzero(previous & (~inside | cut)) + at)
        before = inside[-1]
    if before:
        ends.append(np.array([len(data)]))
    empty = np.zeros(0, np.int64)
    return np.concatenate(starts or [empty]), np.concatenate(ends or [empty])


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial over the folded bytes of each word."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        at = start[i]
        j = int(np.searchsorted(end, at + STRETCH, "right"))
        if j == i:  # one word longer than a stretch
            for x in range(at, end[i], STRETCH):
                part = _BYTE[data[x : min(x + STRETCH, end[i])]]
                shift = np.uint64(pow(_BASE, int(x - at), 1 << 64))
                out[i : i + 1] += np.sum(part * _UP[: len(part)] * shift, keepdims=True, dtype=np.uint64)
            i += 1
            continue
        part = _BYTE[data[at : end[j - 1]]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _UP[: len(part)], out=sums[1:], dtype=np.uint64)
        s = start[i:j] - at
        out[i:j] = (sums[end[i:j] - at] - sums[s]) * _DOWN[s]
        i = j
    return out


class Words:
    """The words of a slice of texts: maximal runs without ASCII white space, A-Z folded to lower case.

    ``space`` may name other bytes that part words. Texts are scanned in stretches, so a long text needs a few times
    its size and no more. ``start`` and ``end`` are byte places in the slice, ``row`` the text's row, ``hash`` a 64-bit hash of the
    folded word (a polynomial over all its bytes), ``first`` the first word of each row and, at the end, the number.
    """

    def __init__(self, column: pa.Array, space: np.ndarray = _SPACE):
        self.data, self.offsets = utf8(column)
        self.start, self.end = _edges(self.data, self.offsets, space)
        self.row = np.searchsorted(self.offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.hash = mix(_hashes(self.data, self.start, self.end))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of every run of ``size`` words; a row with fewer words has its whole sequence as one."""
        n = len(self.hash)
        counts = np.diff(self.first)
        m = max(0, n - size + 1)
        h = np.zeros(m, np.uint64)
        for k in range(size):
            h = mix(h + self.hash[k : k + m] + np.uint64(k + 1))
        whole = self.row[:m] == self.row[size - 1 : size - 1 + m] if m else np.zeros(0, bool)
        rows, out = self.row[:m][whole], h[whole]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            extra = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                has = counts[short] > k
                extra[has] = mix(extra[has] + self.hash[self.first[short[has]] + k] + np.uint64(k + 1))
            extra = mix(extra + counts[short].astype(np.uint64) * np.uint64(_BASE))
            rows, out = np.concatenate([rows, short]), np.concatenate([out, extra])
        return rows, out

    def sets(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each row: row and hash, by row and then hash."""
        rows, h = self.shingles(size)
        order = np.lexsort((h, rows))
        rows, h = rows[order], h[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
        return rows[keep], h[keep]


def characters(data: np.ndarray) -> np.ndarray:
    """Code points before each byte place (one more place at the end)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node each can reach over the links a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def contract(links: DataFrame) -> DataFrame:
    """Links (src, dst) with those of each batch of rows replaced by a star around their smallest node."""

    def make():
        def step(batch):
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            nodes, root = union_find(a, b)
            moved = nodes != root
            return {"src": nodes[moved], "dst": root[moved]}

        return step

    return map_batches(links.select("src", "dst"), "src long, dst long", make)


def components(links: DataFrame) -> DataFrame:
    """(node, component_id) for every node of links (src, dst): the smallest node it can reach.

    Batches of links are contracted to stars first. Then parents are exchanged until every node has one parent
    which has none itself: every node keeps its smallest parent and links its other parents to that one, and takes
    over its parent's parent. Each round is written, so a round never repeats an earlier one. The nodes under one
    parent are rows of a join that Spark can split, never one group.
    """
    links = links.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    links = stage(contract(links.distinct()))
    while True:
        links = stage(contract(links.distinct()).distinct())  # src > dst
        parents = stage(links.groupBy("src").agg(F.min("dst").alias("dst"), F.count(F.lit(1)).alias("n")))
        up = parents.select(F.col("src").alias("dst"), F.col("dst").alias("top"))
        several = parents.where("n > 1").select("src", F.col("dst").alias("low"))
        jumped = stage(parents.select("src", "dst").join(up, "dst", "left").select("src", "dst", "top"))
        more = stage(
            links.join(several, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        )
        if jumped.where("top is not null").isEmpty() and more.isEmpty():
            inner = jumped.select(F.col("src").alias("node"), F.col("dst").alias("component_id"))
            roots = inner.select(F.col("component_id").alias("node"), "component_id").distinct()
            return inner.unionByName(roots)
        links = jumped.select("src", F.coalesce("top", "dst").alias("dst")).unionByName(more)
