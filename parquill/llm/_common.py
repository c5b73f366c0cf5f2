"""What the operators share: word hashing, rolling hashes, written tables, small filters."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that Python handles at a time; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Entries a worker's word cache holds before it starts anew.
CACHE_WORDS = 200_000

MASK = (1 << 64) - 1
#: Odd multipliers of two independent rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
TOP = np.uint64(MASK)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a temporary one only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.conf.get("parquill.checkpoint.dir", None)
        if not found:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            found = tempfile.mkdtemp(prefix="parquill-")
            spark.conf.set("parquill.checkpoint.dir", found)
    return found


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors.

    Deleted when the driver ends, or earlier by discard().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/parquill-{uuid.uuid4().hex}"
    at, fs = _hadoop(spark, path)
    df.write.option("compression", "zstd").parquet(path)
    fs.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a written table that nothing will read again."""
    at, fs = _hadoop(df.sparkSession, df._written_at)
    fs.delete(at, True)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0


def power_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1, x)))))


def segments(n_bytes: int, least: int = 128, each: int = 8 << 20) -> int:
    """Parts of a hash space, in proportion to the text, so that each part stays small."""
    return power_of_two(max(least, n_bytes / each))


# words and their hashes


class WordHashes(dict):
    """64-bit hashes of words as bytes; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ in UTF-8; bytes.split() parts at just these characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def spans(sizes: list[int], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) positions whose sizes have a sum of about `most`."""
    start, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def chunks(texts, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) positions whose texts have about `most` characters together."""
    return spans([len(t) if t else 0 for t in texts], most)


def release() -> None:
    """Gives freed memory back to the system: a Python worker outlives its task and waits beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """While tables are written inside, rows go to Python in smaller lots, as texts are large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, a function of batches, which gives memory back when its task ends."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def hashed(lists: list[list[bytes]], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the lists, and the offsets of the lists in them."""
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    every = [w for x in lists for w in x]
    return np.fromiter(map(cache.__getitem__, every), np.uint64, len(every)), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = power_of_two(max(n, 1 << 16))
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[base] = tuple(both)
    return tuple(p[:n] for p in _powers[base])


def rolled(h: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of every k successive numbers: the same wherever the same numbers stand."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(BASES[lane], n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * down, out=sums[1:], dtype=np.uint64)
    return mix((sums[k:] - sums[:-k]) * up[: n - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w successive numbers."""
    if len(x) < w:
        return x[:0]
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def starts_of(offsets: np.ndarray, k: int, n: int) -> np.ndarray:
    """For each of n positions, whether k successive words from it are in one document."""
    out = np.zeros(n, bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= k:
            out[a : b - k + 1] = True
    return out


# a small filter of 64-bit numbers, built by Spark


PROBES = (0, 20, 36)


def bit_filter(df: DataFrame, column: str, n: int, most_bits: int = 1 << 27) -> np.ndarray:
    """A Bloom filter of a column of scattered longs as 64-bit words, of at most `most_bits` bits (16 MB).

    n is the number of rows. The rows it stands for are never brought to the driver. Once it is
    full it lets more through; callers use it to spare work only, never to decide.
    """
    bits = min(most_bits, power_of_two(max(1 << 16, 12 * n)))
    at = "array(" + ", ".join(f"shiftrightunsigned({column}, {s}) & {bits - 1}L" for s in PROBES) + ")"
    rows = (
        df.select(F.explode(F.expr(at)).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out


def in_filter(words: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of the unsigned numbers may be in the filter."""
    mask = np.uint64(len(words) * 64 - 1)
    out = np.ones(len(x), bool)
    for s in PROBES:
        p = (x >> np.uint64(s)) & mask
        out &= (words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)).astype(np.int64)) & 1 == 1
    return out


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, so that extra ones with clashing names do no harm."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
