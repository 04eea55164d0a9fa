"""What the text operators share: Arrow columns over whole texts, and the hold-out rule."""

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that an operator works on at a time inside a task.
SLICE_BYTES = 4 << 20
#: Rows in an Arrow batch between Spark and Python: bounds the memory of a task with long texts.
ARROW_ROWS = 256


def bounded_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch to ARROW_ROWS if the session has more."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def give_back() -> None:
    """Return freed memory to the system. Spark keeps a Python worker for later tasks, and with it what it holds."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of a string array of about SLICE_BYTES; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(texts), 0)
    sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
        yield texts.slice(start, end - start)
        start = end


def raw(texts: pa.Array) -> list[bytes | None]:
    """The texts as UTF-8 bytes. ``bytes.split()`` then parts them at exactly the ASCII white space."""
    return texts.cast(pa.binary()).to_pylist()


def text_column(work: Callable[[], Callable[[pa.Array], pa.Array]], schema: str, arrow_type: pa.DataType):
    """A column function over a text column. ``work()`` runs once in each task; what it returns
    turns a part of the texts into an array of ``arrow_type``. Other columns stay in the JVM."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        do = work()
        for batch in batches:
            parts = [do(part) for part in slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=arrow_type)
        del do
        give_back()

    return F.arrow_udf(run, schema)


def struct_array(**columns: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def unit_hash(*columns: Column | str, seed: int = 0) -> Column:
    """A reproducible number in [0, 1) for each row, from the values of the columns."""
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
