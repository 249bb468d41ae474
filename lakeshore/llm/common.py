"""Small helpers the operators share: word splitting, fresh column names, scratch tables."""
from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.session import materialize, scratch_path, scratch_root  # noqa: F401  (re-exported)
from lakeshore.sources.tables import table  # noqa: F401

#: White space that separates words everywhere in this package: blank and \\t \\n \\v \\f \\r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Array of maximal runs of non-space characters; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def shifted(arr: Column, by: int, n: Column) -> Column:
    """``arr`` without its first ``by`` elements (``n`` = its size)."""
    return F.slice(arr, by + 1, F.greatest(n, F.lit(1)))


def once(condition: Column, row: Column) -> Column:
    """``condition`` on columns computed beside ``row`` = ``monotonically_increasing_id()``. Catalyst pushes a
    filter below the projection that computes its columns, repeating their expressions for every
    use; it leaves the projection of a row number that the filter reads where it is."""
    return condition & (row >= 0)


def byte_sizes(batch: pa.RecordBatch, *columns: str) -> np.ndarray:
    """Bytes of each row in the given string or binary columns."""
    return sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0)).astype(np.int64) for c in columns)


def sub_batches(batch: pa.RecordBatch, weight: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batch of about ``most`` in weight, one row at least."""
    part = np.cumsum(weight) // max(1, most)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def tidied(run):
    """``run`` of a ``mapInArrow``, whose worker gives its memory back at the end of the task: a worker
    lives on for tasks of other queries, and what it keeps counts against the executor."""
    def held(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
            if trim is not None:
                trim(0)
    return held


def fresh(df: DataFrame, name: str) -> str:
    """A column name the frame does not use yet (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run (once a context)."""
    context = spark.sparkContext
    if getattr(context, "_lakeshore_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    with tempfile.NamedTemporaryFile(prefix="lakeshore-", suffix=".zip", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:      # only the driver reads it, to serve it to the workers
            for source in sorted(root.rglob("*.py")):
                z.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(f.name)
    context._lakeshore_shipped = True


def parallel(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
