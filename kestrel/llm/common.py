"""Helpers shared by the training-data operators: lineage cuts, null-safe keys, Arrow batch plumbing."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from kestrel.session import cut_lineage, ensure_checkpoint_dir

#: One word for shingles and language models: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder of ``spark.checkpoint.dir``: later stages read the copy, so a lost executor
    repeats one stage and not the whole job."""
    return cut_lineage(df)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again. Beside the lineage this also ends the estimates of
    size that a checkpoint hands on: a chain of joins over checkpoints multiplies them up, level after level."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/written-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_safe_key(col: str | Column) -> Column:
    """A string that is equal exactly when two values are equal, NULL included (NULL joins and groups with NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def ascii_lower(col: str | Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(col: str | Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a NULL id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def refuse_clash(columns: Sequence[str], ddl: str) -> None:
    """Raise when an input column bears the name of a column that the operator adds."""
    clash = sorted({f.name for f in StructType.fromDDL(ddl).fields} & set(columns))
    if clash:
        raise ValueError(f"input already has result columns {clash}")


BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows, written out as JSON, take at most ``limit`` bytes; unchanged if not,
    so that Spark shuffles both sides (and may split skewed keys). The measuring pass reads ``df`` once."""
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


@lru_cache(maxsize=1)
def lean_memory() -> None:
    """Let a Python worker return large buffers when they are freed, not keep them for its next task: Arrow takes them from
    the C library, which maps each of a megabyte or more on its own. Once per process."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(M_MMAP_THRESHOLD, 1 << 20)
        libc.mallopt(M_TRIM_THRESHOLD, 1 << 20)
    except (AttributeError, OSError):  # not glibc
        pass


# Parameters of glibc's mallopt.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD = -1, -3


def release_memory() -> None:
    """Give what a task's Arrow buffers and Python objects have left behind back to the operating system: a worker that
    waits for its next task otherwise keeps the largest size it ever had, beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def map_arrays(
    df: DataFrame,
    inputs: Sequence[str],
    keep: Sequence[str],
    schema: str,
    make: Callable[[], Callable[..., Sequence[pa.Array]]],
    piece_bytes: int | None = None,
) -> DataFrame:
    """Apply a function of Arrow arrays to the ``inputs`` columns, in slices of about ``piece_bytes`` (``PIECE_BYTES``).

    ``make`` runs once per task and returns a function (input arrays...) -> one array per new column; the ``keep``
    columns pass through as Arrow. ``schema`` is the DDL of the new columns. What ``make`` built ends with the task.
    """
    narrow = df.select(*[F.col(c) for c in dict.fromkeys([*keep, *inputs])])
    kept = narrow.select(*keep).schema
    out_ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields], schema])
    names = [*keep, *[f.name for f in StructType.fromDDL(schema).fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        call = make()
        for batch in batches:
            for part in pieces(batch, inputs, piece_bytes or PIECE_BYTES):
                new = call(*[part.column(c) for c in inputs])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *new], names=names)
        del call
        release_memory()

    return narrow.mapInArrow(run, out_ddl)


def map_rows(
    df: DataFrame,
    inputs: Sequence[str],
    keep: Sequence[str],
    schema: str,
    make: Callable[[], Callable[..., Sequence]],
) -> DataFrame:
    """``map_arrays`` for a function of Python lists (one per input column) that returns one list per new column."""
    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]

    def make_arrays():
        call = make()
        return lambda *cols: [
            pa.array(v, type=t) for v, t in zip(call(*[c.to_pylist() for c in cols]), types, strict=True)]

    return map_arrays(df, inputs, keep, schema, make_arrays)


def joined_runs(table: pa.Array, number: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values ``table[number]`` with those from starts[i] to starts[i + 1] joined into value i."""
    flat = table.take(pa.array(number))
    ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
    return pa.Array.from_buffers(
        pa.binary(), len(starts) - 1, [None, pa.py_buffer(ends[starts].astype(np.int32)), flat.buffers()[2]])


PIECE_BYTES = 8 << 20


def pieces(batch: pa.RecordBatch, cols: Iterable[str], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``limit`` bytes of text, so Python objects for one slice stay small however
    long the texts are (a single longer text is a slice of its own)."""
    n = batch.num_rows
    if not n:
        return
    per_row = max(1, batch.nbytes // n)
    step = max(1, limit // per_row)
    for i in range(0, n, step):
        yield batch.slice(i, step)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes (it has no such function): every byte is followed by
    eight steps of the polynomial division."""
    pairs = f"list_transform(range(1, strlen({text}) * 2, 2), lambda p: ('0x' || substr(hex(encode({text})), p, 2))::bigint)"
    steps = f"flatten(list_transform({pairs}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce({steps}, lambda c, o: case when o >= 0 then xor(c, o) when c & 1 = 1 then "
            f"xor(c >> 1, 3988292384::bigint) else c >> 1 end, 4294967295::bigint), 4294967295::bigint)")
