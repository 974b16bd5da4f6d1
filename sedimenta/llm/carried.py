"""What goes along with operators: the caller's columns under one name, and tasks' memory back to the system."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, names: Iterable[str]) -> str:
    """``name``, made longer until it is none of ``names`` (in any case)."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def packed(names: Iterable[str], name: str = "_row") -> Column:
    """The columns ``names`` as one struct."""
    return F.struct(*[F.col(quoted(n)) for n in names]).alias(name)


def unpacked(names: Iterable[str], name: str = "_row") -> list[Column]:
    """The columns that :func:`packed` put together."""
    return [F.col(name)[n].alias(n) for n in names]


def returning(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task's function that hands the memory it no longer uses back at its end: the worker process
    goes on to other tasks, of other stages as well."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim is not None:
            trim(0)

    return wrapped
