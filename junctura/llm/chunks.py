"""Documents dealt into chunks of bounded size, each of which one Python call sees as a single byte array.

Operators that need every position of a corpus keep positions inside the chunk's task and send only packed, sorted keys to
buckets; the bucket's answers come back by chunk key.  A row of text crosses the network once for each pass, a position never.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import give_back

KEY = "__chunk"


def total_bytes(docs: DataFrame, text: str) -> int:
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text)).cast("long")), F.lit(0))).first()[0])


def with_key(docs: DataFrame, ident: str, text: str, n: int) -> DataFrame:
    """Chunk key from id and text; a document's rows with other texts may lie in other chunks."""
    return docs.withColumn(KEY, F.pmod(F.xxhash64(F.col(ident), F.col(text)), F.lit(n)).cast("int"))


def count(total: int, chunk_bytes: int) -> int:
    return max(1, math.ceil(total / chunk_bytes))


@dataclass
class Chunk:
    """A chunk's documents in (id, text) order: null texts are empty, null ids come first."""

    table: pa.Table
    ids: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


def load(table: pa.Table, ident: str, text: str) -> Chunk:
    give_back()
    order = pc.sort_indices(table, sort_keys=[(ident, "ascending"), (text, "ascending")], null_placement="at_start")
    table = table.take(order).combine_chunks()
    column = table[text].combine_chunks() if table.num_rows else pa.array([], pa.string())
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    blob = column.buffers()[2]
    data = np.frombuffer(blob, np.uint8)[offsets[0] : offsets[-1]] if blob is not None and len(column) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    ids = pc.fill_null(table[ident].cast(pa.int64()), np.iinfo(np.int64).min).to_numpy()
    return Chunk(table, ids, data, offsets[:-1], offsets[1:])


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
