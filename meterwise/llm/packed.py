"""Whole texts on their way through shuffles and Python workers.

For shuffles that must carry them they become Zstandard-compressed binaries: a
shuffle's own block compression is made for speed; packing each text first
moves and stores about a third less. To Python they go in small batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


#: Texts that are Python objects at once.
ROWS = 256


#: Bounds of a batch of rows on its way to or from a Python worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of at most 1,000 rows (Spark's default is 10,000) and about
    8 MB (64 MB), so that workers, which all stages share, stay small whatever the texts' lengths.

    Spark reads these settings when a plan runs, so they stay set for the session; smaller ones are left.
    """
    for key, most in BATCH.items():
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:  # no bound, a larger one, or one with a unit
            spark.conf.set(key, str(most))


def pack_texts(texts: pa.Array) -> pa.Array:
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    out = []
    for at in range(0, len(texts), ROWS):
        out += [None if t is None else packer.compress(t.encode()) for t in texts.slice(at, ROWS).to_pylist()]
    return pa.array(out, pa.binary())


def unpack_texts(packed: pa.Array) -> Iterator[str | None]:
    import zstandard

    reader = zstandard.ZstdDecompressor()
    for at in range(len(packed)):
        z = packed[at].as_py()
        yield None if z is None else reader.decompress(z).decode()


def packed(text: Column) -> Column:
    """The packed form of a text column (null stays null)."""
    return F.arrow_udf(pack_texts, "binary")(text)
