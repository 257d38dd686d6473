"""Files that cannot be read, found before a job trips over them."""

from __future__ import annotations

import bz2
import sys
import zlib
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Executors get this helper with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Endings of compressed files whose content can be tested, and only as a whole.
PACKED = (".gz", ".bz2", ".deflate")

#: Largest compressed file that is tested; the content of a file is one cell.
MOST_BYTES = 512 << 20

_STEP = 1 << 20


def inflate_error(path: str, content: bytes) -> str | None:
    """Why a compressed file cannot be unpacked to its end; None if it can. What it
    unpacks to is dropped as it comes, a megabyte at a time."""

    def fresh():
        if path.endswith(".bz2"):
            return bz2.BZ2Decompressor()
        return zlib.decompressobj(31 if path.endswith(".gz") else 15)

    rest = content
    try:
        while rest:
            unpacker, at = fresh(), 0
            while not unpacker.eof:
                if path.endswith(".bz2"):
                    piece = b"" if not unpacker.needs_input else rest[at : at + _STEP]
                    if unpacker.needs_input and not piece:
                        return "ends too early"
                    at += len(piece)
                    unpacker.decompress(piece, _STEP)
                else:
                    left = unpacker.unconsumed_tail
                    piece = left or rest[at : at + _STEP]
                    at += 0 if left else len(piece)
                    if not piece:
                        return "ends too early"
                    unpacker.decompress(piece, _STEP)
            rest = unpacker.unused_data + rest[at:]
            rest = rest.lstrip(b"\0")  # padding behind the last member
    except (OSError, zlib.error, EOFError) as e:
        return str(e) or type(e).__name__
    return None


def unreadable_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*", most_bytes: int = MOST_BYTES
) -> DataFrame:
    """``source_file`` and ``reason`` of compressed files that cannot be unpacked to their
    end. Files are listed first; only compressed ones up to ``most_bytes`` are opened, each
    by one task. Larger ones are not tested, and one of them that is damaged still ends the
    job that reads it. Files of no bytes are no inputs and nobody's rejects."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(paths)
    )
    packed = F.lit(False)
    for ending in PACKED:
        packed = packed | F.endswith(F.col("path"), F.lit(ending))
    # a row is a file, so rows reach Python one by one and not in large Arrow batches
    test = F.udf(inflate_error, T.StringType(), useArrow=False)
    opened = listed.where(packed & (F.col("length") <= most_bytes))
    return opened.select(F.col("path").alias("source_file"), test("path", "content").alias("reason")).where("reason is not null")
