"""Helpers the operators share: staged tables, row batches, shared files.

Every intermediate result goes below the folder named by
``spark.checkpoint.dir`` (see :func:`terrapipe.session.run_dir`), which the
driver and all executors see, so a lost executor costs a re-read and never a
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from terrapipe.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a later stage never recomputes what is above) and gives
    the planner real sizes to choose join strategies from.
    """
    spark = df.sparkSession
    path = run_dir(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` in each.

    A single longer value stays whole, in a batch of its own.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        begin = held = 0
        for i, n in enumerate(lengths):
            if held and held + (n or 0) > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n or 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


class PartFiles:
    """The files that one attempt of a write task puts into a shared folder.

    Names carry the partition and the attempt, so attempts never touch each
    other's files. The table that the write task returns is committed by Spark
    for one attempt of each partition; :func:`is_committed` tells a reader
    whether a file is that attempt's.
    """

    def __init__(self, folder: str, suffix: str):
        context = TaskContext.get()
        self.part, self.attempt = context.partitionId(), context.taskAttemptId()
        self.suffix, self.count = suffix, 0
        self.filesystem, self.base = pafs.FileSystem.from_uri(folder) if ":" in folder else (pafs.LocalFileSystem(), folder)

    def write(self, content: bytes) -> str:
        """Write one file whole: under a hidden name first, then moved into place. Returns its name."""
        self.filesystem.create_dir(self.base, recursive=True)
        name = f"part-{self.part:06d}-{self.attempt}-{self.count:05d}{self.suffix}"
        with self.filesystem.open_output_stream(f"{self.base}/_{name}", compression=None) as out:
            out.write(content)
        self.filesystem.move(f"{self.base}/_{name}", f"{self.base}/{name}")
        self.count += 1
        return name


def is_committed(path: str, attempts: dict[int, int]) -> bool:
    """``attempts``: the committed attempt of each partition."""
    _, part, attempt, _ = path.rsplit("/", 1)[-1].split("-")
    return attempts.get(int(part)) == int(attempt)
