"""Folder trees and unsigned-integer files derived from existing tables.

The sanitiser and the folder ingest act on file layouts, so their checks
need layouts built from real tables.  Folders are written by Spark.  Spark
has no unsigned types, so UINT64 columns (what the sanitiser exists for) are
written by each task with pyarrow from its own Arrow batches; every task
writes one file named after its partition, so a retried task replaces its
file instead of adding one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_folders(folders: dict[str, DataFrame], root: str) -> str:
    """Write each frame to ``root/<folder>`` (folder may contain '/'), one
    file per input partition."""
    for rel, df in folders.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{rel}")
    return root


def write_uint64(df: DataFrame, out_dir: str, uint64_cols: list[str],
                 required: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Write ``df`` under ``out_dir`` with ``uint64_cols`` stored as Parquet
    UINT64 (values must be non-negative integers).  ``required``: those of them
    that are stored as required, with the metadata of the field.  Returns a frame of the
    written paths and row counts (evaluate it to perform the write)."""
    target = out_dir.rstrip("/")
    cols, required = list(uint64_cols), dict(required or {})

    def write(batches):
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark import TaskContext

        def retyped(batch):
            table = pa.Table.from_batches([batch])
            for c in cols:
                i = table.schema.get_field_index(c)
                kind = pa.field(c, pa.uint64(), nullable=c not in required, metadata=required.get(c))
                table = table.set_column(i, kind, table.column(i).cast(pa.uint64()))
            return table

        name = f"part-{TaskContext.get().partitionId():05d}.parquet"
        if target.startswith("file:"):
            filesystem, base = fs.LocalFileSystem(), target[5:].lstrip("/")
            base = "/" + base
        else:
            filesystem, base = fs.FileSystem.from_uri(target)
        filesystem.create_dir(base, recursive=True)
        tmp = f"{base}/.{name}.{uuid.uuid4().hex}.tmp"
        rows, writer = 0, None
        for batch in batches:  # one row group each, never the whole partition
            table = retyped(batch)
            writer = writer or pq.ParquetWriter(tmp, table.schema, filesystem=filesystem)
            writer.write_table(table)
            rows += table.num_rows
        if writer is None:
            return
        writer.close()
        filesystem.move(tmp, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"path": [f"{base}/{name}"],
                                          "rows": [rows]},
                                         schema=pa.schema([("path", pa.string()),
                                                           ("rows", pa.int64())]))

    return df.mapInArrow(write, "path string, rows bigint")


def epoch_micros(ts_col: str) -> F.Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column (UTC)."""
    return F.unix_micros(F.col(ts_col).cast("timestamp"))
