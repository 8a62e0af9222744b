"""ZIP writer that makes landed archives from tables, for round-trip checks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimlake.sources.archives import arrow_fs, list_archives, storage_options
from claimlake.sources.files import RAW_DATE_FORMAT, RAW_ENCODING

#: Rows of a CSV part at most, and parts of an archive at least (so that archives come out of even size).
PART_ROWS, PARTS = 1_000_000, 4
#: Rows of a landed archive where a table is cut into as many archives as it needs; a published sample has some millions.
ARCHIVE_ROWS = 5_000_000


def _shape(rows: int, files: int, max_rows: int | None = None) -> tuple[int, int]:
    """(archives, rows of a CSV part) for a table of ``rows`` rows."""
    archives = max(files, -(-rows // max_rows)) if max_rows else files
    return archives, min(PART_ROWS, max(1, rows // (archives * PARTS)))


def write_zip_csv(df: DataFrame, out_dir: str, stem: str, files: int | None = None,
                  encoding: str = RAW_ENCODING, date_format: str = RAW_DATE_FORMAT, escape: str = "\\",
                  max_rows: int | None = None) -> int:
    """Write ``df`` as header CSV, zipped as ``<stem>_<n>.zip``: ``files`` archives
    (as many as there are rows, if fewer), with ``max_rows`` more if they would hold
    more rows than that; without ``files`` one for each CSV part.

    Spark writes many small CSV parts by the tasks that read the rows: nothing is
    shuffled, and no task gets an archive's share of the rows.  Each archive is then
    made by one task that streams its parts into the member (a block at a time; an
    archive is one file).  Returns the number of archives.
    """
    spark = df.sparkSession
    target = out_dir.rstrip("/")
    csv_dir = f"{target}/_csv"
    archives, part_rows = _shape(df.count(), files, max_rows) if files else (0, PART_ROWS)
    (df.write.option("header", True).option("encoding", encoding).option("dateFormat", date_format).option("escape", escape)
     .option("maxRecordsPerFile", part_rows).option("compression", "gzip").mode("overwrite").csv(csv_dir))
    archives = archives or list_archives(spark, csv_dir, "part-*").count()
    storage = storage_options(spark) or None

    def zip_archives(batches):
        import io
        import shutil
        import zipfile

        import pandas as pd
        import pyarrow.fs as pafs
        from pyspark import TaskContext

        fs, root = arrow_fs(csv_dir, storage)
        parts = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.startswith("part-"))
        made = min(archives, len(parts))
        for batch in batches:
            for k in (int(i) for i in batch["id"] if i < made):
                name = f"{stem}_{k + 1}"
                out_fs, out_p = arrow_fs(f"{target}/{name}.zip", storage)
                # write under this attempt's own name, then rename: a retried or
                # speculative attempt never leaves a half-written archive behind
                ctx = TaskContext.get()
                tmp_p = f"{out_p}.attempt-{ctx.taskAttemptId() if ctx else 0}.tmp"
                with out_fs.open_output_stream(tmp_p) as dst_file, \
                        zipfile.ZipFile(dst_file, "w", zipfile.ZIP_DEFLATED) as zf, \
                        zf.open(f"{name}.csv", "w", force_zip64=True) as dst:
                    for i, part in enumerate(parts[k * len(parts) // made:(k + 1) * len(parts) // made]):
                        with io.BufferedReader(fs.open_input_stream(part), 1 << 20) as src:  # the suffix tells of gzip
                            header = src.readline()
                            if i == 0:
                                dst.write(header)
                            shutil.copyfileobj(src, dst, 1 << 20)
                out_fs.move(tmp_p, out_p)
                yield pd.DataFrame({"archive": [f"{target}/{name}.zip"]})

    return spark.range(0, archives, 1, max(1, archives)).mapInPandas(zip_archives, "archive string").count()
