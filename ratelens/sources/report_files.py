"""One HTML file per report, written by the tasks that hold the rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators.delivery import report_path


# Schemes of Hadoop paths -> the name that the writer knows them by.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def writer_uri(root: str) -> str:
    """A Hadoop path as the writer of the tasks reads it; a path without a scheme is a local or mounted folder."""
    scheme, found, rest = root.partition(":")
    if not found or "/" in scheme:
        return f"file://{root}"
    if scheme == "file":
        return "file://" + "/" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def report_sink(newsletters: DataFrame, root: str) -> DataFrame:
    """Write each newsletter to '<root>/<abbr>/<year>/<Month>/<abbr>_<mm>_<year>.html'.

    Returns path and size of every file; the files are written when the result is computed. A task that runs
    twice writes the same bytes to the same place, by a rename, so no reader sees half a file. ``root`` must
    be a folder that all executors share.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(writer_uri(root))
        for pdf in batches:
            sizes = []
            for path, html in zip(pdf["path"], pdf["html"]):
                full = f"{base}/{path}"
                target.create_dir(full.rsplit("/", 1)[0], recursive=True)
                body = html.encode("utf-8")
                draft = f"{full}.{uuid.uuid4().hex}"
                with target.open_output_stream(draft) as out:
                    out.write(body)
                target.move(draft, full)
                sizes.append(len(body))
            yield pd.DataFrame({"State": pdf["State"], "path": pdf["path"], "n_bytes": sizes})

    month = F.date_format("month", "MM")
    placed = newsletters.select(
        "State", report_path(F.col("State"), month, F.date_format("month", "yyyy")).alias("path"), "html"
    )
    tasks = newsletters.sparkSession.sparkContext.defaultParallelism
    return placed.repartition(tasks, "path").mapInPandas(write, "State string, path string, n_bytes bigint")
