"""Landed payloads as a one-column DataFrame (``value``), one payload per row.

Two layouts of the landing folder:

* ``files``: one payload per file, line breaks inside allowed. A file is one
  row, so land a file per symbol and period rather than one growing file.
* ``lines``: one payload per line, any number per file. Files are splittable,
  which is the layout to use for large volumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYOUTS = ("files", "lines")


def _options(layout: str) -> dict[str, bool]:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    return {"wholetext": layout == "files", "recursiveFileLookup": True}


def read_payloads(
    spark: SparkSession, path: str | list[str], layout: str = "files"
) -> DataFrame:
    """Every payload under ``path``, all symbols at once."""
    return spark.read.text(path, **_options(layout))


def payload_stream(
    spark: SparkSession,
    path: str,
    layout: str = "files",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same rows as a stream: each file is read once, as it arrives."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path, **_options(layout))
