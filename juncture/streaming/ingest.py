"""Incremental cohort ingest: new patients only, appended by patient, aggregated once at the end."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column that takes the text of a line that does not fit the schema, or why a file can't be read.
BROKEN = "_broken_line"
#: Lines that a file's rows are sent on in.
LINES = 10_000


def pending(patients: DataFrame, processed: DataFrame) -> DataFrame:
    """Patients that are not in the processed table."""
    return patients.join(processed.select("patient"), "patient", "left_anti")


def isolate_failures(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of patients all of whose lines fit, failed patients with the number of lines that do not and the first).

    rows has patient and BROKEN, null where a line fits; a patient fails as a whole, the others are untouched.
    """
    failed = rows.filter(F.col(BROKEN).isNotNull()).groupBy("patient").agg(F.count("*").alias("broken_lines"), F.min(BROKEN).alias("example"))
    return rows.join(failed.select("patient"), "patient", "left_anti").drop(BROKEN), failed


def file_lines(files: DataFrame) -> DataFrame:
    """Files as bytes (path, content) to (path, line_no, line, error): gzip is recognised by its first bytes.

    Each file is opened by itself: one that is cut, damaged or no UTF-8 gives a row with its error, after no line of its
    own, and touches no other. An empty file has no line.
    """

    def read(content: bytes) -> str:
        return (gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content).decode("utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                lines, error = [], None
                try:
                    lines = read(content.as_py()).splitlines()
                except (OSError, EOFError, zlib.error, UnicodeDecodeError) as e:
                    error = f"unreadable file: {e}"
                for k in range(0, len(lines), LINES):
                    part = lines[k : k + LINES]
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(part)), pa.array(range(k, k + len(part)), pa.int64()), pa.array(part), pa.nulls(len(part), pa.string())], names=["path", "line_no", "line", "error"])
                if error:
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([error])], names=["path", "line_no", "line", "error"])

    return files.select("path", "content").mapInArrow(run, "path string, line_no long, line string, error string")


def parsed_rows(lines: DataFrame, schema: str, patient: Column) -> DataFrame:
    """Lines of tab-separated files with a header line each to patient, the columns of schema, and BROKEN."""
    row = F.from_csv(F.col("line"), f"{schema}, {BROKEN} string", {"sep": "\t", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    rows = lines.filter("error is not null or (line_no > 0 and line <> '')").select(patient.alias("patient"), "error", row.alias("_row"))
    return rows.select("patient", "_row.*", "error").withColumn(BROKEN, F.coalesce("error", BROKEN)).drop("error")


def patient_of_path() -> Column:
    """The patient of a file: a folder `patient=<name>`, or else the file name up to the first dot."""
    return F.coalesce(F.nullif(F.regexp_extract("path", r"/patient=([^/]+)/", 1), F.lit("")), F.regexp_extract("path", r"([^/.]+)[^/]*$", 1))


def ingest_available(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, failures: str | None = None, processed: str | None = None) -> None:
    """Append every new file of the source folder once, as Parquet by patient; the checkpoint remembers what is done.

    Files are tab-separated with a header line, plain or gzip, and read as bytes inside the tasks. A patient with a file
    that can't be read, or a line that does not fit the schema, is written to `failures` (patient, broken_lines, example,
    batch) instead, and stops no other; `processed` takes the patients that were appended. A batch is read once for all
    three; one that is run again after a crash replaces what it wrote before.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).load(source)
    rows = parsed_rows(file_lines(files), schema, patient_of_path())

    def append(batch: DataFrame, number: int) -> None:
        held = batch.withColumn("batch", F.lit(number)).persist()
        try:
            good, failed = isolate_failures(held)
            good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "patient").parquet(target)
            for path, table in ((failures, failed.withColumn("batch", F.lit(number))), (processed, good.select("patient", "batch").distinct())):
                if path:
                    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        finally:
            held.unpersist()

    rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
