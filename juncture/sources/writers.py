"""Sinks: Parquet as canonical form, text tables, admitted VCF lines, JSON manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, text: bool = False, columns: list[str] | None = None) -> bool:
    """Write Parquet (and TSV, arrays joined by `;`); an empty table writes nothing and returns false."""
    if columns:
        df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    if text:
        flat = df.select(*[F.concat_ws(";", c).alias(c) if t.startswith("array") else F.col(c).cast("string").alias(c) for c, t in df.dtypes])
        flat.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").csv(f"{path}.tsv")
    return True


def admitted_lines(lines: DataFrame, admitted: DataFrame) -> DataFrame:
    """The breakend rows (with `line`) of the admitted set: by record id; by place where a sample's ids are unusable."""
    ids = admitted.groupBy("sample").agg((F.count_if((F.col("id") == ".") | F.col("id").isNull()) + F.count("*") - F.count_distinct("id")).alias("bad"))
    marked = lines.join(ids.select("sample", (F.col("bad") == 0).alias("by_id")), "sample")
    named = marked.filter("by_id").join(admitted.select("sample", "id"), ["sample", "id"], "left_semi")
    placed = marked.filter("not by_id").join(admitted.select("sample", "chrom", "pos"), ["sample", "chrom", "pos"], "left_semi")
    return named.unionByName(placed).drop("by_id")


def write_admitted(lines: DataFrame, admitted: DataFrame, path: str) -> None:
    """One text file a sample below path/sample=<name>: the sample's header lines, then its admitted lines, in file order.

    lines: sample, file_row and `line` of whole files (`read_lines`), header lines (#) included, with id, chrom and pos
    of the others. A sample without an admitted line keeps its header. A task sorts and writes a sample's lines, which are
    one file's; samples are spread over tasks. Rows are written as they were read, byte for byte. What was admitted is
    asked three times and found once: its ids and places are kept until the files are there.
    """
    header, known = F.startswith("line", F.lit("#")), admitted.select("sample", "id", "chrom", "pos").persist()
    try:
        kept = lines.filter(header).unionByName(admitted_lines(lines.filter(~header), known))
        ordered = kept.select("sample", "file_row", F.col("line").alias("value")).repartition("sample").sortWithinPartitions("sample", "file_row")
        ordered.select("sample", "value").write.mode("overwrite").partitionBy("sample").text(path)
    finally:
        known.unpersist()


def write_manifest(spark: SparkSession, values: dict, path: str) -> None:
    """One JSON object as text."""
    import json

    spark.createDataFrame([(json.dumps(values, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)
