"""Profiles, comparisons of runs, fingerprints and checks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from math import exp, fsum, lgamma, log, log1p

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranges import covering


def column_profile(df: DataFrame, meanings: dict[str, str] | None = None) -> DataFrame:
    """(column, rows, non_null, percent, distinct, example, meaning): one pass over all columns; example is the least value."""
    cols = df.columns
    parts = [x for c in cols for x in (F.count(F.col(c)).alias(f"n_{c}"), F.count_distinct(F.col(c)).alias(f"d_{c}"), F.min(F.col(c).cast("string")).alias(f"e_{c}"))]
    one = df.agg(F.count("*").alias("_rows"), *parts)
    known = meanings or {}
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"n_{c}").alias("non_null"), F.round(100.0 * F.col(f"n_{c}") / F.nullif("_rows", F.lit(0)), 2).alias("percent"),
                 F.col(f"d_{c}").alias("distinct"), F.col(f"e_{c}").alias("example"), F.lit(known.get(c, "UNDOCUMENTED")).alias("meaning")) for c in cols])
    return one.select(F.inline(rows))


def dictionary_gaps(columns: Sequence[str], meanings: dict[str, str]) -> list[str]:
    """What is wrong with a dictionary of columns: undefined, absent, or one definition for several."""
    same: dict[str, list[str]] = {}
    for c, m in meanings.items():
        same.setdefault(m, []).append(c)
    return [f"undefined: {c}" for c in columns if c not in meanings] + [f"absent: {c}" for c in meanings if c not in columns] + [f"one definition: {', '.join(v)}" for v in same.values() if len(v) > 1]


def check_dictionary(columns: Sequence[str], meanings: dict[str, str]) -> None:
    if gaps := dictionary_gaps(columns, meanings):
        raise ValueError("; ".join(gaps))


def compare_sets(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, status): lost, kept or new between two runs."""
    a, b = before.select(*keys).distinct().withColumn("_a", F.lit(True)), after.select(*keys).distinct().withColumn("_b", F.lit(True))
    return a.join(b, list(keys), "full").select(*keys, F.when(F.col("_b").isNull(), "lost").when(F.col("_a").isNull(), "new").otherwise("kept").alias("status"))


def compare_counts(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per key in two runs and their difference."""
    a, b = (t.groupBy(*keys).agg(F.count("*").alias(n)) for t, n in ((before, "n_before"), (after, "n_after")))
    return a.join(b, list(keys), "full").fillna(0, ["n_before", "n_after"]).withColumn("difference", F.col("n_after") - F.col("n_before"))


def filter_cost(unfiltered: DataFrame, filtered: DataFrame, key: str, matched: str, reads: str) -> DataFrame:
    """Events with matches that only the unfiltered branch has, by reads."""
    return unfiltered.filter(F.col(matched) > 0).join(filtered.select(key), key, "left_anti").orderBy(F.desc(reads), key)


def retention_by_strand(candidates: DataFrame) -> DataFrame:
    """Per strand pair: candidates, kept ones and the share; and the share of Start-loss."""
    return candidates.groupBy("strand1", "strand2").agg(
        F.count("*").alias("n"), F.count_if("kept").alias("kept"), F.round(F.avg(F.col("kept").cast("double")), 6).alias("retention"), F.round(F.avg((F.col("frame_effect") == "Start-loss").cast("double")), 6).alias("start_loss")
    )


def strand_composition(genes: DataFrame, group: str) -> DataFrame:
    """Per gene set: genes, plus-strand genes, median length, plus share weighted by length."""
    return genes.groupBy(group).agg(F.count("*").alias("genes"), F.count_if(F.col("strand") == "+").alias("plus"), F.median("length").alias("median_length"), (F.sum(F.when(F.col("strand") == "+", F.col("length")).otherwise(0)) / F.sum("length")).alias("weighted_plus"))


def binomial_two_sided(k: int, n: int, p: float) -> float:
    """Exact two-sided p-value: outcomes no likelier than the observed one. Chances are kept as logs, for any n."""
    if not 0 < p < 1:
        return 1.0 if k == round(p * n) else 0.0
    logs = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p) for i in range(n + 1)]
    return min(1.0, round(fsum(exp(x) for x in logs if x <= logs[k] + 1e-7), 12))


def strand_p_values(composition: DataFrame, background: float) -> DataFrame:
    """composition with p_value; one row per gene set reaches Python."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in parts:
            yield t.assign(p_value=[binomial_two_sided(int(k), int(n), background) for k, n in zip(t["plus"], t["genes"], strict=True)])

    return composition.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in composition.dtypes) + ", p_value double")


def genes_at_breakends(ends: DataFrame, genes: DataFrame) -> DataFrame:
    """Breakends (chrom, pos) that lie in a transcript, with n, how many they lie in, and genes, theirs, sorted."""
    every = {"n": (F.count("*"), F.sum), "genes": (F.collect_set("gene"), lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))))}
    return covering(ends, genes, ["chrom"], "pos", "start", "end", every)


def type_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("svtype").agg(F.count("*").alias("n"), F.median("event_size").alias("median_size"), F.count_if(F.col("insert_len") >= 10).alias("insertion_driven"))


def peptides_per_variant(peptides: DataFrame, junctions: DataFrame, key: str, peptide: str) -> DataFrame:
    """One row: least, median and most peptides a productive variant, and the share of productive junctions."""
    per = peptides.groupBy(key).agg(F.count_distinct(peptide).alias("n"))
    one = per.agg(F.min("n").alias("least"), F.median("n").alias("median"), F.max("n").alias("most"), F.count("*").alias("productive"), F.lit(0).alias("_k"))
    total = junctions.agg(F.count_distinct(key).alias("junctions"), F.lit(0).alias("_k"))
    return one.join(total, "_k").drop("_k").withColumn("productive_share", F.round(F.col("productive") / F.col("junctions"), 6))


def audit_peptides(expected: DataFrame, generated: DataFrame, key: str, peptide: str) -> DataFrame:
    """Per variant: agree, DISAGREE or not compared, with the first five peptides of either side alone.

    Without either side nothing is compared, so both lists are null, not empty.
    """
    a, b = (t.groupBy(key).agg(F.collect_set(peptide).alias(n)) for t, n in ((expected, "expected"), (generated, "generated")))
    five = lambda x, y: F.slice(F.sort_array(F.array_except(x, y)), 1, 5)
    both = a.join(b, key, "full")
    only = both.withColumns({"missing": five("expected", "generated"), "extra": five("generated", "expected")})
    verdict = F.when(F.col("expected").isNull() | F.col("generated").isNull(), "not compared").when((F.size("missing") == 0) & (F.size("extra") == 0), "agree").otherwise("DISAGREE")
    return only.select(key, verdict.alias("verdict"), "missing", "extra")


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive fingerprint: rows and the sum of row hashes."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("hash_sum"))


def freshness(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Per dataset: current, stale or not checkable, from (dataset, rows, hash_sum) tables."""
    now = current.toDF("dataset", "rows_now", "hash_now")
    both = recorded.join(now, "dataset", "left")
    return both.select("dataset", F.when(F.col("rows_now").isNull(), "not checkable").when((F.col("rows") == F.col("rows_now")) & (F.col("hash_sum") == F.col("hash_now")), "current").otherwise("stale").alias("status"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Both tables hold the same rows, repeats counted."""
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


#: Rows that a run definition may have; more is a mistake.
MOST_DEFINITIONS = 100_000


def missing_paths(paths: DataFrame) -> list[str]:
    """owner.key: path of every configured path (owner, key, path) that is not there; null paths are not configured."""
    spark = paths.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out, known = [], paths.filter("path is not null").limit(MOST_DEFINITIONS + 1).collect()
    if len(known) > MOST_DEFINITIONS:
        raise ValueError(f"more than {MOST_DEFINITIONS} paths")
    for r in known:
        where = jvm.org.apache.hadoop.fs.Path(r["path"])
        if not where.getFileSystem(conf).exists(where):
            out.append(f"{r['owner']}.{r['key']}: {r['path']} does not exist")
    return sorted(out)


def check_run(samples: DataFrame, branches: DataFrame, wanted: Sequence[str] = (), paths: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """(errors, warnings) of a run definition, all at once, missing paths among them."""
    rows = samples.select("name", "vcf_kind", "parent").limit(MOST_DEFINITIONS + 1).collect()
    others = branches.select("name").limit(MOST_DEFINITIONS + 1).collect()
    if max(len(rows), len(others)) > MOST_DEFINITIONS:
        raise ValueError(f"more than {MOST_DEFINITIONS} samples or branches")
    counts = Counter(r["name"] for r in rows)
    errors = [f"sample {n} is named {k} times" for n, k in sorted(counts.items(), key=str) if k > 1]
    errors += [f"sample {r['name']}: unknown kind {r['vcf_kind']}" for r in rows if r["vcf_kind"] not in ("germline", "somatic")]
    known = {*counts, *(r["name"] for r in others)}
    errors += [f"unknown name {w}" for w in wanted if w not in known]
    errors += [] if paths is None else missing_paths(paths)
    warnings = [f"sample {r['name']}: parent {r['parent']} is not a sample, so it is a root" for r in rows if r["parent"] and r["parent"] not in counts]
    if sum(r["vcf_kind"] == "germline" for r in rows) > 1:
        warnings.append("several germline samples")
    return errors, warnings
