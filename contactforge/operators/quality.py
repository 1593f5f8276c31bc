"""Agreement with an earlier release, class summaries, counters and release differences."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv


def percent(hits: Column, n: Column) -> Column:
    return F.when(n > 0, F.round(100.0 * hits / n, 1))


def oracle_inner(ours: DataFrame, oracle: DataFrame, key: str = "id") -> DataFrame:
    """Rows present in both, the oracle's other columns prefixed with ``oracle_``."""
    renamed = oracle.withColumnsRenamed({c: f"oracle_{c}" for c in oracle.columns if c != key})
    return ours.join(renamed, key)


def _long_hits(df: DataFrame, name: str, tests: dict[str, Column]) -> DataFrame:
    """One aggregate row of conditional counts, unpivoted to (name, hits, n, pct)."""
    counted = df.agg(F.count("*").alias("n"), *[F.count(F.when(t, 1)).alias(f"h{i}") for i, t in enumerate(tests.values())])
    rows = F.array(*[F.struct(F.lit(m).alias(name), F.col(f"h{i}").alias("hits"), F.col("n")) for i, m in enumerate(tests)])
    return counted.select(F.inline(rows)).withColumn("pct", percent(F.col("hits"), F.col("n")))


def tolerance_hits(ours: DataFrame, oracle: DataFrame, specs: list[tuple[str, str, float]], key: str = "id") -> DataFrame:
    """Per metric: rows whose values differ by at most the tolerance; unparsable values are misses."""
    both = oracle_inner(ours, oracle, key)
    tests = {
        mine: F.abs(F.col(f"`{mine}`").try_cast("double") - F.col(f"`oracle_{theirs}`").try_cast("double")) <= F.lit(tol)
        for mine, theirs, tol in specs
    }
    return _long_hits(both, "metric", tests)


def exact_hits(ours: DataFrame, oracle: DataFrame, columns: list[str], key: str = "id") -> DataFrame:
    """Per column: rows with equal trimmed text, where a missing value equals blank."""
    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")))

    both = oracle_inner(ours, oracle, key)
    return _long_hits(both, "column", {c: text(c) == text(f"oracle_{c}") for c in columns})


def extraction_hits(pairs: DataFrame, oracle: DataFrame, key: str = "id") -> DataFrame:
    """Pairs known to an earlier release (``PEPTIDE_SIZE, PEPTIDE_SEQ``) whose size and sequence are the same text there; a missing value is blank."""
    both = oracle_inner(pairs.select(key, "pep_size", "pep_seq"), oracle.select(key, "PEPTIDE_SIZE", "PEPTIDE_SEQ"), key)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return _long_hits(both, "metric", {
        "size": text("pep_size") == text("oracle_PEPTIDE_SIZE"), "sequence": text("pep_seq") == text("oracle_PEPTIDE_SEQ"),
    })


def header_check(columns: list[str], oracle_columns: list[str], n: int | None = None) -> bool:
    """Whether the first ``n`` names (default: all of the oracle's) agree."""
    n = len(oracle_columns) if n is None else n
    return columns[:n] == oracle_columns[:n]


def class_breakdown(df: DataFrame, column: str = "class", order: list[str] | None = None) -> DataFrame:
    """Count and share per class, blank shown as ``(blank)``; listed classes first, others by name."""
    ranks = fv.INTERFACE_CLASS_ORDER if order is None else order
    shown = F.trim(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")))
    counted = df.groupBy(F.when(shown == "", "(blank)").otherwise(shown).alias("class")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("t")).scalar()
    rank = F.array_position(F.lit(list(ranks)), F.col("class"))
    return counted.withColumn("pct", percent(F.col("n"), total)).orderBy(
        F.when(rank > 0, rank).otherwise(F.lit(len(ranks) + 1)), "class"
    )


def class_means(df: DataFrame, columns: list[str], kind: str = "class", classes=("biological", "crystal-packing")) -> DataFrame:
    """Mean of each column per scored class, unparsable cells ignored."""
    return df.filter(F.col(kind).isin(*classes)).groupBy(kind).agg(
        *[F.avg(F.col(f"`{c}`").try_cast("double")).alias(f"mean_{c}") for c in columns]
    )


def home_counters(pairs: DataFrame, multi: DataFrame, date: str) -> DataFrame:
    """Pair entries, distinct (protein, peptide) sequences, pairs plus multi entries, multi entries, date.

    Distinct sequence pairs are counted on digests, so whole sequences are not shuffled.
    """
    digest = F.sha2(F.concat_ws("\u0001", F.sha2("prot_seq", 256), F.sha2("pep_seq", 256)), 256)
    base = pairs.agg(F.count("*").alias("complexes"), F.count_distinct(digest).alias("unique_entries"))
    multi_n = multi.agg(F.count("*").alias("m")).scalar()
    return base.select(
        "complexes", "unique_entries", (F.col("complexes") + multi_n).alias("total"), multi_n.alias("multi"),
        F.date_format(F.lit(date).cast("date"), "MMM d, yyyy").alias("updated"),
    )


def _counts(frames: dict[str, DataFrame], label: str) -> DataFrame:
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias(label), "n") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, rows)


def coverage_counts(frames: dict[str, DataFrame]) -> DataFrame:
    return _counts(frames, "stage")


def release_counts(frames: dict[str, DataFrame]) -> DataFrame:
    return _counts(frames, "deliverable")


def status_reasons(df: DataFrame) -> DataFrame:
    """Rows per status, payloads after ``:`` dropped."""
    return df.groupBy(F.split("status", ":")[0].alias("reason")).agg(F.count("*").alias("n"))


def release_diff(current: DataFrame, previous: DataFrame, key: str = "id") -> DataFrame:
    """Rows before and now, added, removed, carried over, and carried-over rows with any changed cell.

    Shared columns are folded into one digest per row before the join, so the shuffle moves a key and
    32 bytes instead of a hundred columns.
    """
    shared = sorted(c for c in current.columns if c in previous.columns and c != key)
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in shared]
    # lengths in front of the cells keep neighbouring cells apart
    sealed = F.concat(*[x for c in cells for x in (F.length(c).cast("string"), F.lit(":"), c)]) if cells else F.lit("")

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.sha2(sealed, 256).alias(name))

    both = digest(current, "_now").join(digest(previous, "_then"), key, "full_outer")
    now, then = F.col("_now").isNotNull(), F.col("_then").isNotNull()
    return both.agg(
        F.count(F.when(then, 1)).alias("prev_n"), F.count(F.when(now, 1)).alias("cur_n"),
        F.count(F.when(now & ~then, 1)).alias("added"), F.count(F.when(then & ~now, 1)).alias("removed"),
        F.count(F.when(now & then, 1)).alias("common"),
        F.count(F.when(now & then & (F.col("_now") != F.col("_then")), 1)).alias("changed"),
    )


def latest_prior_release(releases: DataFrame, current: str) -> DataFrame:
    """The newest release before the current one."""
    return releases.filter(F.col("name") < current).agg(F.max("name").alias("name"))


def best_by_auc(df: DataFrame) -> DataFrame:
    """Per class the model with the highest AUC; the first row wins on ties, unparsable values are skipped."""
    auc = F.col("auc").try_cast("double")
    valid = df.withColumn("_a", auc).filter(F.col("_a").isNotNull() & ~F.isnan("_a"))
    best = valid.groupBy("class").agg(F.max_by(F.struct("model", F.col("_a").alias("auc")), F.struct("_a", -F.col("pos"))).alias("b"))
    return best.select("class", "b.model", "b.auc")


def best_by_brier(df: DataFrame) -> DataFrame:
    """Per class the model with the lowest Brier score; NaN dropped, registry order breaks ties."""
    valid = df.filter(F.col("brier").isNotNull() & ~F.isnan("brier"))
    best = valid.groupBy("class").agg(F.min_by(F.struct("model", "brier", "auc"), F.struct("brier", "pos")).alias("b"))
    return best.select("class", "b.model", "b.brier", "b.auc")


def scorecard(sections: dict[str, DataFrame]) -> DataFrame:
    """All checks as (section, metric, hits, n, pct) with a one-decimal percent text or ``n/a``."""
    frames = []
    for section, df in sections.items():
        metric = df.columns[0]
        pct = F.when(F.col("n") > 0, F.format_string("%.1f%%", F.round(100.0 * F.col("hits") / F.col("n"), 1))).otherwise("n/a")
        frames.append(df.select(F.lit(section).alias("section"), F.col(metric).alias("metric"), "hits", "n", pct.alias("pct")))
    return reduce(DataFrame.unionByName, frames)
