"""Row membership: semi and anti joins, set operations, selections by id."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from .bloom import outside


def candidate_select(entries: DataFrame, entities: DataFrame, snapshot: str, min_length: int = 51, min_chains: int = 2) -> DataFrame:
    """Entries released by the snapshot with a long enough protein entity and enough polymer chains."""
    dated = entries.filter(F.col("release_date") <= F.lit(snapshot).cast("date"))
    long_enough = entities.filter((F.col("polymer_type") == "Protein") & (F.col("length") >= min_length)).select("pdb")
    proteins = dated.join(long_enough, "pdb", "left_semi").select("pdb")
    multichain = dated.filter(F.col("chains") >= min_chains).select("pdb")
    return proteins.intersect(multichain)


def oracle_recall(candidates: DataFrame, oracle: DataFrame, key: str = "pdb") -> tuple[DataFrame, DataFrame]:
    """(missing ids, one row ``oracle_size, oracle_missing, recall``); recall is null for an empty oracle."""
    wanted = oracle.select(F.upper(key).alias(key)).distinct()
    have = candidates.select(F.upper(key).alias(key)).distinct()
    missing = wanted.join(have, key, "left_anti")
    flagged = wanted.join(have.withColumn("_have", F.lit(1)), key, "left")
    n, lost = F.count("*"), F.count(F.when(F.col("_have").isNull(), 1))
    recall = F.when(n > 0, F.round(1 - lost / n, 4))
    return missing, flagged.agg(n.alias("oracle_size"), lost.alias("oracle_missing"), recall.alias("recall"))


def snapshot_sample(ids: DataFrame, present: DataFrame, k: int, seed: int = 42, key: str = "pdb") -> DataFrame:
    """A seeded sample of ``min(k, n)`` distinct ids that are present, in id order."""
    pool = ids.select(key).distinct().join(present.select(key), key, "left_semi")
    return pool.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), key)), key).limit(k).orderBy(key)


def master_semi(pairs: DataFrame, surface: DataFrame, key: str = "id") -> DataFrame:
    """Pairs that have a surface row, in id order."""
    return pairs.join(surface.select(key), key, "left_semi").orderBy(key)


def missing_files(expected: DataFrame, present: DataFrame, key: str = "id", filters: DataFrame | None = None) -> DataFrame:
    """Expected ids without an artifact, in id order. ``filters`` are those of the present ids, where they are stored."""
    return outside(expected.select(key), present, filters, key).orderBy(key)


def stale_prune(present: DataFrame, referenced: DataFrame, key: str = "id", filters: DataFrame | None = None) -> DataFrame:
    """Stored artifacts nobody refers to any more. ``filters`` are those of the referenced ids."""
    return outside(present.select(key), referenced, filters, key)


def incremental_todo(items: DataFrame, done: DataFrame, signature: str, key: str = "id", filters: DataFrame | None = None) -> DataFrame:
    """Items without a stored record under this parameter signature. ``filters`` are those of that signature's ids."""
    return outside(items, done.filter(F.col("signature") == signature), filters, key)


def set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def set_except(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def set_union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def union_cached_new(cached: DataFrame, new: DataFrame) -> DataFrame:
    return cached.unionByName(new, allowMissingColumns=True)


def acquire_status_tally(log: DataFrame) -> DataFrame:
    """Attempts per status head, flagged when they are failures."""
    from ..functions.text import status_head

    tally = log.groupBy(status_head(F.col("status")).alias("status")).agg(F.count("*").alias("n"))
    return tally.withColumn("is_failure", F.col("status").isin("failed", "not_found"))


def variant_cutoffs(variants: dict[str, dict[str, float]] | None = None) -> dict[str, dict[str, float]]:
    """Every variant merged over the defaults; a distance override also sets the energy distance."""
    chosen = fv.CUTOFF_VARIANTS if variants is None else variants
    merged = {"": dict(fv.CUTOFFS)}
    for name, override in chosen.items():
        merged[name] = {**fv.CUTOFFS, **override}
        if "distance" in override:
            merged[name]["energy_distance"] = override["distance"]
    return merged


def ordered_output(df: DataFrame, keys: list[str]) -> DataFrame:
    """Range-partitioned, binary-collated order by the keys."""
    return df.orderBy(*keys)
