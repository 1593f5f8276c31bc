"""Operators over interface and assembly records of a structure."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..plans.bucketed import bucketed
from ..session import staged
from .features import pdb_fanout


def unordered_chain_cross(pairs: DataFrame, interfaces: DataFrame) -> DataFrame:
    """Pair to the interface with the same chain set; the largest area wins, the first on ties.

    ``interfaces`` is ``DF[pdb, pos, chain_1, chain_2, area, ...]``. The winner is picked by a map-side
    ``max_by`` before the join, so repeated interfaces of one chain set never meet in a window.
    """
    def low_high(a: str, b: str):
        return F.least(a, b).alias("_low"), F.greatest(a, b).alias("_high")

    area = F.coalesce(F.col("area").try_cast("double"), F.lit(-1.0))
    record = F.struct(*[F.col(c) for c in interfaces.columns if c != "pdb"])
    order = F.struct(area.alias("a"), (-F.col("pos")).alias("p"))
    best = interfaces.select("pdb", *low_high("chain_1", "chain_2"), record.alias("_r"), order.alias("_o"))
    best = best.groupBy("pdb", "_low", "_high").agg(F.max_by("_r", "_o").alias("_r"))
    keyed = pairs.select("id", "pdb", *low_high("pep_chain", "prot_chain"))
    return keyed.join(best, ["pdb", "_low", "_high"]).select("id", "_r.*")


def sorted_letters(text) :
    """The characters of a composition in order: the canonical key of a chain multiset."""
    return F.array_join(F.array_sort(F.split(text, "")), "")


def assembly_match(pairs: DataFrame, assemblies: DataFrame) -> DataFrame:
    """Pair to the first assembly whose composition has the same sorted characters as its two chains."""
    record = F.struct(*[F.col(c) for c in assemblies.columns if c != "pdb"])
    first = assemblies.groupBy("pdb", sorted_letters(F.col("composition")).alias("_key")).agg(
        F.min_by(record, "pos").alias("_r")
    )
    keyed = pairs.select("id", "pdb", sorted_letters(F.concat("pep_chain", "prot_chain")).alias("_key"))
    return keyed.join(first, ["pdb", "_key"]).select("id", "_r.*")


def class_label(status, css, threshold: float):
    """biological / crystal-packing by score, not_applicable off X-ray, indeterminate unscored, else blank."""
    score = css.try_cast("double")
    return (
        F.when(status == "not_xray", "not_applicable").when((status != "ok") | status.isNull(), "")
        .when(score.isNull(), "indeterminate").when(score >= threshold, "biological").otherwise("crystal-packing")
    )


def interface_class(df: DataFrame, threshold: float = fv.CSS_THRESHOLD, key: str = "id") -> DataFrame:
    return df.select(key, class_label(F.col("status"), F.col("css"), threshold).alias("class"))


def status_derive(pairs: DataFrame, records: DataFrame, methods: DataFrame, xray: str = fv.XRAY) -> DataFrame:
    """Recorded status of the structure, else not_xray or missing by the entry's method."""
    return _with_fallback(pdb_fanout(pairs.select("id", "pdb"), records.select("pdb", "status"), how="left"), methods, xray)


def _with_fallback(joined: DataFrame, methods: DataFrame, xray: str = fv.XRAY) -> DataFrame:
    joined = joined.select("id", "status").join(methods.select("id", "STRUCTURE_METHOD"), "id", "left")
    fallback = F.when(F.coalesce("STRUCTURE_METHOD", F.lit("")) != xray, "not_xray").otherwise("missing")
    return joined.select("id", F.coalesce("status", fallback).alias("status"))


def degraded_fill(pairs: DataFrame, columns: list[str], status: str, status_column: str = "status") -> DataFrame:
    """A complete table for a source that could not be computed: the status, blanks elsewhere."""
    return pairs.select("id", F.lit(status).alias(status_column), *[F.lit("").alias(c) for c in columns])


def interface_table(pairs: DataFrame, records: DataFrame, methods: DataFrame, threshold: float = fv.CSS_THRESHOLD) -> DataFrame:
    """The 29-column interface annotation from nested per-structure records.

    ``records`` is ``DF[pdb, status, assembly_done, n_interfaces, interfaces array<struct>, assemblies
    array<struct>]``.
    """
    faces = records.select("pdb", F.posexplode("interfaces").alias("pos", "f")).select("pdb", "pos", "f.*")
    bodies = records.select("pdb", F.posexplode("assemblies").alias("pos", "a")).select("pdb", "pos", "a.*")
    # one meeting of pairs and structures for the status and the heads; tables bucketed by id meet by it where they lie
    fan = bucketed(pdb_fanout(pairs.select("id", "pdb"), records.select("pdb", "status", "assembly_done", "n_interfaces"), how="left").drop("pdb"))
    status = bucketed(_with_fallback(fan, methods))
    heads = fan.drop("status")
    ok = status.filter(F.col("status") == "ok").select("id")
    scored = staged(pairs.join(ok, "id", "left_semi"))
    out = status.join(heads, "id", "left")
    out = out.join(unordered_chain_cross(scored, faces).drop("pos"), "id", "left")
    out = out.join(assembly_match(scored, bodies).drop("pos", "composition"), "id", "left")
    names = ["assembly_done", "n_interfaces", *fv.INTERFACE_FIELDS, *fv.ASSEMBLY_FIELDS]
    return out.select(
        "id", F.col("status").alias("pisa_status"),
        class_label(F.col("status"), F.col("css"), threshold).alias("pisa_interface_class"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"pisa_{c}") for c in names],
    )
