"""Joining features onto a master table, reshaping, renaming and ordered projections."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.text import known
from .skew import salted_join


def attach_features(master: DataFrame, sources: dict[str, DataFrame], key: str = "id", fill: str = "") -> DataFrame:
    """Left-join every source by key; absent cells of text columns become ``fill``.

    Keys are unique on both sides, so a hot key cannot occur; the join strategy is left to the runtime sizes.
    """
    out = master
    for frame in sources.values():
        out = out.join(frame, key, "left")
    text = [f.name for f in out.schema if f.dataType.typeName() == "string" and f.name not in master.columns]
    return out.fillna(fill, subset=text) if text else out


def pdb_fanout(pairs: DataFrame, per_structure: DataFrame, row_id: str = "id", how: str = "inner") -> DataFrame:
    """Hand each per-structure record to all pairs of the structure; crowded structures are spread."""
    sizes = pairs.groupBy("pdb").agg(F.count("*").alias("_n"))
    return salted_join(pairs, per_structure, ["pdb"], sizes, [row_id], how)


def long_to_wide(df: DataFrame, values: list[str], key: str = "id", kind: str = "chain_type", kinds=("peptide", "protein")) -> DataFrame:
    """One row per key with ``<kind>_<value>`` columns."""
    cells = [F.first(F.when(F.col(kind) == k, F.col(v)), ignorenulls=True).alias(f"{k}_{v}") for k in kinds for v in values]
    return df.groupBy(key).agg(*cells)


def entity_resolve(pairs: DataFrame, entity_poly: DataFrame, entity: DataFrame, sources: DataFrame) -> DataFrame:
    """Chain descriptions and organisms.

    ``entity_poly`` DF[pdb, pos, entity, strands] maps chains to entities (a chain named twice keeps the
    last), ``entity`` DF[pdb, entity, description], ``sources`` DF[pdb, pos, entity, kind, name] with kinds
    gen, nat, syn in falling precedence; a structure-wide name backs up an entity without one.
    """
    strands = entity_poly.select("pdb", "pos", "entity", F.explode(F.split("strands", ",")).alias("chain"))
    strands = strands.withColumn("chain", F.trim("chain")).filter(F.col("chain") != "")
    chain_entity = strands.groupBy("pdb", "chain").agg(F.max_by("entity", "pos").alias("entity"))
    rank = F.element_at(F.create_map(*[F.lit(x) for x in ("gen", 0, "nat", 1, "syn", 2)]), F.col("kind"))
    named = sources.filter(known(F.col("name")).isNotNull()).withColumn("_order", F.struct(rank.alias("r"), "pos"))
    by_entity = named.groupBy("pdb", "entity").agg(F.min_by("name", "_order").alias("organism"))
    by_structure = named.groupBy("pdb").agg(F.min_by("name", "_order").alias("anywhere"))
    described = entity.groupBy("pdb", "entity").agg(F.first(known(F.col("description"))).alias("desc"))
    chains = (
        chain_entity.join(described, ["pdb", "entity"], "left").join(by_entity, ["pdb", "entity"], "left")
        .select("pdb", "chain", "desc", "organism")
    )

    def side(prefix: str, chain: str) -> DataFrame:
        return chains.select(
            "pdb", F.col("chain").alias(chain), F.col("desc").alias(f"{prefix}_desc"), F.col("organism").alias(f"{prefix}_org")
        )

    out = pairs.select("id", "pdb", "pep_chain", "prot_chain")
    out = out.join(side("pep", "pep_chain"), ["pdb", "pep_chain"], "left")
    out = out.join(side("prot", "prot_chain"), ["pdb", "prot_chain"], "left")
    out = pdb_fanout(out, by_structure, how="left")

    def organism(column: str) -> Column:
        return F.upper(F.coalesce(column, "anywhere", F.lit("")))

    return out.select(
        "id", F.coalesce("pep_desc", F.lit("")).alias("PEPTIDE_DESC"), F.coalesce("prot_desc", F.lit("")).alias("PROTEIN_DESC"),
        organism("prot_org").alias("organism"), organism("pep_org").alias("PEPTIDE_ORGANISM"),
        organism("prot_org").alias("PROTEIN_ORGANISM"),
    )


def rename_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def property_names(chain_type: str) -> dict[str, str]:
    """Pivoted property columns to their published names."""
    return {f"{chain_type}_{k}": f"{chain_type}_{v}" for k, v in fv.PROPERTY_NAMES.items()}


def resolve_names(columns: list[str], order: list[str]) -> dict[str, str | None]:
    """Target name to source column: exact match first, then case-insensitive, else None."""
    folded = {c.lower(): c for c in columns}
    return {t: t if t in columns else folded.get(t.lower()) for t in order}


def project_ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """Exactly the target columns in order, as text; absent ones blank."""
    found = resolve_names(df.columns, order)
    cells = [
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")) if source else F.lit("") for source in found.values()
    ]
    return df.select(*[c.alias(t) for c, t in zip(cells, order)])


def explore_projection(df: DataFrame) -> DataFrame:
    """The 25-field positional summary."""
    return project_ordered(df, fv.SUMMARY_ORDER)


def fasta_export(df: DataFrame, default: str, key: str = "id", seq: str = "seq", description: str = "desc") -> DataFrame:
    """One record per entry with a sequence: ``>id | description`` and the sequence on the next line."""
    flat = F.trim(F.translate(F.coalesce(description, F.lit("")), "\r\n", "  "))
    header = F.concat(F.lit(">"), F.col(key).cast("string"), F.lit(" | "), F.when(flat != "", flat).otherwise(default))
    body = F.trim(F.coalesce(seq, F.lit("")))
    return df.filter(body != "").select(F.concat(header, F.lit("\n"), body).alias("value"))


def column_manifest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Position and name of the emitted columns."""
    rows = list(enumerate(columns or df.columns))
    return df.sparkSession.createDataFrame(rows, "pos int, name string")
