"""Residue and chain operators over an atoms table."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions.text import residue_code
from ..session import staged
from .skew import salted_join


def is_amino(name, extra: tuple[str, ...] = ()):
    """Amino-acid test by residue name; ``extra`` lists modified residues to accept."""
    return F.upper(name).isin(*fv.THREE_TO_ONE, *extra)


def first_model(atoms: DataFrame) -> DataFrame:
    """Rows of the lowest-numbered model of each structure."""
    stats = staged(atoms.groupBy("pdb").agg(F.min("model").alias("_first"), F.count("*").alias("_n")))
    joined = salted_join(atoms, stats.select("pdb", "_first"), ["pdb"], stats.select("pdb", "_n"), ["x", "y", "z"])
    return joined.filter(F.col("model") == F.col("_first")).drop("_first")


def polymer_residues(atoms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Residues that make up chain sequences, each with the place (``pos``) of its first atom in the file.

    A position (number, insertion code) holds one residue, with hetero residues apart by name; where several
    names share it, the name that comes last counts. A residue number belongs to the polymer when any of its rows
    carries a numeric ``label_seq``. A structure with a malformed row (null ``label_seq``) has no usable set and
    falls back to the amino-acid test, as does one without any polymer row.
    """
    numeric = F.col("label_seq").isNotNull() & ~F.col("label_seq").isin(".", "?")
    hetero = F.when(F.col("group_pdb") == "HETATM", F.col("resname")).otherwise("")
    residues = atoms.groupBy("pdb", "chain", "resseq", "icode", hetero.alias("_hetero")).agg(
        F.max_by("resname", "pos").alias("resname"), F.min("pos").alias("pos"), F.max(numeric).alias("_numeric"),
    )
    number = Window.partitionBy("pdb", "chain", "resseq")
    residues = residues.withColumn("_poly", F.max("_numeric").over(number))
    # per structure, straight from the narrow atom columns with map-side aggregation
    fallback = (F.max(F.col("label_seq").isNull()) | ~F.max(numeric)).alias("_fallback")
    stats = staged(atoms.groupBy("pdb").agg(fallback, F.count("*").alias("_n")))
    joined = salted_join(residues, stats.select("pdb", "_fallback"), ["pdb"], stats.select("pdb", "_n"), ["chain", "resseq"])
    kept = F.when(F.col("_fallback"), is_amino(F.col("resname"), extra)).otherwise(F.col("_poly"))
    return joined.filter(kept).select("pdb", "chain", "resseq", "icode", "resname", "pos")


def chain_sequence(residues: DataFrame) -> DataFrame:
    """Per chain: the residue letters in file order (``X`` kept) and their number."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "resseq", "icode", residue_code(F.col("resname")).alias("code"))))
    chains = residues.groupBy("pdb", "chain").agg(ordered.alias("_r"))
    return chains.select("pdb", "chain", F.array_join("_r.code", "").alias("seq"), F.size("_r").alias("size"))


def chain_role(chains: DataFrame, pep_min: int = 2, pep_max: int = 50, prot_min: int = 51) -> DataFrame:
    """``is_peptide`` for sizes in [pep_min, pep_max], ``is_protein`` from prot_min on; with limits that overlap a
    chain may be both. ``role`` names the first that holds, else null."""
    peptide, protein = F.col("size").between(pep_min, pep_max), F.col("size") >= prot_min
    role = F.when(peptide, "peptide").when(protein, "protein")
    return chains.withColumns({"role": role, "is_peptide": peptide, "is_protein": protein})


def count_atoms(atoms: DataFrame) -> DataFrame:
    """Coordinate rows per structure over all models."""
    kept = atoms.filter(F.col("group_pdb").isin("ATOM", "HETATM"))
    return kept.groupBy("pdb").agg(F.count("*").alias("n_atoms"))


def size_gate(ids: DataFrame, counts: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(kept ids, oversized ``DF[pdb, n_atoms]`` sorted); unknown counts pass, limit 0 passes all."""
    known = ids.join(counts, "pdb", "left")
    if limit <= 0:
        return ids, known.filter(F.lit(False))
    over = F.coalesce(F.col("n_atoms") > limit, F.lit(False))
    return known.filter(~over).select("pdb"), known.filter(over).select("pdb", "n_atoms").orderBy("pdb")


def method_filter(pairs: DataFrame, metadata: DataFrame, method: str = fv.XRAY) -> DataFrame:
    """Distinct structures whose entries carry the given method."""
    ids = metadata.filter(F.col("STRUCTURE_METHOD") == method).select("id")
    return pairs.join(ids, "id", "left_semi").select("pdb").distinct()


def complete_auth_columns(atoms: DataFrame) -> DataFrame:
    """Author atom and residue names, copied from the label names where absent (idempotent)."""
    columns = {}
    for name in ("atom_id", "comp_id"):
        label, auth = f"label_{name}", f"auth_{name}"
        if label in atoms.columns:
            columns[auth] = F.coalesce(auth, label) if auth in atoms.columns else F.col(label)
    return atoms.withColumns(columns) if columns else atoms


def chain_label_map(atoms: DataFrame) -> DataFrame:
    """Author chain to polymer label; the first ATOM row of a chain wins."""
    polymer = atoms.filter(F.col("group_pdb") == "ATOM")
    return polymer.groupBy("pdb", "chain").agg(F.min_by("label_chain", "pos").alias("label"))


def label_status(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """``ok``, ``too_few_chains`` or ``no_polymer_label:<chains>`` for ``DF[id, pdb, chain]`` sets."""
    joined = entries.join(labels, ["pdb", "chain"], "left")
    missing = F.array_sort(F.collect_set(F.when(F.col("label").isNull(), F.col("chain"))))
    grouped = joined.groupBy("id").agg(missing.alias("_missing"), F.count_distinct("label").alias("_labels"))
    status = (
        F.when(F.size("_missing") > 0, F.concat(F.lit("no_polymer_label:"), F.array_join("_missing", ",")))
        .when(F.col("_labels") < 2, "too_few_chains").otherwise("ok")
    )
    return grouped.select("id", status.alias("status"))


def structure_tables(atoms: DataFrame, chain_sets: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Amino-acid atoms of each entry's chains: ``DF[id, pdb, chain]`` gives the sets."""
    kept = atoms.filter(is_amino(F.col("resname"), extra))
    return kept.join(chain_sets.select("id", "pdb", "chain").distinct(), ["pdb", "chain"])
