"""Per-sequence physicochemical properties as column expressions.

Each expression works on the letter counts of one cleaned sequence, so a whole profile is one narrow
projection: no shuffle, and a cost linear in the text. Only the search for the isoelectric point is an Arrow UDF.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..session import byte_batches
from .text import standard_only
from .vectorised import charge_bisector


def letter_count(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def counts_of(seq: Column) -> dict[str, Column]:
    return {r: letter_count(seq, r) for r in fv.RESIDUES}


def _total(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def weighted(counts: dict[str, Column], weights: dict[str, float]) -> Column:
    return _total(counts[r] * F.lit(w) for r, w in weights.items())


def element_counts(counts: dict[str, Column]) -> dict[str, Column]:
    return {
        element: weighted(counts, {r: atoms[i] for r, atoms in fv.RESIDUE_ATOMS.items()})
        for i, element in enumerate("CHNOS")
    }


def formula(elements: dict[str, Column]) -> Column:
    base = F.concat(*[x for e in "CHNO" for x in (F.lit(e), elements[e].cast("string"))])
    return F.concat(base, F.when(elements["S"] > 0, F.concat(F.lit("S"), elements["S"].cast("string"))).otherwise(""))


def total_atoms(elements: dict[str, Column]) -> Column:
    return _total(elements.values())


def _per_length(value: Column, n: Column, empty: float = 0.0) -> Column:
    return F.when(n > 0, F.round(value / n, 3)).otherwise(F.lit(empty))


def aliphatic(counts: dict[str, Column], n: Column) -> Column:
    value = 100 * (
        counts["A"] + fv.ALIPHATIC_VALINE * counts["V"] + fv.ALIPHATIC_LEUCINE * (counts["I"] + counts["L"])
    )
    return _per_length(value, n)


def hydrophobic(counts: dict[str, Column], n: Column) -> Column:
    return _per_length(100.0 * _total(counts[r] for r in fv.HYDROPHOBIC), n)


def positive(counts: dict[str, Column]) -> Column:
    return counts["K"] + counts["R"]


def negative(counts: dict[str, Column]) -> Column:
    return counts["D"] + counts["E"]


def extinction_reduced(counts: dict[str, Column]) -> Column:
    return fv.EXTINCTION_TYR * counts["Y"] + fv.EXTINCTION_TRP * counts["W"]


def extinction_cystine(counts: dict[str, Column]) -> Column:
    return extinction_reduced(counts) + fv.EXTINCTION_CYSTINE * F.floor(counts["C"] / 2).cast("int")


def mass(counts: dict[str, Column], n: Column) -> Column:
    """Summed in whole ten-thousandths, the precision of the masses, so that rounding ties are exact."""
    units = {r: round(m * 10_000) for r, m in fv.RESIDUE_MASS.items()}
    total = _total(counts[r].cast("long") * F.lit(u) for r, u in units.items()) - (n - 1).cast("long") * F.lit(round(fv.WATER_MASS * 10_000))
    return F.when(n > 0, F.round(total / 10.0) / 1000.0)


def hydropathy(counts: dict[str, Column], n: Column) -> Column:
    return F.when(n > 0, F.round(weighted(counts, fv.HYDROPATHY) / n, 3))


def isoelectric(seq: Column) -> Column:
    """pH of zero net charge by a fixed number of bisection steps, a batch of sequences at a time."""
    return F.round(charge_bisector()(seq), 3)


# ---- DataFrame operators: DF[id, seq] -> DF[id, value columns] ---------------------------------


def _profiled(df: DataFrame, seq: str) -> tuple[DataFrame, dict[str, Column], Column]:
    """Materialise the twenty counts once as columns, so later expressions only read them."""
    prepared = df.withColumn("_q", standard_only(F.col(seq)))
    prepared = prepared.withColumns({f"_n{r}": c for r, c in counts_of(F.col("_q")).items()})
    return prepared, {r: F.col(f"_n{r}") for r in fv.RESIDUES}, F.length("_q")


def residue_composition(df: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    base, counts, _ = _profiled(df, seq)
    return base.select(key, *[c.alias(f"n_{r}") for r, c in counts.items()])


def formula_atoms(df: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    base, counts, _ = _profiled(df, seq)
    elements = element_counts(counts)
    return base.select(
        key, *[c.alias(f"n_{e}") for e, c in elements.items()],
        formula(elements).alias("Formula"), total_atoms(elements).alias("TotalAtoms"),
    )


def _single(name: str, build):
    def operator(df: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
        base, counts, n = _profiled(df, seq)
        return base.select(key, *[c.alias(k) for k, c in build(counts, n).items()])

    operator.__name__ = name
    return operator


aliphatic_index = _single("aliphatic_index", lambda c, n: {"Aliphatic": aliphatic(c, n)})
hydrophobic_percent = _single("hydrophobic_percent", lambda c, n: {"Hydrophobic": hydrophobic(c, n)})
charge_counts = _single("charge_counts", lambda c, n: {"Pos": positive(c), "Neg": negative(c)})
extinction_coeff = _single(
    "extinction_coeff",
    lambda c, n: {"ExtCoeff_Disulfide": extinction_cystine(c), "ExtCoeff_NoDisulfide": extinction_reduced(c)},
)
molecular_weight = _single("molecular_weight", lambda c, n: {"MW": mass(c, n)})
gravy = _single("gravy", lambda c, n: {"GRAVY": hydropathy(c, n)})


def isoelectric_point(df: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    base = byte_batches(df).withColumn("_q", standard_only(F.col(seq)))
    return base.select(key, isoelectric(F.col("_q")).alias("pI"))


PROFILE_COLUMNS = [
    "clean_len", "stripped", "MW", "pI", "GRAVY", "Instability", "Aliphatic", "Hydrophobic", "Pos", "Neg",
    "ExtCoeff_Disulfide", "ExtCoeff_NoDisulfide", "Formula", "TotalAtoms",
]


def sequence_profile(df: DataFrame, seq: str, carry: list[str]) -> DataFrame:
    """Every property except the dipeptide-weighted one, for one sequence column."""
    base, c, n = _profiled(byte_batches(df), seq)
    elements = element_counts(c)
    return base.filter(n > 0).select(
        *carry,
        n.alias("clean_len"), (F.length(seq) - n).alias("stripped"), mass(c, n).alias("MW"),
        isoelectric(F.col("_q")).alias("pI"), hydropathy(c, n).alias("GRAVY"),
        aliphatic(c, n).alias("Aliphatic"), hydrophobic(c, n).alias("Hydrophobic"),
        positive(c).alias("Pos"), negative(c).alias("Neg"),
        extinction_cystine(c).alias("ExtCoeff_Disulfide"), extinction_reduced(c).alias("ExtCoeff_NoDisulfide"),
        formula(elements).alias("Formula"), total_atoms(elements).alias("TotalAtoms"),
    )


def physchem_profile(pairs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Two rows per pair (peptide, protein); a chain without standard residues yields none.

    ``weights`` is the published dipeptide table ``DF[kmer, weight]``; without it the instability
    column is null.
    """
    from .descriptors import instability_index

    chains = pairs.select(
        "id",
        F.inline(F.array(
            F.struct(F.lit("peptide").alias("chain_type"), F.col("pep_seq").alias("_seq")),
            F.struct(F.lit("protein").alias("chain_type"), F.col("prot_seq").alias("_seq")),
        )),
    )
    if weights is None:
        profile = sequence_profile(chains, "_seq", ["id", "chain_type"]).withColumn("Instability", F.lit(None).cast("double"))
    else:
        keyed = chains.withColumn("_chain", F.struct("id", "chain_type", "_seq"))
        scored = instability_index(keyed, weights, key="_chain", seq="_seq")
        profile = sequence_profile(scored.select("_chain.*", "Instability"), "_seq", ["id", "chain_type", "Instability"])
    return profile.select("id", "chain_type", *PROFILE_COLUMNS)
