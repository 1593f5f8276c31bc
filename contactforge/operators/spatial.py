"""Distance joins over 3-D points.

Candidate pairs come from the leaves of a linear octree (:mod:`contactforge.operators.octree`): bounded leaves, salts that
follow from the work, one array kernel per pair of leaves. Where only *existence* or the *minimum* of a group pair matters,
the kernel folds its hits to one row per group pair before they leave it.

All results equal a brute-force comparison: box bounds use the same operations in the same order as the point distance, and
rounding is monotone. Points without a place (null coordinates) are near nothing.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.text import entry_id, literal_map
from ..session import staged
from . import octree
from .octree import AXES


def _sum_squares(terms) -> Column:
    return reduce(lambda a, b: a + b, [t * t for t in terms])


def near_groups(
    left: DataFrame, right: DataFrame, radius: float, left_keys: list[str], right_keys: list[str],
    block: list[str] = ["pdb"], keep: octree.Keep | None = None,
) -> DataFrame:
    """Distinct (block, left group, right group) with any two points at most ``radius`` apart.

    Group columns come back prefixed with ``l_`` and ``r_``. ``keep`` restricts the point pairs.
    """
    return octree.near_keys(left, right, radius, block, left_keys, right_keys, keep).drop("_d2").distinct()


def group_min_distance(
    left: DataFrame, right: DataFrame, radius: float, left_keys: list[str], right_keys: list[str],
    block: list[str] = ["pdb"], keep: octree.Keep | None = None,
) -> DataFrame:
    """Smallest point distance per group pair, for pairs within ``radius``."""
    found = octree.near_keys(left, right, radius, block, left_keys, right_keys, keep)
    return found.groupBy(*[c for c in found.columns if c != "_d2"]).agg(F.sqrt(F.min("_d2")).alias("min_dist"))


# ---- pair-level operators --------------------------------------------------------------------------


def _named_pairs(df: DataFrame) -> DataFrame:
    out = df.withColumnsRenamed({"l_chain": "pep_chain", "r_chain": "prot_chain"})
    return out.withColumn("id", entry_id(F.col("pdb"), F.col("pep_chain"), F.col("prot_chain")))


def contact_pairs(peps: DataFrame, prots: DataFrame, radius: float = fv.CUTOFFS["distance"]) -> DataFrame:
    """Peptide chain x protein chain of one structure with any atom pair within the radius (inclusive)."""
    near = near_groups(peps, prots, radius, ["chain"], ["chain"], keep=octree.apart("chain"))
    return _named_pairs(near).select("id", "pdb", "pep_chain", "prot_chain")


def pair_min_distance(peps: DataFrame, prots: DataFrame, max_radius: float) -> DataFrame:
    near = group_min_distance(peps, prots, max_radius, ["chain"], ["chain"], keep=octree.apart("chain"))
    return _named_pairs(near).select("id", "pdb", "pep_chain", "prot_chain", "min_dist")


def _pair_sides(pairs: DataFrame, atoms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Atoms of the peptide chains and of the protein chains that occur in the pair table, written once: they are read twice."""
    peps = pairs.select("pdb", F.col("pep_chain").alias("chain")).distinct()
    prots = pairs.select("pdb", F.col("prot_chain").alias("chain")).distinct()
    sided = peps.withColumn("_side", F.lit(0)).unionByName(prots.withColumn("_side", F.lit(1)))
    both = staged(atoms.join(sided, ["pdb", "chain"]))
    return both.filter(F.col("_side") == 0).drop("_side"), both.filter(F.col("_side") == 1).drop("_side")


def interface_residues(pairs: DataFrame, atoms: DataFrame, radius: float = fv.CUTOFFS["distance"]) -> DataFrame:
    """Ascending residue numbers of the protein within the radius of the peptide (empty list if none).

    ``atoms`` holds amino-acid residues only; residues sharing a number merge.
    """
    peps, prots = _pair_sides(pairs, atoms)
    near = near_groups(peps, prots, radius, ["chain"], ["chain", "resseq"], keep=octree.apart("chain"))
    listed = _named_pairs(near).groupBy("id").agg(F.array_sort(F.collect_list("r_resseq")).alias("interface_residues"))
    return pairs.select("id").join(listed, "id", "left").withColumn(
        "interface_residues", F.coalesce("interface_residues", F.array().cast("array<int>"))
    )


def contact_class_counts(
    pairs: DataFrame, atoms: DataFrame, residue_class: dict[str, str] | None = None,
    radius: float = fv.CUTOFFS["energy_distance"],
) -> DataFrame:
    """Residue contacts per pair, total and by the six unordered class pairs."""
    cls = F.element_at(literal_map(residue_class or fv.CONTACT_CLASS), F.col("resname"))
    classed = atoms.withColumn("cls", cls).filter(F.col("cls").isNotNull())
    peps, prots = _pair_sides(pairs, classed)
    residue = ["chain", "resseq", "cls"]
    near = near_groups(peps, prots, radius, residue, residue, keep=octree.apart("chain"))
    counts = [F.count("*").alias("n_intermolecular")]
    for a, b in fv.CLASS_PAIRS:
        hit = ((F.col("l_cls") == a) & (F.col("r_cls") == b)) | ((F.col("l_cls") == b) & (F.col("r_cls") == a))
        counts.append(F.count(F.when(hit, 1)).alias(f"n_{a}_{b}"))
    counted = _named_pairs(near).groupBy("id").agg(*counts)
    return pairs.select("id").join(counted, "id")


def _contact_rows(first: DataFrame, second: DataFrame, rules: list[tuple], ordered: bool = False) -> DataFrame:
    """Atom pairs of different chains (``ordered``: the smaller chain first) that satisfy a rule ``(class1, class2, dmin, dmax, type)``."""
    radius = max(r[3] for r in rules)
    columns = ["chain", "resseq", "resname", "atom_name", "cls"]
    sides = [sorted({r[k] for r in rules}) for k in (0, 1)]
    same = first is second and sides[0] == sides[1]
    first = first.filter(F.col("cls").isin(sides[0]))
    second = first if same else second.filter(F.col("cls").isin(sides[1]))
    keep = octree.both(octree.among("cls", {(r[0], r[1]) for r in rules}), octree.apart("chain", ordered))
    pairs = octree.near_points(first, second, radius, ["pdb"], columns, keep).withColumn("distance", F.sqrt("_d2"))
    table = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
                 F.lit(kind).alias("type"))
        for a, b, lo, hi, kind in rules
    ])
    d = F.col("distance")
    hits = F.filter(table, lambda r: (r["a"] == F.col("l_cls")) & (r["b"] == F.col("r_cls")) & (d >= r["lo"]) & (d <= r["hi"]))
    return pairs.withColumn("type", F.explode(F.transform(hits, lambda r: r["type"])))


CONTACT_FIELDS = {
    "l_chain": "chain1", "l_resseq": "res1", "l_resname": "resname1", "l_atom_name": "atom1",
    "r_chain": "chain2", "r_resseq": "res2", "r_resname": "resname2", "r_atom_name": "atom2",
}


def typed_contacts(pairs: DataFrame, atoms: DataFrame, rules: list[tuple]) -> DataFrame:
    """Inter-chain atom contacts of each pair, labelled by class and distance rules.

    ``atoms`` carries ``cls`` besides chain, resseq, resname, atom_name and coordinates; ``rules`` is the
    (small, literal) rule list.
    """
    peps, prots = _pair_sides(pairs, atoms)
    found = _contact_rows(peps, prots, rules)
    named = found.withColumn("id", entry_id(F.col("pdb"), F.col("l_chain"), F.col("r_chain")))
    kept = named.join(pairs.select("id").distinct(), "id", "left_semi")
    return kept.select("id", *[F.col(a).alias(b) for a, b in CONTACT_FIELDS.items()], "distance", "type")


def contact_totals(contacts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Contacts per pair; pairs without any count zero."""
    totals = contacts.groupBy("id").agg(F.count("*").alias("n"))
    joined = pairs.select("id", "pdb", "pep_chain", "prot_chain").join(totals, "id", "left")
    return joined.select(
        "id", "pdb", F.col("pep_chain").alias("pep"), F.col("prot_chain").alias("prot"),
        F.coalesce("n", F.lit(0)).alias("total_contacts"),
    )


def multi_contacts(multi: DataFrame, atoms: DataFrame, rules: list[tuple]) -> DataFrame:
    """Typed contacts among all chains of a multi-partner entry, partner-partner contacts included.

    ``multi`` is ``DF[cluster_id, pdb, chains array]``. Contacts are found once per structure and handed to
    the entries whose chain set holds both chains.
    """
    members = multi.select("cluster_id", "pdb", F.explode(F.array_distinct("chains")).alias("chain"))
    entries = multi.filter(F.size(F.array_distinct("chains")) >= 2).select("cluster_id")
    members = members.join(entries, "cluster_id", "left_semi")
    wanted = staged(atoms.join(members.select("pdb", "chain").distinct(), ["pdb", "chain"], "left_semi"))
    found = _contact_rows(wanted, wanted, rules, ordered=True)
    first = members.withColumnRenamed("chain", "l_chain")
    second = members.withColumnRenamed("chain", "r_chain")
    kept = found.join(first, ["pdb", "l_chain"]).join(second, ["cluster_id", "pdb", "r_chain"], "left_semi")
    return kept.select("cluster_id", *[F.col(a).alias(b) for a, b in CONTACT_FIELDS.items()], "distance", "type")


def sensitivity(pairs: DataFrame, variants: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Entries, mean buried area and mean energy per cutoff variant, in one pass over measured pairs.

    ``pairs`` is ``DF[id, min_dist, bsa, dg, pep_size, prot_size]``; variants override the defaults.
    """
    from .membership import variant_cutoffs

    settings = variant_cutoffs(variants)
    table = F.array(*[
        F.struct(F.lit(name).alias("variant"), *[F.lit(float(s[k])).alias(k) for k in ("distance", "bsa", "pep_min", "pep_max", "prot_min")])
        for name, s in settings.items()
    ])
    crossed = pairs.withColumn("_v", F.explode(table)).select("*", "_v.*")
    kept = crossed.filter(
        (F.col("min_dist") <= F.col("distance")) & (F.round(pairs["bsa"], 2) > F.col("_v.bsa"))
        & F.col("pep_size").between(F.col("pep_min"), F.col("pep_max")) & (F.col("prot_size") >= F.col("prot_min"))
    )
    return kept.groupBy("variant").agg(
        F.count("*").alias("n"), F.avg(pairs["bsa"]).alias("mean_bsa"), F.avg("dg").alias("mean_dg")
    )
