"""End-to-end plans from atoms and records to the published tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.energy import binding_energy, bsa_filter, buried_surface, surface_share
from ..functions.properties import physchem_profile
from ..functions.text import known, resolution_value
from ..operators import groups, interfaces, octree, spatial, structure, surface
from ..operators.features import attach_features, entity_resolve, long_to_wide, pdb_fanout, project_ordered, property_names
from ..operators.membership import master_semi
from ..session import staged


def modeled_chains(atoms: DataFrame, cutoffs: dict | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """``DF[pdb, chain, seq, size, role, is_peptide, is_protein]`` of the first model."""
    c = {**fv.CUTOFFS, **(cutoffs or {})}
    residues = structure.polymer_residues(atoms, extra)
    return structure.chain_role(structure.chain_sequence(residues), c["pep_min"], c["pep_max"], c["prot_min"])


def build_pairs(atoms: DataFrame, cutoffs: dict | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """The eight-column pair table.

    Peptide atoms are those of sequence residues; every atom of the protein chain counts, ligands included.
    The first-model atoms, the residues and the chains feed several branches, so each is written once.
    """
    c = {**fv.CUTOFFS, **(cutoffs or {})}
    first = staged(structure.first_model(atoms))
    residues = staged(structure.polymer_residues(first, extra))
    chains = staged(structure.chain_role(structure.chain_sequence(residues), c["pep_min"], c["pep_max"], c["prot_min"]))
    peptides = chains.filter("is_peptide").select("pdb", "chain")
    proteins = chains.filter("is_protein").select("pdb", "chain")
    # chains first, then the residue numbers of what is left: all other atoms stay out of the wider join
    numbers = residues.join(peptides, ["pdb", "chain"], "left_semi").select("pdb", "chain", "resseq").distinct()
    places = first.select("pdb", "chain", "resseq", *octree.AXES)
    pep_atoms = staged(places.join(peptides, ["pdb", "chain"], "left_semi").join(numbers, ["pdb", "chain", "resseq"], "left_semi").drop("resseq"))
    prot_atoms = staged(places.join(proteins, ["pdb", "chain"], "left_semi").drop("resseq"))
    contacts = spatial.contact_pairs(pep_atoms, prot_atoms, c["distance"])

    def named(prefix: str) -> DataFrame:
        return chains.select("pdb", F.col("chain").alias(f"{prefix}_chain"), F.col("size").alias(f"{prefix}_size"), F.col("seq").alias(f"{prefix}_seq"))

    out = contacts.join(named("pep"), ["pdb", "pep_chain"]).join(named("prot"), ["pdb", "prot_chain"])
    return out.select("id", "pdb", "pep_chain", "prot_chain", "pep_size", "prot_size", "pep_seq", "prot_seq")


def pair_atoms(pairs: DataFrame, atoms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Amino-acid atoms of both chains of every pair."""
    sets = pairs.select("id", "pdb", F.explode(F.array("pep_chain", "prot_chain")).alias("chain"))
    return structure.structure_tables(atoms, sets, extra)


def build_surface(pairs: DataFrame, atoms: DataFrame, threshold: float | None = None, **options) -> DataFrame:
    """Seven surface columns per pair, filtered by buried area. ``atoms`` needs ``radius``."""
    roles = pairs.select(
        "id", "pdb", F.inline(F.array(
            F.struct(F.col("pep_chain").alias("chain"), F.lit("peptide").alias("role")),
            F.struct(F.col("prot_chain").alias("chain"), F.lit("protein").alias("role")),
        )),
    )
    measured = pair_atoms(pairs, atoms).select("id", "chain", "x", "y", "z", "radius")
    table = buried_surface(surface.chain_areas(measured, roles, "pdb", **options))
    return bsa_filter(table, fv.CUTOFFS["bsa"] if threshold is None else threshold)


def build_energy(pairs: DataFrame, atoms: DataFrame, radius: float | None = None, temperature: float = fv.TEMPERATURE_C, **options) -> DataFrame:
    """Contact counts, surface shares, binding energy and constant per pair. ``atoms`` needs ``radius``."""
    r = fv.CUTOFFS["energy_distance"] if radius is None else radius
    amino = atoms.filter(structure.is_amino(F.col("resname")))
    counts = spatial.contact_class_counts(pairs, amino, None, r)
    residue = ["chain", "resseq", "resname"]
    measured = pair_atoms(pairs, atoms).select("id", *residue, "x", "y", "z", "radius")
    areas = surface.accessible_area(measured, keys=residue, **options)
    peps, prots = spatial._pair_sides(pairs, amino)
    near = spatial.near_groups(peps, prots, r, ["chain", "resseq"], ["chain", "resseq"], keep=octree.apart("chain"))
    touching = spatial._named_pairs(near).select("id", F.inline(F.array(
        F.struct(F.col("pep_chain").alias("chain"), F.col("l_resseq").alias("resseq")),
        F.struct(F.col("prot_chain").alias("chain"), F.col("r_resseq").alias("resseq")),
    ))).distinct().withColumn("_in", F.lit(True))
    flagged = areas.join(touching, ["id", "chain", "resseq"], "left").withColumn("in_interface", F.coalesce("_in", F.lit(False)))
    scored = counts.join(surface_share(flagged), "id")
    return scored.join(binding_energy(scored, temperature), "id")


def header_values(items: DataFrame) -> DataFrame:
    """One row per structure of ``DF[pdb, pos, item, value]``: the first known value of each published item, ``""`` without one.

    A structure with no known item still has its row; one without any row of ``items`` has none, as a header that could not be read.
    """
    used = sorted({*fv.HEADER_ITEMS.values(), *fv.RESOLUTION_ITEMS})
    value = known(F.col("value"))

    def cell(item: str) -> str:
        return f"_{used.index(item)}"

    firsts = [
        F.min_by("value", F.when((F.col("item") == item) & value.isNotNull(), F.col("pos"))).alias(cell(item)) for item in used
    ]
    # where no row has a place, any value may come back: only known items count
    seen = [F.count_if((F.col("item") == item) & value.isNotNull()).alias(f"n{cell(item)}") for item in used]
    rows = items.groupBy("pdb").agg(*firsts, *seen)

    def found(item: str):
        return F.when(F.col(f"n{cell(item)}") > 0, F.col(cell(item))).otherwise("")

    return rows.select(
        "pdb", *[found(item).alias(name) for name, item in fv.HEADER_ITEMS.items()],
        resolution_value(*[found(item) for item in fv.RESOLUTION_ITEMS]).alias("RESOLUTION"),
    )


def build_metadata(pairs: DataFrame, items: DataFrame, entity_poly: DataFrame, entity: DataFrame, sources: DataFrame) -> DataFrame:
    """The ten metadata columns of every pair whose structure has a header; tabs and line ends become blanks.

    ``items`` as for ``header_values``, the others as for ``entity_resolve``. Crowded structures are spread.
    """
    cells = pdb_fanout(pairs.select("id", "pdb"), header_values(items)).drop("pdb")
    out = cells.join(entity_resolve(pairs, entity_poly, entity, sources), "id")
    return out.select("id", *[F.translate(c, "\t\n", "  ").alias(c) for c in fv.METADATA_NAMES])


def build_wide(pairs: DataFrame, sources: dict[str, DataFrame], profile: DataFrame | None = None) -> DataFrame:
    """The 102-column wide table: pairs with a surface row, every feature left-joined, blanks for gaps.

    ``sources`` may hold surface (required), energy, interface, metadata, clusters (id, cnr_cluster), scores,
    inherited, ledger (id, first_release) and records (the 29-column interface annotation).
    """
    master = master_semi(pairs, sources["surface"]).withColumnsRenamed(fv.PAIR_NAMES)
    profile = physchem_profile(pairs) if profile is None else profile
    wide = long_to_wide(profile, list(fv.PROPERTY_NAMES))
    for kind in ("peptide", "protein"):
        wide = wide.withColumnsRenamed(property_names(kind))
    frames = {"surface": sources["surface"], "properties": wide}
    if "energy" in sources:
        frames["energy"] = sources["energy"].select("id", *[F.col(k).alias(v) for k, v in fv.ENERGY_NAMES.items()])
    if "interface" in sources:
        frames["interface"] = sources["interface"].select("id", F.array_join(F.col("interface_residues").cast("array<string>"), ",").alias("Interface Residues"))
    if "clusters" in sources:
        frames["clusters"] = sources["clusters"].select("id", F.col("cnr_cluster").alias("seq100_clusters"))
    if "ledger" in sources:
        frames["ledger"] = sources["ledger"].select("id", F.col("first_release").alias("FIRST_RELEASE"))
    for name in ("metadata", "scores", "inherited", "records"):
        if name in sources:
            frames[name] = sources[name]
    return project_ordered(attach_features(master, frames), fv.WIDE_ORDER + fv.ADDED_ORDER)


SECOND_KEY = "cluster_id_2"  # the published name occurs twice; only the sink can write it so


def build_multi(multi: DataFrame, sources: dict[str, DataFrame], profile: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """The 68-column multi-partner table.

    Peptide-level cells come from the first item; partner-level cells are colon-joined in item order.
    ``sources``: surface and energy keyed by cluster_id; metadata, interface, inherited, ledger, records keyed
    by pair id. All of the latter meet the items by pair id, without an exchange where they are bucketed by it (``items`` too),
    and one grouping by cluster_id makes every cell. ``items`` are numbered as by :func:`groups.item_positions`: only the first one,
    at 0, carries the peptide-level cells into that grouping.
    """
    items = groups.item_positions(multi) if items is None else items
    wide = long_to_wide(profile, list(fv.PROPERTY_NAMES))
    for kind in ("peptide", "protein"):
        wide = wide.withColumnsRenamed(property_names(kind))
    lead = [f"peptide_{v}" for v in fv.PROPERTY_NAMES.values()]
    lead += ["TITLE", "RESOLUTION", "CLASSIFICATION", "DEPOSITION_DATE", "STRUCTURE_METHOD", "PEPTIDE_DESC", "leader_id", "FIRST_RELEASE"]
    listed = [f"protein_{v}" for v in fv.PROPERTY_NAMES.values()] + ["PROTEIN_DESC", "Interface Residues", "pisa_css"]
    residues = F.array_join(F.col("interface_residues").cast("array<string>"), ",").alias("Interface Residues")
    joined = items
    for frame in (
        wide, sources["metadata"], sources["interface"].select("id", residues), sources["records"].select("id", "pisa_interface_class", "pisa_css"),
        sources["inherited"].select("id", "leader_id"), sources["ledger"].select("id", F.col("first_release").alias("FIRST_RELEASE")),
    ):
        joined = joined.join(frame, "id", "left")
    names = [*lead, *listed, "pisa_interface_class"]
    value = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names}
    value |= {c: F.when(F.col("pos") > 0, F.lit("")).otherwise(value[c]) for c in lead}
    cell = F.struct("pos", *[value[c].alias(f"v{k}") for k, c in enumerate(names)])
    grouped = joined.groupBy("cluster_id").agg(F.array_sort(F.collect_list(cell)).alias("_m"))
    place = {c: f"v{k}" for k, c in enumerate(names)}
    classes = F.col(f"_m.{place['pisa_interface_class']}")
    frames = [
        grouped.select(
            "cluster_id", *[F.get("_m", F.lit(0))[place[c]].alias(c) for c in lead],
            *[F.array_join(F.col(f"_m.{place[c]}"), ":").alias("pisa_css_per_chain" if c == "pisa_css" else c) for c in listed],
            groups.class_of_list(classes).alias("pisa_interface_class"), F.array_join(classes, ":").alias("pisa_interface_class_per_chain"),
        ),
        sources["surface"], sources["energy"].withColumnsRenamed(fv.ENERGY_NAMES),
    ]
    out = multi.withColumns({
        "peptide_Length": F.col("PEPTIDE_SIZE"), "protein_Length": F.col("PROTEIN_SIZE"), SECOND_KEY: F.col("cluster_id"),
    })
    for frame in frames:
        out = out.join(frame, "cluster_id", "left")
    order, seen = [], set()
    for name in fv.MULTI_ORDER + fv.MULTI_ADDED_ORDER:
        order.append(SECOND_KEY if name in seen else name)
        seen.add(name)
    return project_ordered(out, order)
