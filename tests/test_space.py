import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from contactforge.functions import energy
from contactforge.operators import octree, signature3d, skew, spatial, structure, surface
from contactforge.plans import build


def cloud(n, seed, chains, spread=12.0):
    rng = random.Random(seed)
    return [("S", rng.choice(chains), i, *(rng.uniform(0, spread) for _ in range(3))) for i in range(n)]


SCHEMA = "pdb string, chain string, resseq int, x double, y double, z double"


def near(a, b, r):
    return sum((p - q) ** 2 for p, q in zip(a[3:], b[3:])) <= r * r


@pytest.mark.parametrize("radius", [0.5, 1.7, 4.0])
def test_near_groups_equal_brute_force(frame, radius):
    left, right = cloud(60, 1, "abcdef"), cloud(80, 2, "uvwxyz")
    got = spatial.near_groups(frame(left, SCHEMA), frame(right, SCHEMA), radius, ["chain"], ["chain", "resseq"])
    want = {(a[1], b[1], b[2]) for a, b in itertools.product(left, right) if near(a, b, radius)}
    rows = [(r.l_chain, r.r_chain, r.r_resseq) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("spread", [3.0, 12.0])
def test_min_distance_equals_brute_force(frame, spread):
    left, right = cloud(50, 3, "abc", spread), cloud(70, 4, "xyz", spread)
    got = {(r.l_chain, r.r_chain): r.min_dist for r in spatial.group_min_distance(frame(left, SCHEMA), frame(right, SCHEMA), 5.0, ["chain"], ["chain"]).collect()}
    want = {}
    for a, b in itertools.product(left, right):
        if near(a, b, 5.0):
            want[a[1], b[1]] = min(want.get((a[1], b[1]), 9.9), math.dist(a[3:], b[3:]))
    assert got == pytest.approx(want)


def test_one_crowded_cell(frame):
    """Everything in one cell, each point its own group: decided by boxes or points, never lost."""
    left = [("S", f"l{i}", i, i * 1e-3, 0.0, 0.0) for i in range(40)]
    right = [("S", f"r{i}", i, 6.0 + i * 1e-3, 0.0, 0.0) for i in range(40)]
    got = spatial.contact_pairs(frame(left, SCHEMA), frame(right, SCHEMA), 6.0)
    assert got.count() == sum(1 for i in range(40) for j in range(40) if (6.0 + j * 1e-3) - i * 1e-3 <= 6.0)


def test_cutoff_is_inclusive_and_same_chain_is_out(frame):
    peps = frame([("S", "p", 1, 0.0, 0.0, 0.0)], SCHEMA)
    prots = frame([("S", "a", 1, 6.0, 0.0, 0.0), ("S", "b", 1, 6.0001, 0.0, 0.0), ("S", "p", 2, 1.0, 0.0, 0.0), ("T", "a", 1, 0.0, 0.0, 0.0)], SCHEMA)
    assert [r.id for r in spatial.contact_pairs(peps, prots).collect()] == ["S-p-a"]


def test_interface_lists_may_be_empty_and_merge_numbers(frame):
    atoms = frame([("S", "p", 1, 0.0, 0.0, 0.0), ("S", "a", 7, 3.0, 0.0, 0.0), ("S", "a", 7, 3.5, 0.0, 0.0), ("S", "a", 5, 4.0, 0.0, 0.0), ("S", "b", 5, 40.0, 0.0, 0.0)], SCHEMA)
    pairs = frame([("S-p-a", "S", "p", "a"), ("S-p-b", "S", "p", "b")], "id string, pdb string, pep_chain string, prot_chain string")
    got = {r.id: r.interface_residues for r in spatial.interface_residues(pairs, atoms).collect()}
    assert got == {"S-p-a": [5, 7], "S-p-b": []}


def test_salted_join_keeps_every_row(frame):
    rows = frame([("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(50)] + [("lost", 1)], "k string, i int")
    other = frame([("hot", "h")] + [(f"k{i}", "c") for i in range(50)], "k string, v string")
    sizes = rows.groupBy("k").agg(F.count("*").alias("_n"))
    assert skew.hot_keys(sizes, ["k"], floor=100).collect()[0].k == "hot"
    joined = skew.salted_join(rows, other, ["k"], sizes, ["i"], floor=100, salts=5)
    assert joined.count() == 350 and joined.select("i", "k").distinct().count() == 350
    left = skew.salted_join(rows, other, ["k"], sizes, ["i"], how="left", floor=100, salts=5)
    assert left.count() == 351 and left.filter("v IS NULL").count() == 1


def test_typed_contacts_golden_row(frame):
    schema = "pdb string, chain string, resseq int, resname string, atom_name string, cls string, x double, y double, z double"
    atoms = frame([("S", "A", 7, "GLU", "OE1", "neg", 0.0, 0.0, 0.0), ("S", "B", 303, "ARG", "NE", "pos", 2.71, 0.0, 0.0), ("S", "B", 9, "ARG", "NE", "pos", 9.0, 0.0, 0.0)], schema)
    pairs = frame([("S-A-B", "S", "A", "B")], "id string, pdb string, pep_chain string, prot_chain string")
    rows = spatial.typed_contacts(pairs, atoms, [("neg", "pos", 0.0, 6.0, "SB")]).collect()
    assert [tuple(r)[1:] for r in rows] == [("A", 7, "GLU", "OE1", "B", 303, "ARG", "NE", 2.71, "SB")]
    assert spatial.contact_totals(spatial.typed_contacts(pairs, atoms, [("neg", "neg", 0.0, 6.0, "RE")]), pairs).first().total_contacts == 0


def test_multi_contacts_include_partner_pairs_and_need_two_chains(frame):
    schema = "pdb string, chain string, resseq int, resname string, atom_name string, cls string, x double, y double, z double"
    atoms = frame([("S", c, 1, "ALA", "CA", "k", float(i), 0.0, 0.0) for i, c in enumerate("ABC")], schema)
    multi = frame([("S-A", "S", ["A", "B", "C", "B"]), ("S-B", "S", ["B", "B"])], "cluster_id string, pdb string, chains array<string>")
    rows = spatial.multi_contacts(multi, atoms, [("k", "k", 0.0, 5.0, "HY")]).collect()
    assert sorted((r.cluster_id, r.chain1, r.chain2) for r in rows) == [("S-A", "A", "B"), ("S-A", "A", "C"), ("S-A", "B", "C")]


def test_area_of_lone_and_touching_spheres(frame):
    schema = "id string, chain string, x double, y double, z double, radius double"
    lone = surface.accessible_area(frame([("e", "A", 0.0, 0.0, 0.0, 1.6)], schema), n_points=200).first()
    assert lone.area == pytest.approx(4 * math.pi * 3.0**2)
    # two equal spheres of R = 3 at distance d lose a cap of height R - d/2 each
    pair = surface.accessible_area(frame([("e", "A", 0.0, 0.0, 0.0, 1.6), ("e", "B", 2.0, 0.0, 0.0, 1.6)], schema), n_points=800).collect()
    exact = 4 * math.pi * 9 - 2 * math.pi * 3.0 * (3.0 - 1.0)
    assert [r.area for r in pair] == pytest.approx([exact, exact], rel=0.02)


def test_buried_surface_and_strict_filter(frame):
    rows = frame([("x", "p", "peptide", 100.0, 60.0), ("x", "q", "protein", 300.0, 270.0), ("y", "p", "peptide", 0.0, 0.0), ("y", "q", "protein", 50.0, 49.992)],
                 "id string, chain string, role string, iso_area double, complex_area double")
    table = energy.buried_surface(rows)
    got = {r.id: r for r in table.collect()}
    assert (got["x"].BSA, got["x"].BPepA, got["x"].BProA, got["x"]["BPP%"]) == (35.0, 40.0, 30.0, 40.0)
    assert got["y"]["BPP%"] == 0.0
    assert [r.id for r in energy.bsa_filter(table).collect()] == ["x"]  # 0.004 rounds to 0.0 and is dropped


def test_energy_constants(frame):
    row = energy.binding_energy(frame([("a", 0, 0, 0, 0, 0.0, 0.0)], "id string, n_charged_charged int, n_charged_apolar int, n_polar_polar int, n_apolar_polar int, nis_apolar double, nis_charged double")).first()
    assert row.dg == pytest.approx(-15.9433) and row.kd == pytest.approx(math.exp(-15.9433 / (0.0019858775 * 298.15)))


def test_struct_signature_width_and_cumulation(frame):
    rows = [("e", 0, 0, 0.0, 0.0, 0.0), ("e", 1, 1, 1.0, 0.0, 0.0), ("e", 2, 1, 0.0, 2.0, 0.0), ("far", 0, 0, 0.0, 0.0, 0.0), ("far", 1, 0, 50.0, 0.0, 0.0)]
    got = signature3d.struct_signature(frame(rows, "id string, pos int, cls int, x double, y double, z double")).collect()
    assert [r.id for r in got] == ["e"] and len(got[0].vec) == 1800
    pair01, pair11 = got[0].vec[50:100], got[0].vec[8 * 50 : 9 * 50]
    assert pair01[4] == 1.0 and pair01[9] == 2.0 and pair01[49] == 2.0 and pair11[49] == 1.0


def test_roles_and_gate(frame):
    chains = frame([(n,) for n in (1, 2, 50, 51)], "size int")
    assert [r.role for r in structure.chain_role(chains).collect()] == [None, "peptide", "peptide", "protein"]
    ids, counts = frame([("a",), ("b",), ("c",)], "pdb string"), frame([("a", 10), ("b", 11)], "pdb string, n_atoms long")
    kept, over = structure.size_gate(ids, counts, 10)
    assert sorted(r.pdb for r in kept.collect()) == ["a", "c"] and [tuple(r) for r in over.collect()] == [("b", 11)]
    assert structure.size_gate(ids, counts, 0)[0].count() == 3


ATOMS = "pdb string, model int, chain string, resseq int, icode string, resname string, label_seq string, x double, y double, z double, group_pdb string, pos long"


def test_pairs_from_atoms(frame):
    """A capped peptide, a protein reached only through its water, a second model, a malformed structure."""
    rows = [("S", 1, "P", i, "", n, str(i), float(i), 0.0, 0.0) for i, n in enumerate(["ACE", "THR", "PRO"])]
    rows += [("S", 1, "Q", i, "", "ALA", str(i), 500.0 + i, 0.0, 0.0) for i in range(51)]
    rows += [("S", 1, "Q", 900, "", "HOH", ".", 2.0, 4.0, 0.0), ("S", 1, "R", 1, "", "ALA", "1", 0.0, 1.0, 0.0)]
    rows += [("S", 2, "Q", 0, "", "ALA", "0", 0.0, 0.0, 0.0)]
    rows += [("T", 1, "P", i, "", n, None if i == 0 else str(i), float(i), 0.0, 0.0) for i, n in enumerate(["ACE", "THR", "PRO"])]
    rows += [("T", 1, "Q", i, "", "ALA", str(i), float(i), 3.0, 0.0) for i in range(51)]
    rows = [(*r, "HETATM" if r[5] == "HOH" else "ATOM", pos) for pos, r in enumerate(rows)]
    got = {r.id: r for r in build.build_pairs(frame(rows, ATOMS)).collect()}
    assert set(got) == {"S-P-Q", "T-P-Q"}
    assert (got["S-P-Q"].pep_seq, got["S-P-Q"].pep_size, got["S-P-Q"].prot_size) == ("XTP", 3, 51)
    assert got["T-P-Q"].pep_seq == "TP"  # no usable polymer set: amino-acid test


def test_label_status(frame):
    labels = frame([("S", "a", "A"), ("S", "b", "A")], "pdb string, chain string, label string")
    sets = frame([("1", "S", "a"), ("1", "S", "b"), ("2", "S", "a"), ("2", "S", "z"), ("2", "S", "y")], "id string, pdb string, chain string")
    assert {r.id: r.status for r in structure.label_status(sets, labels).collect()} == {"1": "too_few_chains", "2": "no_polymer_label:y,z"}


def test_residues_follow_the_file(frame):
    """Insertion codes that count down, two names at one position, and a hetero residue at a used number."""
    names = [(1, "H", "THR", "ATOM"), (1, "G", "PHE", "ATOM"), (1, "F", "GLY", "ATOM"), (1, "", "ASP", "ATOM"), (2, "", "SER", "ATOM"), (2, "", "ALA", "ATOM"), (2, "", "MSE", "HETATM")]
    atoms = frame([("p", "A", n, i, r, g, "1", pos) for pos, (n, i, r, g) in enumerate(names)],
                  "pdb string, chain string, resseq int, icode string, resname string, group_pdb string, label_seq string, pos long")
    chain = structure.chain_sequence(structure.polymer_residues(atoms)).first()
    assert chain.seq[:5] == "TFGDA" and chain.size == 6


def test_roles_may_overlap(frame):
    chains = frame([("a", 30)], "chain string, size int")
    row = structure.chain_role(chains, pep_max=50, prot_min=20).first()
    assert row.is_peptide and row.is_protein


def test_sides_shared_by_entries_are_measured_once_with_the_same_result(frame):
    schema = "id string, chain string, x double, y double, z double, radius double"
    places = {"P": 0.0, "R": 5.0, "Q": 2.5, "T": 40.0}
    sets = {"S-P": ["P", "Q", "T"], "S-R": ["R", "Q", "T"], "S-X": ["R", "Q"]}
    atoms = frame([(i, c, places[c], 0.0, 0.0, 1.6 + (c == "T")) for i, cs in sets.items() for c in cs], schema)
    roles = frame([(i, "S", c, "protein" if c in "QT" else "peptide") for i, cs in sets.items() for c in cs], "id string, pdb string, chain string, role string")
    cells = ["id", "chain", "role", "iso_area", "complex_area"]
    each, once = (sorted(map(tuple, surface.chain_areas(atoms, roles, s, n_points=130).select(cells).collect())) for s in (None, "pdb"))
    assert len(each) == 8 and each == once
    assert surface.chain_areas(atoms.limit(0), roles.limit(0), "pdb").count() == 0


def test_a_leaf_without_neighbours_leaves_the_kernel_as_sums(frame):
    rows = [("e", "AB"[k % 2], k % 5 * 1.0, k // 5 * 1.0, 0.5, 3.0, 1) for k in range(20)] + [("far", "A", 500.0, 0.5, 0.5, 3.0, 2)]
    atoms = frame(rows, "id string, chain string, x double, y double, z double, R double, m long")
    columns = ["chain", "x", "y", "z", "R", "m"]
    pairs = octree.leaf_pairs(atoms, atoms, 6.0, ["id"], columns, columns, whole=True)
    found, _ = surface._masks(pairs, 6.0, 200, ["id"], ["chain"])
    sums = found.collect()
    assert sorted((r["id"], r["a_chain"]) for r in sums) == [("e", "A"), ("e", "B"), ("far", "A")] and all(r["a_x"] is None for r in sums)
    assert {r["id"]: r["area"] for r in sums}["far"] == pytest.approx(4 * math.pi * 9 * 2)
    # the same atoms on both sides of a cube's border keep their masks until they are merged
    crossing = atoms.withColumn("x", F.col("x") - 2.0)
    pairs = octree.leaf_pairs(crossing, crossing, 6.0, ["id"], columns, columns, whole=True)
    assert any(r["a_x"] is not None for r in surface._masks(pairs, 6.0, 200, ["id"], ["chain"])[0].collect())
    plain = [surface.accessible_area(a.withColumn("radius", F.col("R") - 1.4)).collect() for a in (atoms, crossing)]
    assert [{(r["id"], r["chain"]): r["area"] for r in p} for p in plain][0] == pytest.approx({(r["id"], r["chain"]): r["area"] for r in plain[1]})


def test_pairs_meet_by_their_places_alone(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(build.spatial, "contact_pairs", lambda *sides, near=build.spatial.contact_pairs: seen.append([s.columns for s in sides[:2]]) or near(*sides))
    rows = [("1abc", 1, c, c, k, "", "ALA", "CA", 0, k + (c == "B") * 1000, float(k), 0.0, 0.0, str(k), "ATOM", 1.5) for c, n in (("A", 5), ("B", 60)) for k in range(n)]
    atoms = frame(rows, "pdb string, model int, chain string, label_chain string, resseq int, icode string, resname string, atom_name string, kind int, pos long, x double, y double, z double, label_seq string, group_pdb string, radius double")
    assert [r["id"] for r in build.build_pairs(atoms).collect()] == ["1abc-A-B"]
    assert seen == [[["pdb", "chain", "x", "y", "z"]] * 2]


def test_atoms_of_a_structure_serve_all_its_ids(frame):
    from contactforge.operators import surface

    atoms = frame([("S", "A", 0.0, 0.0, 0.0, 1.5), ("S", "B", 2.0, 0.0, 0.0, 1.6), ("S", "C", 0.0, 2.0, 0.0, 1.7)], "pdb string, chain string, x double, y double, z double, radius double")
    roles = frame([(i, "S", c, r) for i, cs in (("S-A", "AC"), ("S-B", "BC")) for c, r in zip(cs, ("peptide", "protein"))], "id string, pdb string, chain string, role string")
    got = surface.chain_areas(atoms, roles, "pdb")
    want = surface.chain_areas(atoms.join(roles.select("id", "pdb", "chain"), ["pdb", "chain"]).select("id", "chain", "x", "y", "z", "radius"), roles, "pdb")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect())) and got.count() == 4
