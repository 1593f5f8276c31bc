"""Distance joins, surfaces and structure operators over line items read as atoms."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import energy
from ..functions.text import literal_map
from ..operators import groups, signature3d, spatial, structure, surface
from ..plans import build, committed, publish
from .base import CHAIN_PAIR_SQL, SHORT_SQL, Tables, atoms, atoms_sql, chain_pairs, is_short, long_atoms, query, short_atoms, written

A = atoms_sql()
SIDES = f"peps AS (SELECT * FROM atoms WHERE {SHORT_SQL}), prots AS (SELECT * FROM atoms WHERE NOT {SHORT_SQL})"
D2 = "((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"
IDS = "a.pdb || '-' || a.chain || '-' || b.chain"
NAMES = ", ".join(f"'{n}'" for n in fv.THREE_TO_ONE)


@query("contact_pairs", f"""WITH {A}, {SIDES}
SELECT DISTINCT {IDS} AS id, a.pdb, a.chain AS pep_chain, b.chain AS prot_chain FROM peps a JOIN prots b ON a.pdb = b.pdb WHERE {D2} <= 36.0""")
def _contact_pairs(t: Tables):
    return spatial.contact_pairs(short_atoms(t), long_atoms(t))


@query("pair_min_distance", f"""WITH {A}, {SIDES}
SELECT {IDS} AS id, a.pdb, a.chain AS pep_chain, b.chain AS prot_chain, round(sqrt(min({D2})), 6) AS min_dist
FROM peps a JOIN prots b ON a.pdb = b.pdb WHERE {D2} <= 64.0 GROUP BY ALL""")
def _pair_min_distance(t: Tables):
    return spatial.pair_min_distance(short_atoms(t), long_atoms(t), 8.0).withColumn("min_dist", F.round("min_dist", 6))


@query("interface_residues", f"""WITH {A}, {CHAIN_PAIR_SQL}, aa AS (SELECT * FROM atoms WHERE resname IN ({NAMES})),
near AS (SELECT DISTINCT {IDS} AS id, b.resseq FROM aa a JOIN aa b ON a.pdb = b.pdb WHERE {SHORT_SQL.replace('chain', 'a.chain')}
  AND NOT {SHORT_SQL.replace('chain', 'b.chain')} AND {D2} <= 36.0),
listed AS (SELECT id, string_agg(resseq::VARCHAR, ',' ORDER BY resseq) AS r FROM near GROUP BY id)
SELECT id, coalesce(r, '') AS interface_residues FROM pairs LEFT JOIN listed USING (id)""")
def _interface_residues(t: Tables):
    amino = atoms(t).filter(structure.is_amino(F.col("resname")))
    found = spatial.interface_residues(chain_pairs(t), amino)
    return found.select("id", F.array_join(F.col("interface_residues").cast("array<string>"), ",").alias("interface_residues"))


@query("sensitivity", f"""WITH {A}, {CHAIN_PAIR_SQL}, {SIDES},
dist AS (SELECT {IDS} AS id, sqrt(min({D2})) AS min_dist FROM peps a JOIN prots b ON a.pdb = b.pdb WHERE {D2} <= 64.0 GROUP BY ALL),
sizes AS (SELECT pdb, chain, count(DISTINCT resseq) AS size FROM atoms GROUP BY 1, 2),
m AS (SELECT id, min_dist, (p.size + q.size) / 10.0::DOUBLE - 10 AS bsa, -0.1::DOUBLE * q.size AS dg, p.size AS pep_size, q.size AS prot_size
  FROM dist JOIN pairs USING (id) JOIN sizes p ON p.pdb = pairs.pdb AND p.chain = pep_chain JOIN sizes q ON q.pdb = pairs.pdb AND q.chain = prot_chain),
v(variant, distance, bsa_min, pep_max, prot_min) AS (VALUES ('', 6.0, 0.0, 50, 51), ('dist5', 5.0, 0.0, 50, 51), ('dist8', 8.0, 0.0, 50, 51),
  ('bsa2', 6.0, 2.0, 50, 51), ('pep2_40', 6.0, 0.0, 40, 41))
SELECT variant, count(*) AS n, round(avg(bsa), 6) AS mean_bsa, round(avg(dg), 6) AS mean_dg FROM m CROSS JOIN v
WHERE min_dist <= distance AND round(bsa, 2) > bsa_min AND pep_size BETWEEN 2 AND pep_max AND prot_size >= prot_min GROUP BY variant""")
def _sensitivity(t: Tables):
    near = spatial.pair_min_distance(short_atoms(t), long_atoms(t), 8.0)
    sizes = atoms(t).groupBy("pdb", "chain").agg(F.count_distinct("resseq").alias("size"))
    p = sizes.select("pdb", F.col("chain").alias("pep_chain"), F.col("size").alias("pep_size"))
    q = sizes.select("pdb", F.col("chain").alias("prot_chain"), F.col("size").alias("prot_size"))
    measured = near.join(p, ["pdb", "pep_chain"]).join(q, ["pdb", "prot_chain"]).withColumns({
        "bsa": (F.col("pep_size") + F.col("prot_size")) / 10.0 - 10, "dg": -0.1 * F.col("prot_size"),
    })
    out = spatial.sensitivity(measured, {"dist5": {"distance": 5.0}, "dist8": {"distance": 8.0}, "bsa2": {"bsa": 2.0}, "pep2_40": {"pep_max": 40, "prot_min": 41}})
    return out.select("variant", "n", F.round("mean_bsa", 6).alias("mean_bsa"), F.round("mean_dg", 6).alias("mean_dg"))


CLASS_SQL = "CASE resname " + " ".join(f"WHEN '{r}' THEN '{c}'" for r, c in fv.CONTACT_CLASS.items()) + " END"
COUNT_SQL = ", ".join(
    f"count(*) FILTER (WHERE (c1 = '{a}' AND c2 = '{b}') OR (c1 = '{b}' AND c2 = '{a}')) AS n_{a}_{b}" for a, b in fv.CLASS_PAIRS
)
CONTACT_COUNT_SQL = f"""classed AS (SELECT *, {CLASS_SQL} AS cls FROM atoms),
touch AS (SELECT DISTINCT {IDS} AS id, a.resseq AS r1, a.cls AS c1, b.resseq AS r2, b.cls AS c2 FROM classed a JOIN classed b ON a.pdb = b.pdb
  WHERE a.cls IS NOT NULL AND b.cls IS NOT NULL AND {SHORT_SQL.replace('chain', 'a.chain')} AND NOT {SHORT_SQL.replace('chain', 'b.chain')} AND {D2} <= 36.0),
counts AS (SELECT id, count(*) AS n_intermolecular, {COUNT_SQL} FROM touch GROUP BY id)"""


@query("contact_class_counts", f"WITH {A}, {CONTACT_COUNT_SQL} SELECT * FROM counts")
def _contact_class_counts(t: Tables):
    return spatial.contact_class_counts(chain_pairs(t), atoms(t))


RULES = [
    ("k0", "k1", 0.0, 6.0, "SB"), ("k1", "k0", 0.0, 6.0, "SB"), ("k2", "k3", 2.0, 8.0, "HB"), ("k4", "k4", 0.0, 7.0, "HY"),
    ("k5", "k6", 1.0, 9.0, "AT"), ("k6", "k5", 1.0, 9.0, "uAT"), ("k7", "k7", 3.0, 9.0, "RE"), ("k4", "k4", 5.0, 9.0, "AS"),
]
RULES_SQL = f"rules(cls1, cls2, dmin, dmax, type) AS (VALUES {', '.join(str(r) for r in RULES)})"
ROW_SQL = f"""a.chain AS chain1, a.resseq AS res1, a.resname AS resname1, a.atom_name AS atom1, b.chain AS chain2, b.resseq AS res2,
  b.resname AS resname2, b.atom_name AS atom2, round(sqrt({D2}), 6) AS distance, type"""
RULE_JOIN = f"JOIN rules ON 'k' || a.kind::VARCHAR = cls1 AND 'k' || b.kind::VARCHAR = cls2 AND sqrt({D2}) BETWEEN dmin AND dmax"


def _kinds(df: DataFrame) -> DataFrame:
    return df.withColumn("cls", F.concat(F.lit("k"), F.col("kind").cast("string"))).select(
        "pdb", "chain", "resseq", "resname", "atom_name", "cls", "x", "y", "z"
    )


@query("typed_contacts", f"WITH {A}, {SIDES}, {RULES_SQL} SELECT {IDS} AS id, {ROW_SQL} FROM peps a JOIN prots b ON a.pdb = b.pdb {RULE_JOIN}")
def _typed_contacts(t: Tables):
    found = spatial.typed_contacts(chain_pairs(t), _kinds(atoms(t)), RULES)
    return found.withColumn("distance", F.round("distance", 6))


@query("contacts_publish", f"""WITH {A}, {CHAIN_PAIR_SQL}, {SIDES}, {RULES_SQL},
c AS (SELECT {IDS} AS id, count(*) AS n FROM peps a JOIN prots b ON a.pdb = b.pdb {RULE_JOIN} GROUP BY ALL)
SELECT id, pdb, pep_chain AS pep, prot_chain AS prot, coalesce(n, 0) AS total_contacts FROM pairs LEFT JOIN c USING (id)""")
def _contact_totals(t: Tables):
    pairs, path = chain_pairs(t), written(t)
    found = spatial.typed_contacts(pairs, _kinds(atoms(t)), RULES)
    publish.contacts_publish(found, path)
    back = committed.read_committed(t.spark, path, ",", found.schema, quote='"')
    return spatial.contact_totals(back, pairs)


def _multi(t: Tables) -> DataFrame:
    """Each short chain with all long chains of its structure, chains in order."""
    pairs = chain_pairs(t).groupBy("pdb", "pep_chain").agg(F.array_sort(F.collect_list("prot_chain")).alias("partners"))
    return pairs.withColumn("cluster_id", F.concat_ws("-", "pdb", "pep_chain"))


@query("multi_contacts", f"""WITH {A}, {CHAIN_PAIR_SQL}, {RULES_SQL},
sets AS (SELECT DISTINCT pdb || '-' || pep_chain AS cluster_id, pdb, pep_chain AS chain FROM pairs
  UNION SELECT pdb || '-' || pep_chain, pdb, prot_chain FROM pairs)
SELECT s.cluster_id, {ROW_SQL} FROM sets s JOIN sets u ON s.cluster_id = u.cluster_id AND s.chain < u.chain
JOIN atoms a ON a.pdb = s.pdb AND a.chain = s.chain JOIN atoms b ON b.pdb = u.pdb AND b.chain = u.chain {RULE_JOIN}""")
def _multi_contacts(t: Tables):
    multi = _multi(t).select("cluster_id", "pdb", F.concat(F.array("pep_chain"), "partners").alias("chains"))
    return spatial.multi_contacts(multi, _kinds(atoms(t)), RULES).withColumn("distance", F.round("distance", 6))


def _shares(t: Tables) -> DataFrame:
    """Class shares of the long chain's residues, as stand-in surface shares per pair."""
    cls = F.element_at(literal_map(fv.SURFACE_CLASS), F.col("resname"))
    chains = atoms(t).withColumn("cls", cls).groupBy("pdb", F.col("chain").alias("prot_chain")).agg(
        F.round(100.0 * F.avg(F.when(F.col("cls") == "apolar", 1.0).otherwise(0.0)), 2).alias("nis_apolar"),
        F.round(100.0 * F.avg(F.when(F.col("cls") == "charged", 1.0).otherwise(0.0)), 2).alias("nis_charged"),
    )
    return chain_pairs(t).join(chains, ["pdb", "prot_chain"]).select("id", "nis_apolar", "nis_charged")


SURFACE_CASE = "CASE resname " + " ".join(f"WHEN '{r}' THEN '{c}'" for r, c in fv.SURFACE_CLASS.items()) + " ELSE '' END"
KT = fv.GAS_CONSTANT * (25.0 + 273.15)
DG_SQL = f"{fv.ENERGY_INTERCEPT!r}::DOUBLE" + "".join(f" + ({w!r}::DOUBLE) * {n}" for n, w in fv.ENERGY_COEFFICIENTS.items())
ENERGY_SQL = f"""{CHAIN_PAIR_SQL}, {CONTACT_COUNT_SQL},
nis AS (SELECT pdb, chain, round(100.0::DOUBLE * avg(CASE WHEN {SURFACE_CASE} = 'apolar' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS nis_apolar,
  round(100.0::DOUBLE * avg(CASE WHEN {SURFACE_CASE} = 'charged' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS nis_charged FROM atoms GROUP BY 1, 2),
en AS (SELECT p.id, p.pdb, p.pep_chain, p.prot_chain, c.* EXCLUDE (id), nis_apolar, nis_charged, {DG_SQL} AS dg FROM pairs p JOIN counts c ON c.id = p.id
  JOIN nis ON nis.pdb = p.pdb AND nis.chain = p.prot_chain)"""


@query("binding_energy", f"WITH {A}, {ENERGY_SQL} SELECT id, round(dg, 8) AS dg, round(dg / {KT!r}::DOUBLE, 6) AS ln_kd FROM en")
def _binding_energy(t: Tables):
    counts = spatial.contact_class_counts(chain_pairs(t), atoms(t)).join(_shares(t), "id")
    out = energy.binding_energy(counts)
    return out.select("id", F.round("dg", 8).alias("dg"), F.round(F.ln("kd"), 6).alias("ln_kd"))


@query("multi_energy", f"""WITH {A}, {ENERGY_SQL}
SELECT p.pdb || '-' || p.pep_chain AS cluster_id, (row_number() OVER (PARTITION BY p.pdb, p.pep_chain ORDER BY p.prot_chain) - 1)::INTEGER AS pos,
  {', '.join(f'n_{k}::DOUBLE AS n_{k}' for k in ("intermolecular", *(f"{a}_{b}" for a, b in fv.CLASS_PAIRS)))}, nis_apolar, nis_charged, round(dg, 8) AS dg,
  round(dg / {KT!r}::DOUBLE, 6) AS ln_kd
FROM pairs p LEFT JOIN en USING (id)""")
def _multi_energy(t: Tables):
    """The colon lists of all eleven columns, taken apart again: one row per partner, blanks as null."""
    multi = _multi(t).withColumnRenamed("partners", "chains")
    lists = groups.multi_energy(multi, atoms(t), _shares(t))
    cells = F.arrays_zip(*[F.split(c, ":", -1).alias(c) for c in groups.ENERGY_COLUMNS])
    rows = lists.select("cluster_id", F.posexplode(cells).alias("pos", "cell"))
    value = {c: F.col(f"cell.{c}").try_cast("double") for c in groups.ENERGY_COLUMNS}
    plain = [v.alias(c) for c, v in value.items() if c not in ("dg", "kd")]
    return rows.select("cluster_id", "pos", *plain, F.round(value["dg"], 8).alias("dg"), F.round(F.ln(value["kd"]), 6).alias("ln_kd"))


# ---- surfaces ---------------------------------------------------------------------------------------

DENSE = 0.15
POINTS = 200
SPHERE_SQL = f"""sphere AS (SELECT i, sqrt(1 - z * z) * cos(turn) AS ux, sqrt(1 - z * z) * sin(turn) AS uy, z AS uz FROM (
  SELECT i, 1.0::DOUBLE - (2.0::DOUBLE * i + 1.0::DOUBLE) / {POINTS} AS z, i * (pi() * (3.0::DOUBLE - sqrt(5.0::DOUBLE))) AS turn FROM range({POINTS}) r(i)) s)"""


def _area_sql(name: str, source: str, block: list[str], keys: list[str]) -> str:
    group = list(dict.fromkeys([*block, *keys]))
    on = " AND ".join(f"a.{c} = b.{c}" for c in block)
    cols = ", ".join(group)
    covered = "ux * vx + uy * vy + uz * vz > edge"
    hidden = " + ".join(
        f"bit_count(bit_or(CASE WHEN i // 100 = {w} AND {covered} THEN 1::HUGEINT << (i % 100)::HUGEINT ELSE 0::HUGEINT END))::BIGINT" for w in range(-(-POINTS // 100))
    )
    return f"""{name}_f AS (SELECT {cols}, x, y, z, radius + {fv.PROBE_RADIUS}::DOUBLE AS r, count(*) AS m FROM {source} GROUP BY ALL),
{name}_p AS (SELECT {', '.join(f'a.{c}' for c in group)}, a.x, a.y, a.z, a.r, a.m, b.x - a.x AS vx, b.y - a.y AS vy, b.z - a.z AS vz,
  (a.r * a.r + {D2} - b.r * b.r) / (2.0::DOUBLE * a.r) AS edge FROM {name}_f a JOIN {name}_f b ON {on} AND {D2} < (a.r + b.r) * (a.r + b.r)),
{name}_h AS (SELECT {cols}, x, y, z, r, m, {hidden} AS hidden FROM {name}_p CROSS JOIN sphere GROUP BY ALL),
{name} AS (SELECT {cols}, sum(4.0::DOUBLE * pi() * r * r * (({POINTS}.0::DOUBLE - hidden) / {POINTS}) * m) AS area FROM {name}_h GROUP BY ALL)"""


@query("accessible_area", f"""WITH {atoms_sql(DENSE)}, {SPHERE_SQL}, {_area_sql('area', 'atoms', ['pdb'], ['chain'])}
SELECT pdb AS id, chain, round(area, 4) AS area FROM area""")
def _accessible_area(t: Tables):
    out = surface.accessible_area(atoms(t, DENSE).withColumnRenamed("pdb", "id"), n_points=POINTS)
    return out.select("id", "chain", F.round("area", 4).alias("area"))


@query("buried_surface", f"""WITH {atoms_sql(DENSE)}, {SPHERE_SQL},
short AS (SELECT DISTINCT pdb, chain AS pep FROM atoms WHERE {SHORT_SQL}),
sets AS (SELECT s.pdb || '-' || pep AS id, s.pdb, pep, 'peptide' AS role, x, y, z, radius FROM short s JOIN atoms a ON a.pdb = s.pdb AND a.chain = pep
  UNION ALL SELECT s.pdb || '-' || pep, s.pdb, pep, 'protein', x, y, z, radius FROM short s JOIN (FROM atoms WHERE NOT {SHORT_SQL}) a ON a.pdb = s.pdb),
lone AS (SELECT pdb, CASE WHEN {SHORT_SQL} THEN chain ELSE '' END AS side, x, y, z, radius FROM atoms),
{_area_sql('whole', 'sets', ['id', 'pdb', 'pep'], ['role'])}, {_area_sql('alone', 'lone', ['pdb', 'side'], [])},
w AS (SELECT id, pdb, pep, sum(area) AS c, sum(area) FILTER (WHERE role = 'peptide') AS pin, coalesce(sum(area) FILTER (WHERE role = 'protein'), 0) AS rin FROM whole GROUP BY ALL),
s AS (SELECT w.*, a.area AS p, coalesce(b.area, 0) AS r FROM w JOIN alone a ON a.pdb = w.pdb AND a.side = pep LEFT JOIN alone b ON b.pdb = w.pdb AND b.side = '')
SELECT id, round(c, 2) AS "ASA_Complex", round(p, 2) AS "ASA_Peptide", round(r, 2) AS "ASA_Protein", round((r + p - c) / 2.0::DOUBLE, 2) AS "BSA",
  round(p - pin, 2) AS "BPepA", round(r - rin, 2) AS "BProA", round(CASE WHEN p > 0 THEN 100.0::DOUBLE * (p - pin) / p ELSE 0.0::DOUBLE END, 2) AS "BPP%"
FROM s""")
def _buried_surface(t: Tables):
    """Every short chain against all long chains of its structure."""
    chains = atoms(t).select("pdb", "chain").distinct()
    short = chains.filter(is_short()).select("pdb", F.concat_ws("-", "pdb", "chain").alias("id"), F.col("chain").alias("_pep"))
    sets = short.join(chains, "pdb").filter(~is_short() | (F.col("chain") == F.col("_pep")))
    roles = sets.select("id", "pdb", "chain", F.when(is_short(), "peptide").otherwise("protein").alias("role"))
    places = atoms(t, DENSE).select("pdb", "chain", "x", "y", "z", "radius")
    return energy.buried_surface(surface.chain_areas(places, roles, "pdb", n_points=POINTS))


@query("bsa_filter", """SELECT l_orderkey AS id, l_linenumber AS n, (l_quantity - 2) / 1000.0::DOUBLE AS "BSA" FROM lineitem WHERE round((l_quantity - 2) / 1000.0::DOUBLE, 2) > 0""")
def _bsa_filter(t: Tables):
    rows = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), ((F.col("l_quantity") - 2) / 1000.0).alias("BSA"))
    return energy.bsa_filter(rows)


REFERENCE_CASE = "CASE resname " + " ".join(f"WHEN '{r}' THEN {a}::DOUBLE" for r, a in fv.REFERENCE_AREA.items()) + " END"


@query("surface_share", f"""WITH {A}, r AS (SELECT pdb AS id, resname, y AS area, z > 50 AS in_interface, {SURFACE_CASE} AS cls, {REFERENCE_CASE} AS ref FROM atoms)
SELECT id, round(100.0::DOUBLE * avg(CASE WHEN cls = 'apolar' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS nis_apolar,
  round(100.0::DOUBLE * avg(CASE WHEN cls = 'charged' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS nis_charged FROM r
WHERE NOT in_interface AND area / ref >= {fv.EXPOSED_SHARE} AND cls <> '' GROUP BY id""")
def _surface_share(t: Tables):
    rows = atoms(t).select(F.col("pdb").alias("id"), "resname", F.col("y").alias("area"), (F.col("z") > 50).alias("in_interface"))
    return energy.surface_share(rows)


@query("struct_signature", f"""WITH {A}, d AS (SELECT a.pdb, least(a.kind, b.kind) AS lo, greatest(a.kind, b.kind) AS hi, sqrt({D2}) AS dist
  FROM atoms a JOIN atoms b ON a.pdb = b.pdb AND a.pos < b.pos AND {D2} <= 100.0 AND a.chain < 'C' AND b.chain < 'C'),
h AS (SELECT pdb, lo * 8 - (lo * (lo - 1)) // 2 + (hi - lo) AS pair, least(greatest(ceil(dist / 0.2::DOUBLE) - 1, 0), 49)::INTEGER AS bin, count(*) AS n FROM d GROUP BY ALL),
grid AS (SELECT pdb, pair, unnest(range(50)) AS bin FROM (SELECT DISTINCT pdb, pair FROM h) s),
cum AS (SELECT g.pdb, g.pair, g.bin, sum(coalesce(n, 0)) OVER (PARTITION BY g.pdb, g.pair ORDER BY g.bin) AS v FROM grid g LEFT JOIN h USING (pdb, pair, bin))
SELECT pdb AS id, (pair * 50 + bin)::INTEGER AS pos, v::DOUBLE AS value FROM cum WHERE v <> 0""")
def _struct_signature(t: Tables):
    kinds = atoms(t).filter(F.col("chain") < "C").select(F.col("pdb").alias("id"), "pos", F.col("kind").alias("cls"), "x", "y", "z")
    long = signature3d.struct_signature(kinds).select("id", F.posexplode("vec").alias("pos", "value"))
    return long.filter(F.col("value") != 0)


# ---- residues and chains ------------------------------------------------------------------------------

FIRST_SQL = "first_m AS (SELECT pdb, min(model) AS m FROM atoms GROUP BY 1), one AS (SELECT a.* FROM atoms a JOIN first_m f ON a.pdb = f.pdb AND a.model = f.m)"


def _residue_sql(source: str) -> str:
    return f"""poly AS (SELECT pdb, chain, resseq, bool_or(label_seq IS NOT NULL AND label_seq NOT IN ('.', '?')) AS num FROM {source} GROUP BY ALL),
bad AS (SELECT pdb, bool_or(label_seq IS NULL) OR NOT bool_or(label_seq IS NOT NULL AND label_seq NOT IN ('.', '?')) AS fallback FROM {source} GROUP BY 1),
places AS (SELECT pdb, chain, resseq, icode, CASE WHEN group_pdb = 'HETATM' THEN resname ELSE '' END AS hetero, arg_max(resname, pos) AS resname, min(pos) AS pos FROM {source} GROUP BY ALL),
residues AS (SELECT a.pdb, a.chain, a.resseq, a.icode, a.resname, a.pos FROM places a JOIN poly USING (pdb, chain, resseq) JOIN bad USING (pdb)
  WHERE CASE WHEN fallback THEN a.resname IN ({NAMES}) ELSE num END)"""


@query("first_model", f"WITH {A}, {FIRST_SQL} SELECT pdb, model, chain, resseq, pos, round(x, 6) AS x FROM one")
def _first_model(t: Tables):
    return structure.first_model(atoms(t)).select("pdb", "model", "chain", "resseq", "pos", F.round("x", 6).alias("x"))


@query("polymer_residues", f"WITH {A}, {_residue_sql('atoms')} SELECT * FROM residues")
def _polymer_residues(t: Tables):
    return structure.polymer_residues(atoms(t))


LETTER_SQL = "CASE upper(resname) " + " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in fv.THREE_TO_ONE.items()) + " ELSE 'X' END"


@query("residue_code", f"WITH {A} SELECT resname, {LETTER_SQL} AS code, count(*) AS n FROM atoms GROUP BY ALL")
def _residue_code(t: Tables):
    from ..functions.text import residue_code

    return atoms(t).groupBy("resname", residue_code(F.col("resname")).alias("code")).agg(F.count("*").alias("n"))


SEQUENCE_SQL = f"chain_seq AS (SELECT pdb, chain, string_agg({LETTER_SQL}, '' ORDER BY pos, resseq, icode, {LETTER_SQL}) AS seq, count(*)::INTEGER AS size FROM residues GROUP BY 1, 2)"


@query("chain_sequence", f"WITH {A}, {_residue_sql('atoms')}, {SEQUENCE_SQL} SELECT * FROM chain_seq")
def _chain_sequence(t: Tables):
    return structure.chain_sequence(structure.polymer_residues(atoms(t)))


ROLE_SQL = "CASE WHEN size BETWEEN 2 AND 50 THEN 'peptide' WHEN size >= 51 THEN 'protein' END"


@query("chain_role", f"WITH {A}, {_residue_sql('atoms')}, {SEQUENCE_SQL} SELECT pdb, chain, size, {ROLE_SQL} AS role, size BETWEEN 2 AND 50 AS is_peptide, size >= 51 AS is_protein FROM chain_seq")
def _chain_role(t: Tables):
    return structure.chain_role(structure.chain_sequence(structure.polymer_residues(atoms(t)))).drop("seq")


@query("count_atoms", f"WITH {A} SELECT pdb, count(*) AS n_atoms FROM atoms WHERE group_pdb IN ('ATOM', 'HETATM') GROUP BY 1")
def _count_atoms(t: Tables):
    return structure.count_atoms(atoms(t))


@query("size_gate", """WITH c AS (SELECT l_orderkey, count(*) AS n_atoms FROM lineitem GROUP BY 1)
SELECT o_orderkey AS pdb, CASE WHEN coalesce(n_atoms, 0) > 6 THEN 'oversized' ELSE 'kept' END AS part, CASE WHEN coalesce(n_atoms, 0) > 6 THEN n_atoms ELSE 0 END AS n_atoms
FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def _size_gate(t: Tables):
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("pdb")).agg(F.count("*").alias("n_atoms"))
    kept, over = structure.size_gate(t.orders.select(F.col("o_orderkey").alias("pdb")), counts, 6)
    return kept.select("pdb", F.lit("kept").alias("part"), F.lit(0).cast("long").alias("n_atoms")).unionByName(over.withColumn("part", F.lit("oversized")))


@query("chain_label_map", f"""WITH {A} SELECT pdb, chain, arg_min(label_chain, pos) AS label FROM atoms WHERE group_pdb = 'ATOM' GROUP BY 1, 2""")
def _chain_label_map(t: Tables):
    return structure.chain_label_map(atoms(t))


@query("structure_tables", f"""WITH {A}, {CHAIN_PAIR_SQL},
sets AS (SELECT id, pdb, pep_chain AS chain FROM pairs UNION SELECT id, pdb, prot_chain FROM pairs)
SELECT s.id, a.pdb, a.chain, count(*) AS n, sum(resseq)::BIGINT AS numbers FROM atoms a JOIN sets s ON a.pdb = s.pdb AND a.chain = s.chain
WHERE a.resname IN ({NAMES}) GROUP BY ALL""")
def _structure_tables(t: Tables):
    sets = chain_pairs(t).select("id", "pdb", F.explode(F.array("pep_chain", "prot_chain")).alias("chain"))
    return structure.structure_tables(atoms(t), sets).groupBy("id", "pdb", "chain").agg(F.count("*").alias("n"), F.sum("resseq").alias("numbers"))


BUILD_SQL = f"""{A}, {FIRST_SQL}, {_residue_sql('one')}, {SEQUENCE_SQL}, roles AS (SELECT *, {ROLE_SQL} AS role FROM chain_seq),
numbers AS (SELECT DISTINCT pdb, chain, resseq FROM residues),
pa AS (SELECT o.pdb, o.chain, x, y, z FROM one o JOIN numbers USING (pdb, chain, resseq) JOIN roles r ON r.pdb = o.pdb AND r.chain = o.chain AND role = 'peptide'),
qa AS (SELECT o.pdb, o.chain, x, y, z FROM one o JOIN roles r ON r.pdb = o.pdb AND r.chain = o.chain AND role = 'protein'),
hit AS (SELECT DISTINCT a.pdb, a.chain AS pep_chain, b.chain AS prot_chain FROM pa a JOIN qa b ON a.pdb = b.pdb AND a.chain <> b.chain AND {D2} <= 36.0),
built AS (SELECT h.pdb || '-' || pep_chain || '-' || prot_chain AS id, h.pdb, pep_chain, prot_chain, p.size AS pep_size, q.size AS prot_size, p.seq AS pep_seq, q.seq AS prot_seq
  FROM hit h JOIN roles p ON p.pdb = h.pdb AND p.chain = pep_chain JOIN roles q ON q.pdb = h.pdb AND q.chain = prot_chain)"""


@query("build_pairs", f"WITH {BUILD_SQL} SELECT * FROM built")
def _build_pairs(t: Tables):
    return build.build_pairs(atoms(t))


@query("build_multi", f"""WITH {BUILD_SQL}
SELECT pdb || '-' || pep_chain AS cluster_id, count(*)::INTEGER AS count, string_agg(id, ':' ORDER BY prot_chain) AS items, string_agg(prot_size::VARCHAR, ':' ORDER BY prot_chain) AS "PROTEIN_SIZE"
FROM built GROUP BY pdb, pep_chain HAVING count(DISTINCT prot_chain) >= 2""")
def _build_multi(t: Tables):
    return groups.multi_group(build.build_pairs(atoms(t))).select("cluster_id", "count", "items", "PROTEIN_SIZE")
