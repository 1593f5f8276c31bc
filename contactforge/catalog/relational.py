"""Membership, joins, grouping, validation and incremental state over the business tables."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text
from ..operators import bloom, clusters, features, groups, interfaces, membership, quality, workers
from ..plans import build, committed, publish, release_tree
from ..plans.bucketed import bucketed
from ..session import staged
from ..sources import delimited
from ..streaming import incremental
from .base import Tables, query, written

# ---- selections and membership --------------------------------------------------------------------


@query("candidate_select", """
SELECT 'O' || o_orderkey::VARCHAR AS pdb FROM orders
WHERE o_orderdate <= TIMESTAMP '1999-06-30 00:00:00'
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R' AND l_quantity >= 40)
INTERSECT
SELECT 'O' || o_orderkey::VARCHAR FROM orders
WHERE o_orderdate <= TIMESTAMP '1999-06-30 00:00:00'
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 3)""")
def _candidate_select(t: Tables):
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("chains"))
    entries = t.orders.join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.concat(F.lit("O"), "o_orderkey").alias("pdb"), F.col("o_orderdate").cast("date").alias("release_date"), "chains"
    )
    entities = t.lineitem.select(
        F.concat(F.lit("O"), "l_orderkey").alias("pdb"), F.col("l_quantity").alias("length"),
        F.when(F.col("l_returnflag") != "R", "Protein").otherwise("Other").alias("polymer_type"),
    )
    return membership.candidate_select(entries, entities, "1999-06-30", 40, 3)


@query("oracle_recall", """
WITH o AS (SELECT DISTINCT upper(source) || '-' || doc_id::VARCHAR AS pdb FROM documents),
c AS (SELECT DISTINCT upper(d.source) || '-' || d.doc_id::VARCHAR AS pdb FROM documents d JOIN labels USING (doc_id))
SELECT count(*) AS oracle_size, count(*) FILTER (WHERE c.pdb IS NULL) AS oracle_missing,
       round(1 - count(*) FILTER (WHERE c.pdb IS NULL) / count(*)::DOUBLE, 4) AS recall
FROM o LEFT JOIN c USING (pdb)""")
def _oracle_recall(t: Tables):
    name = F.concat_ws("-", "source", "doc_id").alias("pdb")
    return membership.oracle_recall(t.documents.join(t.labels, "doc_id").select(name), t.documents.select(name))[1]


@query("snapshot_sample", """
WITH pool AS (SELECT DISTINCT 'D' || doc_id::VARCHAR AS pdb FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT pdb FROM (SELECT pdb FROM pool ORDER BY md5('42:' || pdb), pdb LIMIT 300) s""")
def _snapshot_sample(t: Tables):
    name = F.concat(F.lit("D"), "doc_id").alias("pdb")
    return membership.snapshot_sample(t.documents.select(name), t.labels.select(name), 300, 42)


@query("acquire_status_tally", """
SELECT split_part(status, ':', 1) AS status, count(*) AS n, split_part(status, ':', 1) IN ('failed', 'not_found') AS is_failure
FROM (SELECT CASE event_type WHEN 'error' THEN 'failed:' || user_id::VARCHAR WHEN 'view' THEN 'not_found'
        WHEN 'click' THEN 'skipped' ELSE 'downloaded' END AS status FROM events) s
GROUP BY ALL""")
def _acquire_status_tally(t: Tables):
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", F.concat(F.lit("failed:"), "user_id")).when(kind == "view", "not_found")
        .when(kind == "click", "skipped").otherwise("downloaded")
    )
    return membership.acquire_status_tally(t.events.select(status.alias("status")))


@query("master_semi", """
SELECT o_orderkey AS id, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""")
def _master_semi(t: Tables):
    pairs = t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice")
    return membership.master_semi(pairs, t.lineitem.filter(F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("id")))


@query("missing_files", "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _missing_files(t: Tables):
    return membership.missing_files(t.documents.select(F.col("doc_id").alias("id")), t.labels.select(F.col("doc_id").alias("id")))


@query("stale_prune", "SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09)")
def _stale_prune(t: Tables):
    return membership.stale_prune(
        t.part.select(F.col("p_partkey").alias("id")),
        t.lineitem.filter(F.col("l_discount") > 0.09).select(F.col("l_partkey").alias("id")),
    )


@query("incremental_todo", """
WITH done AS (SELECT o_orderkey AS id, substr(sha1('2|cutoff=' || o_orderstatus), 1, 12) AS signature FROM orders)
SELECT o_orderkey AS id, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT id FROM done WHERE signature = substr(sha1('2|cutoff=F'), 1, 12))""")
def _incremental_todo(t: Tables):
    """Stores a record an order under its own signature, with the filters beside, and asks for one of them."""
    import hashlib

    def signature(status: str) -> str:
        return hashlib.sha1(f"2|cutoff={status}".encode()).hexdigest()[:12]

    path = written(t)
    for status in ("F", "O", "P"):
        records = t.orders.filter(F.col("o_orderstatus") == status).select(F.col("o_orderkey").alias("id"), F.lit("ok").alias("status"), F.lit("").alias("record"))
        incremental.append_records(records, path, "contacts", signature(status))
    return incremental.unrecorded(t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey"), path, "contacts", signature("F"))


@query("set_intersect", "SELECT doc_id AS id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def _set_intersect(t: Tables):
    return membership.set_intersect(
        t.documents.select(F.col("doc_id").alias("id")), t.labels.filter("quality = 1").select(F.col("doc_id").alias("id"))
    )


@query("set_except", "SELECT p_partkey AS id FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30")
def _set_except(t: Tables):
    used = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 30").select(F.col("l_partkey").alias("id"))
    return membership.set_except(t.part.select(F.col("p_partkey").alias("id")), used)


@query("set_union_distinct", "SELECT text AS seq FROM documents UNION SELECT text FROM benchmark UNION SELECT text FROM conversations")
def _set_union_distinct(t: Tables):
    train = membership.set_union_distinct(t.documents.select(F.col("text").alias("seq")), t.benchmark.select(F.col("text").alias("seq")))
    return membership.set_union_distinct(train, t.conversations.select(F.col("text").alias("seq")))


@query("union_cached_new", """
SELECT o_orderkey AS id, 'cached' AS origin, o_totalprice AS value FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL SELECT o_orderkey, 'new', o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'""")
def _union_cached_new(t: Tables):
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), "o_orderdate")
    old = rows.filter("o_orderdate < '1998-01-01'").select("id", F.lit("cached").alias("origin"), "value")
    return membership.union_cached_new(old, rows.filter("o_orderdate >= '1998-01-01'").select("id", F.lit("new").alias("origin"), "value"))


@query("variant_cutoffs", """
WITH v(variant, distance, energy_distance, bsa, pep_max, prot_min) AS (VALUES
  ('', 6.0, 6.0, 0.0, 50.0, 51.0), ('dist5', 5.0, 5.0, 0.0, 50.0, 51.0), ('dist8', 8.0, 8.0, 0.0, 50.0, 51.0),
  ('bsa10', 6.0, 6.0, 10.0, 50.0, 51.0), ('pep2_30', 6.0, 6.0, 0.0, 30.0, 31.0))
SELECT variant, energy_distance::DOUBLE AS energy_distance,
       count(*) FILTER (WHERE l_quantity <= pep_max) AS short, count(*) FILTER (WHERE l_tax * 100 <= distance) AS near
FROM lineitem CROSS JOIN v GROUP BY variant, energy_distance""")
def _variant_cutoffs(t: Tables):
    rows = F.array(*[
        F.struct(F.lit(n).alias("variant"), *[F.lit(float(c[k])).alias(k) for k in ("energy_distance", "distance", "pep_max")])
        for n, c in membership.variant_cutoffs().items()
    ])
    crossed = t.lineitem.select("l_quantity", "l_tax", F.inline(rows))
    return crossed.groupBy("variant", "energy_distance").agg(
        F.count(F.when(F.col("l_quantity") <= F.col("pep_max"), 1)).alias("short"),
        F.count(F.when(F.col("l_tax") * 100 <= F.col("distance"), 1)).alias("near"),
    )


@query("method_filter", """
SELECT DISTINCT 'C' || o_custkey::VARCHAR AS pdb FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _method_filter(t: Tables):
    pairs = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("C"), "o_custkey").alias("pdb"))
    meta = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("STRUCTURE_METHOD"))
    from ..operators.structure import method_filter

    return method_filter(pairs, meta, "1-URGENT")


@query("ordered_output", "SELECT o_orderpriority AS pdb, o_orderkey AS pep, o_totalprice FROM orders")
def _ordered_output(t: Tables):
    df = t.orders.select(F.col("o_orderpriority").alias("pdb"), F.col("o_orderkey").alias("pep"), "o_totalprice")
    return membership.ordered_output(df, ["pdb", "pep"])


# ---- joins and reshaping --------------------------------------------------------------------------


@query("attach_features", """
SELECT o_orderkey AS id, o_orderstatus, coalesce(c_mktsegment, '') AS segment, coalesce(flags, '') AS flags, items
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS flags, count(*) AS items FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey""")
def _attach_features(t: Tables):
    master = t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    segment = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("c_mktsegment").alias("segment")
    )
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_returnflag").alias("flags"), F.count("*").alias("items"))
    return features.attach_features(master, {"segment": segment, "lines": lines})


@query("long_to_wide", """
SELECT l_orderkey AS id, max(q) FILTER (WHERE l_returnflag = 'A') AS A_qty, max(p) FILTER (WHERE l_returnflag = 'A') AS A_price,
       max(q) FILTER (WHERE l_returnflag = 'R') AS R_qty, max(p) FILTER (WHERE l_returnflag = 'R') AS R_price
FROM (SELECT l_orderkey, l_returnflag, sum(l_quantity) AS q, round(max(l_extendedprice), 2) AS p FROM lineitem GROUP BY 1, 2) s
GROUP BY l_orderkey""")
def _long_to_wide(t: Tables):
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("chain_type")).agg(
        F.sum("l_quantity").alias("qty"), F.round(F.max("l_extendedprice"), 2).alias("price")
    )
    return features.long_to_wide(rows, ["qty", "price"], kinds=("A", "R"))


@query("pdb_fanout", """
SELECT o_orderkey AS id, 'C' || o_custkey::VARCHAR AS pdb, n_name, c_acctbal FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def _pdb_fanout(t: Tables):
    pairs = t.orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("C"), "o_custkey").alias("pdb"))
    record = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("C"), "c_custkey").alias("pdb"), "n_name", "c_acctbal"
    )
    return features.pdb_fanout(pairs, record)


ENTITY_SQL = """poly AS (SELECT 'O' || l_orderkey::VARCHAR AS pdb, l_orderkey * 100000 + l_partkey AS pos, l_partkey AS entity,
    l_returnflag || ',' || l_linestatus || l_returnflag AS strands FROM lineitem),
strand AS (SELECT pdb, pos, entity, unnest(string_split(strands, ',')) AS chain FROM poly),
chain_entity AS (SELECT pdb, chain, arg_max(entity, pos) AS entity FROM strand GROUP BY 1, 2),
entities AS (SELECT DISTINCT 'O' || l_orderkey::VARCHAR AS pdb, l_partkey AS entity, p_name AS description FROM lineitem JOIN part ON p_partkey = l_partkey),
src AS (SELECT 'O' || l_orderkey::VARCHAR AS pdb, l_orderkey * 100000 + l_partkey AS pos, l_partkey AS entity,
    CASE WHEN p_type LIKE 'S%' THEN 2 WHEN p_type LIKE 'M%' THEN 1 ELSE 0 END AS r,
    CASE WHEN p_size > 25 THEN p_brand WHEN p_size > 15 THEN '?' ELSE '' END AS name
  FROM lineitem JOIN part ON p_partkey = l_partkey),
named AS (SELECT * FROM src WHERE name NOT IN ('', '?', '.')),
ent_org AS (SELECT pdb, entity, arg_min(name, r::BIGINT * 1000000000000 + pos) AS org FROM named GROUP BY 1, 2),
any_org AS (SELECT pdb, arg_min(name, r::BIGINT * 1000000000000 + pos) AS org FROM named GROUP BY 1),
chain_info AS (SELECT c.pdb, c.chain, e.description, o.org FROM chain_entity c
  LEFT JOIN entities e USING (pdb, entity) LEFT JOIN ent_org o USING (pdb, entity)),
resolved AS (SELECT o_orderkey AS id, coalesce(a.description, '') AS PEPTIDE_DESC, coalesce(b.description, '') AS PROTEIN_DESC,
  upper(coalesce(b.org, g.org, '')) AS organism, upper(coalesce(a.org, g.org, '')) AS PEPTIDE_ORGANISM,
  upper(coalesce(b.org, g.org, '')) AS PROTEIN_ORGANISM
FROM orders LEFT JOIN chain_info a ON a.pdb = 'O' || o_orderkey::VARCHAR AND a.chain = 'A'
LEFT JOIN chain_info b ON b.pdb = 'O' || o_orderkey::VARCHAR AND b.chain = 'OR'
LEFT JOIN any_org g ON g.pdb = 'O' || o_orderkey::VARCHAR)"""


def _entities(t: Tables):
    """Pairs, chain lists, descriptions and source organisms of one structure per order."""
    pdb = F.concat(F.lit("O"), "l_orderkey").alias("pdb")
    pos = (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("pos")
    pairs = t.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("O"), "o_orderkey").alias("pdb"), F.lit("A").alias("pep_chain"), F.lit("OR").alias("prot_chain")
    )
    strands = F.concat("l_returnflag", F.lit(","), "l_linestatus", "l_returnflag").alias("strands")
    poly = t.lineitem.select(pdb, pos, F.col("l_partkey").alias("entity"), strands)
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    entity = lines.select(pdb, F.col("l_partkey").alias("entity"), F.col("p_name").alias("description")).distinct()
    kind = F.when(F.col("p_type").startswith("S"), "syn").when(F.col("p_type").startswith("M"), "nat").otherwise("gen")
    name = F.when(F.col("p_size") > 25, F.col("p_brand")).when(F.col("p_size") > 15, "?").otherwise("")
    sources = lines.select(pdb, pos, F.col("l_partkey").alias("entity"), kind.alias("kind"), name.alias("name"))
    return pairs, poly, entity, sources


@query("entity_resolve", f"WITH {ENTITY_SQL} SELECT * FROM resolved")
def _entity_resolve(t: Tables):
    return features.entity_resolve(*_entities(t))


_HEADER = {
    "a.title": ("_struct.title", "'?'"), "b.title": ("_struct.title", "concat(o_orderpriority, chr(9), 'of ', cast(o_orderkey as string))"),
    "c.title": ("_struct.title", "'a later one'"), "keywords": ("_struct_keywords.pdbx_keywords", "o_orderstatus"),
    "method": ("_exptl.method", "case when o_custkey % 2 = 0 then 'X-RAY DIFFRACTION' else '.' end"),
    "date": ("_pdbx_database_status.recvd_initial_deposition_date", "cast(cast(o_orderdate as date) as string)"),
    "refine": ("_refine.ls_d_res_high", "case when o_orderkey % 3 = 0 then '?' else concat(cast(o_orderkey % 40 as string), '.50') end"),
    "reflns": ("_reflns.d_resolution_high", "case when o_orderkey % 2 = 0 then '' else concat(cast(o_orderkey % 7 as string), '.0') end"),
    "em": ("_em_3d_reconstruction.resolution", "case when o_orderkey % 5 = 0 then 'n/a' end"), "other": ("_cell.length_a", "'90.1'"),
}


@query("build_metadata", f"""WITH {ENTITY_SQL},
heads AS (SELECT o_orderkey AS id, o_orderstatus, o_orderpriority || ' of ' || o_orderkey::VARCHAR AS title, o_orderdate, o_custkey,
  CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 40)::VARCHAR || '.5' WHEN o_orderkey % 2 <> 0 THEN (o_orderkey % 7)::VARCHAR || '.0'
    WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE '' END AS resolution FROM orders WHERE o_orderkey % 11 <> 0)
SELECT id, o_orderstatus AS "CLASSIFICATION", o_orderdate::DATE::VARCHAR AS "DEPOSITION_DATE", resolution AS "RESOLUTION",
  CASE WHEN o_custkey % 2 = 0 THEN 'X-RAY DIFFRACTION' ELSE '' END AS "STRUCTURE_METHOD", title AS "TITLE", organism,
  "PEPTIDE_ORGANISM", "PROTEIN_ORGANISM", "PEPTIDE_DESC", "PROTEIN_DESC" FROM heads JOIN resolved USING (id)""")
def _build_metadata(t: Tables):
    """Headers as items in long form; every eleventh order has no readable header."""
    rows = [F.struct(F.lit(i).alias("pos"), F.lit(item).alias("item"), F.expr(value).alias("value")) for i, (item, value) in enumerate(_HEADER.values())]
    items = t.orders.filter("o_orderkey % 11 <> 0").select(F.concat(F.lit("O"), "o_orderkey").alias("pdb"), F.inline(F.array(*rows)))
    pairs, poly, entity, sources = _entities(t)
    return build.build_metadata(pairs, items, poly, entity, sources)


INTERFACES_SQL = """faces AS (
  SELECT 'N' || (s_suppkey % 25)::VARCHAR AS pdb, l_orderkey * 10 + l_linenumber AS pos,
         'N' || s_nationkey::VARCHAR AS chain_1, 'P' || (l_partkey % 7)::VARCHAR AS chain_2,
         CASE WHEN l_tax = 0 THEN 'n/a' ELSE l_quantity::INTEGER::VARCHAR END AS area
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)"""


def _faces(t: Tables):
    area = F.when(F.col("l_tax") == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string"))
    return t.lineitem.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.concat(F.lit("N"), F.col("s_suppkey") % 25).alias("pdb"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.concat(F.lit("N"), "s_nationkey").alias("chain_1"), F.concat(F.lit("P"), F.col("l_partkey") % 7).alias("chain_2"),
        area.alias("area"),
    )


@query("unordered_chain_cross", f"""
WITH {INTERFACES_SQL},
pairs AS (SELECT 'N' || (c_custkey % 25)::VARCHAR AS pdb, c_custkey AS id, 'P' || (c_custkey % 7)::VARCHAR AS pep_chain,
  'N' || c_nationkey::VARCHAR AS prot_chain FROM customer),
best AS (SELECT pdb, least(chain_1, chain_2) AS lo, greatest(chain_1, chain_2) AS hi, pos, area,
  row_number() OVER (PARTITION BY pdb, least(chain_1, chain_2), greatest(chain_1, chain_2)
    ORDER BY coalesce(try_cast(area AS DOUBLE), -1) DESC, pos, area) AS rn FROM faces)
SELECT p.id, b.area, b.pos FROM pairs p JOIN best b ON p.pdb = b.pdb AND b.rn = 1
  AND b.lo = least(p.pep_chain, p.prot_chain) AND b.hi = greatest(p.pep_chain, p.prot_chain)""")
def _unordered_chain_cross(t: Tables):
    pairs = t.customer.select(
        F.concat(F.lit("N"), F.col("c_custkey") % 25).alias("pdb"), F.col("c_custkey").alias("id"),
        F.concat(F.lit("P"), F.col("c_custkey") % 7).alias("pep_chain"), F.concat(F.lit("N"), "c_nationkey").alias("prot_chain"),
    )
    return interfaces.unordered_chain_cross(pairs, _faces(t)).select("id", "area", "pos")


@query("assembly_match", """
WITH asm AS (SELECT 'O' || l_orderkey::VARCHAR AS pdb, l_orderkey * 1000000 + l_partkey AS pos, l_returnflag || l_linestatus AS composition,
  l_partkey::DOUBLE AS diss_energy FROM lineitem),
first_one AS (SELECT pdb, array_to_string(list_sort(string_split(composition, '')), '') AS k, arg_min(diss_energy, pos) AS diss_energy, min(pos) AS pos
  FROM asm GROUP BY 1, 2)
SELECT o_orderkey AS id, f.pos, f.diss_energy FROM orders
JOIN first_one f ON f.pdb = 'O' || o_orderkey::VARCHAR AND f.k = array_to_string(list_sort(string_split(o_orderstatus || 'A', '')), '')""")
def _assembly_match(t: Tables):
    asm = t.lineitem.select(
        F.concat(F.lit("O"), "l_orderkey").alias("pdb"), (F.col("l_orderkey") * 1000000 + F.col("l_partkey")).alias("pos"),
        F.concat("l_returnflag", "l_linestatus").alias("composition"), F.col("l_partkey").cast("double").alias("diss_energy"),
    )
    pairs = t.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("O"), "o_orderkey").alias("pdb"), F.col("o_orderstatus").alias("pep_chain"), F.lit("A").alias("prot_chain")
    )
    return interfaces.assembly_match(pairs, asm).select("id", "pos", "diss_energy")


@query("oracle_inner", """
SELECT d.doc_id AS id, d.n_chars, l.quality AS oracle_quality, l.toxic AS oracle_toxic FROM documents d JOIN labels l USING (doc_id)""")
def _oracle_inner(t: Tables):
    ours = t.documents.select(F.col("doc_id").alias("id"), "n_chars")
    return quality.oracle_inner(ours, t.labels.withColumnRenamed("doc_id", "id"))


def _releases(t: Tables):
    old = t.customer.filter("c_acctbal > -500").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", F.lit("x").alias("dropped"))
    segment = F.when(F.col("c_acctbal") > 8000, "REVIEW").when(F.col("c_nationkey") == 3, F.lit(None)).otherwise(F.col("c_mktsegment"))
    new = t.customer.filter("c_acctbal < 9000").select(F.col("c_custkey").alias("id"), "c_name", segment.alias("c_mktsegment"))
    return new, old


RELEASES_SQL = """prev AS (SELECT c_custkey AS id, c_name, c_mktsegment FROM customer WHERE c_acctbal > -500),
cur AS (SELECT c_custkey AS id, c_name, CASE WHEN c_acctbal > 8000 THEN 'REVIEW' WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_acctbal < 9000)"""


DIFF_SQL = f"""
WITH {RELEASES_SQL}
SELECT count(p.id) AS prev_n, count(c.id) AS cur_n, count(*) FILTER (WHERE p.id IS NULL) AS added,
  count(*) FILTER (WHERE c.id IS NULL) AS removed, count(*) FILTER (WHERE p.id IS NOT NULL AND c.id IS NOT NULL) AS common,
  count(*) FILTER (WHERE p.id IS NOT NULL AND c.id IS NOT NULL AND (coalesce(p.c_name, '') <> coalesce(c.c_name, '')
    OR coalesce(p.c_mktsegment, '') <> coalesce(c.c_mktsegment, ''))) AS changed
FROM cur c FULL OUTER JOIN prev p ON c.id = p.id"""


@query("release_diff", DIFF_SQL)
def _release_diff(t: Tables):
    return quality.release_diff(*_releases(t))


@query("release_tree_diff", DIFF_SQL)
def _release_tree_diff(t: Tables):
    """Both releases are written with their trees; only buckets that differ are read back."""
    new, old = _releases(t)
    paths = written(t), written(t)
    for df, path in zip((new, old), paths):
        release_tree.write_release(df, path, buckets=64)
    return release_tree.release_tree_diff(t.spark, *paths)


# ---- groups ---------------------------------------------------------------------------------------


@query("exact_cluster", """
SELECT doc_id AS id, sha256(text) AS seq, min(doc_id) OVER w AS cnr_cluster, count(*) OVER w AS cnr_size,
  CASE WHEN doc_id = min(doc_id) OVER w THEN 'yes' ELSE 'no' END AS is_representative
FROM documents WINDOW w AS (PARTITION BY text)""")
def _exact_cluster(t: Tables):
    return groups.exact_cluster(t.documents, "doc_id", "text").withColumn("seq", F.sha2("seq", 256))


def _line_pairs(t: Tables):
    rows = t.lineitem.groupBy("l_orderkey", "l_returnflag", "l_suppkey").agg(F.max("l_partkey").alias("prot_size"), F.min("l_linestatus").alias("prot_seq"))
    pdb = F.concat(F.lit("O"), "l_orderkey")
    chain = F.concat(F.lit("s"), "l_suppkey")
    return rows.select(
        F.concat_ws("-", pdb, "l_returnflag", chain).alias("id"), pdb.alias("pdb"), F.col("l_returnflag").alias("pep_chain"),
        chain.alias("prot_chain"), (F.col("l_orderkey") % 50).alias("pep_size"), F.col("l_returnflag").alias("pep_seq"), "prot_size", "prot_seq",
    )


LINE_PAIRS_SQL = """pairs AS (
  SELECT 'O' || l_orderkey::VARCHAR || '-' || l_returnflag || '-s' || l_suppkey::VARCHAR AS id, 'O' || l_orderkey::VARCHAR AS pdb,
    l_returnflag AS pep_chain, 's' || l_suppkey::VARCHAR AS prot_chain, l_orderkey % 50 AS pep_size, l_returnflag AS pep_seq,
    max(l_partkey) AS prot_size, min(l_linestatus) AS prot_seq
  FROM lineitem GROUP BY l_orderkey, l_returnflag, l_suppkey)"""
MULTI_SQL = f"""{LINE_PAIRS_SQL},
multi AS (
  SELECT pdb || '-' || pep_chain AS cluster_id, count(*)::INTEGER AS count, string_agg(id, ':' ORDER BY prot_chain) AS items, pdb AS PDB_ID,
    pep_chain AS PEPTIDE_CHAIN, string_agg(prot_chain, ':' ORDER BY prot_chain) AS PROTEIN_CHAIN, arg_min(pep_size, prot_chain) AS PEPTIDE_SIZE,
    arg_min(pep_seq, prot_chain) AS PEPTIDE_SEQ, string_agg(prot_size::VARCHAR, ':' ORDER BY prot_chain) AS PROTEIN_SIZE,
    string_agg(prot_seq, ':' ORDER BY prot_chain) AS PROTEIN_SEQ
  FROM pairs GROUP BY pdb, pep_chain HAVING count(DISTINCT prot_chain) >= 2)"""


@query("multi_group", f"WITH {MULTI_SQL} SELECT * FROM multi")
def _multi_group(t: Tables):
    return groups.multi_group(_line_pairs(t))


ITEM_CLASS = """CASE WHEN prot_size % 5 = 0 THEN 'crystal-packing' WHEN prot_size % 5 = 1 THEN 'not_applicable' WHEN prot_size % 5 = 2 THEN ''
  WHEN prot_size % 7 = 3 THEN 'biological' WHEN prot_size % 7 = 4 THEN 'indeterminate' ELSE 'crystal-packing' END"""


def _item_classes(t: Tables):
    return groups.multi_members(_line_pairs(t)).select("cluster_id", F.col("prot_chain").alias("pos"), F.expr(ITEM_CLASS).alias("class"))


@query("aggregate_class", f"""
WITH {LINE_PAIRS_SQL}, c AS (SELECT pdb || '-' || pep_chain AS cluster_id, prot_chain AS pos, {ITEM_CLASS} AS class FROM pairs),
g AS (SELECT cluster_id, list(class ORDER BY pos) AS cs FROM c GROUP BY 1 HAVING count(*) >= 2)
SELECT cluster_id, CASE WHEN list_contains(cs, 'biological') THEN 'biological'
  WHEN list_distinct(cs) = ['not_applicable'] THEN 'not_applicable'
  WHEN len(list_filter(cs, lambda x: x NOT IN ('', 'not_applicable'))) = 0
    THEN CASE WHEN list_contains(cs, 'not_applicable') THEN 'not_applicable' ELSE '' END
  WHEN len(list_filter(cs, lambda x: x NOT IN ('', 'not_applicable', 'crystal-packing'))) = 0 THEN 'crystal-packing'
  ELSE 'indeterminate' END AS class, array_to_string(cs, ':') AS class_per_chain FROM g""")
def _aggregate_class(t: Tables):
    return groups.aggregate_class(_item_classes(t))


@query("multi_assemble", f"""
WITH {MULTI_SQL},
feat AS (SELECT id, prot_size * 3 AS mw, CASE WHEN prot_size % 3 = 0 THEN NULL ELSE prot_seq || prot_chain END AS descr FROM pairs),
item AS (SELECT cluster_id, unnest(string_split(items, ':')) AS id, unnest(range(len(string_split(items, ':')))) AS pos FROM multi)
SELECT i.cluster_id, string_agg(coalesce(f.mw::VARCHAR, ''), ':' ORDER BY i.pos) AS mw, string_agg(coalesce(f.descr, ''), ':' ORDER BY i.pos) AS descr
FROM item i LEFT JOIN feat f USING (id) GROUP BY 1""")
def _multi_assemble(t: Tables):
    pairs = _line_pairs(t)
    feat = pairs.select("id", (F.col("prot_size") * 3).alias("mw"), F.when(F.col("prot_size") % 3 != 0, F.concat("prot_seq", "prot_chain")).alias("descr"))
    return groups.colon_values(groups.item_positions(groups.multi_group(pairs)), feat, ["mw", "descr"])


@query("home_counters", f"""
WITH {MULTI_SQL}, b AS (SELECT count(*) AS complexes, count(DISTINCT (prot_seq, pep_seq, prot_size)) AS unique_entries FROM
  (SELECT prot_seq || prot_size::VARCHAR AS prot_seq, pep_seq, prot_size FROM pairs) p)
SELECT complexes, unique_entries, complexes + (SELECT count(*) FROM multi) AS total, (SELECT count(*) FROM multi) AS multi,
  'Aug 30, 2026' AS updated FROM b""")
def _home_counters(t: Tables):
    pairs = _line_pairs(t)
    widened = pairs.withColumn("prot_seq", F.concat("prot_seq", "prot_size"))
    return quality.home_counters(widened, groups.multi_group(pairs), "2026-08-30")


# ---- validation -----------------------------------------------------------------------------------


def _measured(t: Tables):
    ours = t.part.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("MW"), F.col("p_size").cast("string").alias("pI"), F.col("p_brand").alias("brand"))
    worst = F.when(F.max("l_discount") > 0.099, "n/a").otherwise(F.round(F.avg("l_quantity")).cast("int").cast("string"))
    theirs = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(
        (F.floor(F.max("l_extendedprice") / 100)).cast("double").alias("MW"), worst.alias("pI"),
        F.concat(F.lit(" Brand#"), F.max("l_linenumber")).alias("brand"),
    )
    return ours, theirs


MEASURED_SQL = """ours AS (SELECT p_partkey AS id, p_retailprice AS MW, p_size::VARCHAR AS pI, p_brand AS brand FROM part),
theirs AS (SELECT l_partkey AS id, floor(max(l_extendedprice) / 100) AS MW,
  CASE WHEN max(l_discount) > 0.099 THEN 'n/a' ELSE round(avg(l_quantity))::INTEGER::VARCHAR END AS pI,
  ' Brand#' || max(l_linenumber)::VARCHAR AS brand FROM lineitem GROUP BY 1)"""
TOLERANCE_SQL = """tol AS (SELECT count(*) AS n, count(*) FILTER (WHERE abs(o.MW - t.MW) <= 120.0) AS h0,
  count(*) FILTER (WHERE abs(try_cast(o.pI AS DOUBLE) - try_cast(t.pI AS DOUBLE)) <= 5.0) AS h1 FROM ours o JOIN theirs t USING (id)),
tolerance AS (SELECT 'MW' AS metric, h0 AS hits, n, round(100.0::DOUBLE * h0 / n, 1) AS pct FROM tol
  UNION ALL SELECT 'pI', h1, n, round(100.0::DOUBLE * h1 / n, 1) FROM tol)"""
EXACT_SQL = """ex AS (SELECT count(*) AS n, count(*) FILTER (WHERE trim(coalesce(o.pI, '')) = trim(coalesce(t.pI, ''))) AS h0,
  count(*) FILTER (WHERE trim(coalesce(o.brand, '')) = trim(coalesce(t.brand, ''))) AS h1 FROM ours o JOIN theirs t USING (id)),
exact AS (SELECT 'pI' AS "column", h0 AS hits, n, round(100.0::DOUBLE * h0 / n, 1) AS pct FROM ex
  UNION ALL SELECT 'brand', h1, n, round(100.0::DOUBLE * h1 / n, 1) FROM ex)"""
EXTRACTION_SQL = """exo AS (SELECT l_partkey AS id, max(l_quantity)::INTEGER::VARCHAR AS size, CASE WHEN max(l_linenumber) < 7 THEN 'Brand#' || (min(l_suppkey) % 5 + 1)::VARCHAR
  || (max(l_linenumber) % 5 + 1)::VARCHAR ELSE '' END AS seq FROM lineitem GROUP BY 1),
exm AS (SELECT count(*) AS n, count(*) FILTER (WHERE p_size::VARCHAR = size) AS h0, count(*) FILTER (WHERE p_brand = seq) AS h1 FROM part JOIN exo ON p_partkey = id),
extraction AS (SELECT 'size' AS metric, h0 AS hits, n, round(100.0::DOUBLE * h0 / n, 1) AS pct FROM exm UNION ALL SELECT 'sequence', h1, n, round(100.0::DOUBLE * h1 / n, 1) FROM exm)"""
SPECS = [("MW", "MW", 120.0), ("pI", "pI", 5.0)]


def _extracted(t: Tables):
    pairs = t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("pep_size"), F.col("p_brand").alias("pep_seq"))
    brand = F.concat(F.lit("Brand#"), F.min("l_suppkey") % 5 + 1, F.max("l_linenumber") % 5 + 1)
    before = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(
        F.max("l_quantity").cast("int").cast("string").alias("PEPTIDE_SIZE"), F.when(F.max("l_linenumber") < 7, brand).alias("PEPTIDE_SEQ"),
    )
    return pairs, before


@query("extraction_hits", f"WITH {EXTRACTION_SQL} SELECT * FROM extraction")
def _extraction_hits(t: Tables):
    return quality.extraction_hits(*_extracted(t))


@query("tolerance_hits", f"WITH {MEASURED_SQL}, {TOLERANCE_SQL} SELECT * FROM tolerance")
def _tolerance_hits(t: Tables):
    return quality.tolerance_hits(*_measured(t), SPECS)


@query("exact_hits", f"WITH {MEASURED_SQL}, {EXACT_SQL} SELECT * FROM exact")
def _exact_hits(t: Tables):
    return quality.exact_hits(*_measured(t), ["pI", "brand"])


@query("scorecard", f"""WITH {MEASURED_SQL}, {TOLERANCE_SQL}, {EXACT_SQL}, {EXTRACTION_SQL}
SELECT 'extraction' AS section, metric, hits, n, printf('%.1f%%', pct) AS pct FROM extraction UNION ALL
SELECT 'within tolerance' AS section, metric, hits, n, printf('%.1f%%', pct) AS pct FROM tolerance
UNION ALL SELECT 'exact', "column", hits, n, printf('%.1f%%', pct) FROM exact""")
def _scorecard(t: Tables):
    ours, theirs = _measured(t)
    return quality.scorecard({
        "extraction": quality.extraction_hits(*_extracted(t)),
        "within tolerance": quality.tolerance_hits(ours, theirs, SPECS), "exact": quality.exact_hits(ours, theirs, ["pI", "brand"]),
    })


@query("header_check", """
WITH a AS (SELECT column_name AS c, row_number() OVER () AS i FROM (DESCRIBE SELECT o_orderkey AS id, o_orderstatus, o_totalprice FROM orders))
SELECT (SELECT string_agg(c, ';' ORDER BY i) FROM a) = 'id;o_orderstatus;o_totalprice' AS same, false AS same_first_two, count(*) AS n FROM orders""")
def _header_check(t: Tables):
    df = t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice")
    whole = quality.header_check(df.columns, ["id", "o_orderstatus", "o_totalprice"])
    part = quality.header_check(df.columns, ["id", "o_totalprice", "o_orderstatus"], 2)
    return df.agg(F.count("*").alias("n")).select(F.lit(whole).alias("same"), F.lit(part).alias("same_first_two"), "n")


def _event_classes(t: Tables):
    return t.events.withColumns({
        "status": F.when(F.col("event_type") == "error", "not_xray").when(F.col("event_type") == "signup", "timeout:600").otherwise("ok"),
        "css": F.when(F.col("user_id") % 4 == 0, "none").otherwise((F.col("value") / 50).cast("string")), "id": F.col("event_id"),
    })


EVENT_SQL = """ev AS (SELECT event_id AS id, value, user_id, CASE event_type WHEN 'error' THEN 'not_xray' WHEN 'signup' THEN 'timeout:600' ELSE 'ok' END AS status,
  CASE WHEN user_id % 4 = 0 THEN NULL ELSE value / 50 END AS css FROM events),
cl AS (SELECT id, value, user_id, CASE WHEN status = 'not_xray' THEN 'not_applicable' WHEN status <> 'ok' THEN '' WHEN css IS NULL THEN 'indeterminate'
  WHEN css >= 0.5 THEN 'biological' ELSE 'crystal-packing' END AS class FROM ev)"""


@query("interface_class", f"WITH {EVENT_SQL} SELECT id, class FROM cl")
def _interface_class(t: Tables):
    return interfaces.interface_class(_event_classes(t))


@query("class_breakdown", f"""WITH {EVENT_SQL}
SELECT CASE WHEN class = '' THEN '(blank)' ELSE class END AS class, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM cl), 1) AS pct
FROM cl GROUP BY 1""")
def _class_breakdown(t: Tables):
    return quality.class_breakdown(interfaces.interface_class(_event_classes(t)))


@query("class_means", f"""WITH {EVENT_SQL}
SELECT class, round(avg(value), 6) AS "mean_BSA", round(avg(CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id::DOUBLE END), 6) AS mean_dg FROM cl
WHERE class IN ('biological', 'crystal-packing') GROUP BY 1""")
def _class_means(t: Tables):
    base = _event_classes(t)
    rows = interfaces.interface_class(base).join(base.select("id", F.col("value").alias("BSA"), F.when(F.col("user_id") % 3 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("dg")), "id")
    means = quality.class_means(rows, ["BSA", "dg"])
    return means.select("class", F.round("mean_BSA", 6).alias("mean_BSA"), F.round("mean_dg", 6).alias("mean_dg"))


@query("status_reasons", f"WITH {EVENT_SQL} SELECT split_part(status, ':', 1) AS reason, count(*) AS n FROM ev GROUP BY 1")
def _status_reasons(t: Tables):
    return quality.status_reasons(_event_classes(t))


@query("status_derive", """
SELECT o_orderkey AS id, coalesce(r.status, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'not_xray' ELSE 'missing' END) AS status
FROM orders LEFT JOIN (SELECT c_custkey, 'ok' AS status FROM customer WHERE c_acctbal > 0) r ON c_custkey = o_custkey""")
def _status_derive(t: Tables):
    pairs = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("pdb"))
    records = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("pdb"), F.lit("ok").alias("status"))
    methods = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("STRUCTURE_METHOD"))
    return interfaces.status_derive(pairs, records, methods, "1-URGENT")


_FACE = {  # interface field -> the cell of a line item, as both engines read it
    "interface_id": "l_linenumber", "tipo": "'protein'", "chain_1": "l_returnflag", "chain_2": "l_linestatus",
    "css": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE concat('0.', CAST(l_suppkey % 10 AS STRING)) END", "area": "CASE WHEN l_tax = 0 THEN NULL ELSE l_partkey % 50 END",
    "pvalue": "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey % 7 END",
}
_FACE |= {f: _FACE.get(f, f"l_partkey % {i + 11}") for i, f in enumerate(fv.INTERFACE_FIELDS)}
_BODY = {f: f"(l_partkey + l_suppkey) % {i + 13}" for i, f in enumerate(fv.ASSEMBLY_FIELDS)}
_FACE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_tax", "l_returnflag", "l_linestatus"]
_DONE, _STATUS = "CASE WHEN l_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END", "CASE WHEN l_orderkey % 7 = 0 THEN 'no_interfaces' ELSE 'ok' END"


def _letters_sql(text: str) -> str:
    return f"array_to_string(list_sort(string_split({text}, '')), '')"


def _records_of(cells: dict[str, str]):
    """The cells of every line item in ``_rows``, which holds all columns that they use, as a list of records."""
    own = {f: re.sub(r"\bl_\w+", lambda m: f"r.{m[0]}", e) for f, e in cells.items()}
    return F.expr(f"transform(_rows, r -> named_struct({', '.join(f"'{f}', CAST({e} AS STRING)" for f, e in own.items())}))")


@query("interface_table", f"""
WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_FACE_ORDER)}) AS pos,
  {', '.join(f"({e})::VARCHAR AS {f}" for f, e in {**_FACE, **_BODY}.items())} FROM lineitem),
recs AS (SELECT l_orderkey, {_STATUS} AS status, {_DONE} AS done, count(*)::VARCHAR AS n FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY ALL),
pairs AS (SELECT DISTINCT l_orderkey, l_linestatus AS pep, l_returnflag AS prot FROM lineitem UNION ALL SELECT o_orderkey, 'Q', 'Z' FROM orders),
st AS (SELECT pairs.*, done, n, coalesce(status, CASE WHEN l_orderkey % 3 = 0 THEN 'missing' ELSE 'not_xray' END) AS status FROM pairs LEFT JOIN recs USING (l_orderkey)),
faces AS (SELECT *, least(chain_1, chain_2) AS lo, greatest(chain_1, chain_2) AS hi,
  row_number() OVER (PARTITION BY l_orderkey, least(chain_1, chain_2), greatest(chain_1, chain_2) ORDER BY coalesce(try_cast(area AS DOUBLE), -1) DESC, pos) AS rn FROM l),
bodies AS (SELECT *, {_letters_sql("chain_1 || chain_2")} AS k, row_number() OVER (PARTITION BY l_orderkey, {_letters_sql("chain_1 || chain_2")} ORDER BY pos) AS rn FROM l)
SELECT 'O' || st.l_orderkey::VARCHAR || '-' || pep || '-' || prot AS id, status AS pisa_status,
  CASE WHEN status = 'not_xray' THEN 'not_applicable' WHEN status <> 'ok' THEN '' WHEN try_cast(f.css AS DOUBLE) IS NULL THEN 'indeterminate'
    WHEN try_cast(f.css AS DOUBLE) >= {fv.CSS_THRESHOLD} THEN 'biological' ELSE 'crystal-packing' END AS pisa_interface_class,
  coalesce(done, '') AS pisa_assembly_done, coalesce(n, '') AS pisa_n_interfaces,
  {', '.join(f"coalesce(f.{f}, '') AS pisa_{f}" for f in fv.INTERFACE_FIELDS)}, {', '.join(f"coalesce(b.{f}, '') AS pisa_{f}" for f in fv.ASSEMBLY_FIELDS)}
FROM st LEFT JOIN faces f ON status = 'ok' AND f.rn = 1 AND f.l_orderkey = st.l_orderkey AND f.lo = least(pep, prot) AND f.hi = greatest(pep, prot)
LEFT JOIN bodies b ON status = 'ok' AND b.rn = 1 AND b.l_orderkey = st.l_orderkey AND b.k = {_letters_sql("pep || prot")}""")
def _interface_table(t: Tables):
    """The 29-column annotation of every pair, from one nested record per order; every fifth order has none."""
    # plain columns are grouped, once for both lists; the records' texts are made where they are written
    rows = F.array_sort(F.collect_list(F.struct(*_FACE_ORDER))).alias("_rows")
    grouped = t.lineitem.filter("l_orderkey % 5 <> 0").groupBy("l_orderkey").agg(F.count("*").alias("n_interfaces"), rows)
    records = staged(grouped.select(
        F.concat(F.lit("O"), "l_orderkey").alias("pdb"), F.expr(_STATUS).alias("status"), F.expr(_DONE).alias("assembly_done"), "n_interfaces",
        _records_of(_FACE).alias("interfaces"), _records_of({"composition": "concat(l_returnflag, l_linestatus)", **_BODY}).alias("assemblies"),
    ))
    # one list an order of its distinct pairs is less to shuffle than a row a pair
    own = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.struct(F.col("l_linestatus").alias("pep_chain"), F.col("l_returnflag").alias("prot_chain"))).alias("_own"))
    pairs = own.select("l_orderkey", F.inline("_own"))
    pairs = pairs.unionByName(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit("Q").alias("pep_chain"), F.lit("Z").alias("prot_chain")))
    pairs = pairs.withColumn("pdb", F.concat(F.lit("O"), "l_orderkey")).withColumn("id", F.concat_ws("-", "pdb", "pep_chain", "prot_chain"))
    pairs = bucketed(pairs)
    methods = pairs.select("id", F.when(F.col("l_orderkey") % 3 == 0, fv.XRAY).otherwise("SOLUTION NMR").alias("STRUCTURE_METHOD"))
    return interfaces.interface_table(pairs.drop("l_orderkey"), records, methods)


@query("degraded_fill", "SELECT o_orderkey AS id, 'unavailable' AS pisa_status, '' AS pisa_css, '' AS pisa_area FROM orders")
def _degraded_fill(t: Tables):
    return interfaces.degraded_fill(t.orders.select(F.col("o_orderkey").alias("id")), ["pisa_css", "pisa_area"], "unavailable", "pisa_status")


@query("coverage_counts", """SELECT 'contacts' AS stage, count(*) AS n FROM lineitem UNION ALL SELECT 'signatures', count(*) FROM documents
UNION ALL SELECT 'clusters', count(*) FROM (SELECT DISTINCT source FROM documents) s""")
def _coverage_counts(t: Tables):
    return quality.coverage_counts({"contacts": t.lineitem, "signatures": t.documents, "clusters": t.documents.select("source").distinct()})


@query("release_counts", "SELECT 'pairs' AS deliverable, count(*) AS n FROM orders UNION ALL SELECT 'multi', count(*) FROM customer")
def _release_counts(t: Tables):
    return quality.release_counts({"pairs": t.orders, "multi": t.customer})


@query("latest_prior_release", """SELECT max(name) AS name FROM (SELECT DISTINCT 'release-' || strftime(o_orderdate, '%Y-%m-%d') AS name FROM orders) r
WHERE name < 'release-1999-06-30'""")
def _latest_prior_release(t: Tables):
    names = t.orders.select(F.concat(F.lit("release-"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("name")).distinct()
    return quality.latest_prior_release(names, "release-1999-06-30")


# ---- inherited clusters ---------------------------------------------------------------------------


def _member_lines(t: Tables):
    lines = t.orders.select(
        F.col("o_orderkey").alias("line_no"),
        F.concat_ws("\t", F.concat(F.lit("cl"), "o_custkey"), F.lit("3"), F.concat(
            F.lit(" "), F.col("o_custkey") % 97, F.lit(", ,"), F.col("o_orderkey") % 1013, F.lit(" ,"), F.col("o_custkey"))).alias("value"),
    )
    path = written(t)
    lines.orderBy("line_no").select("value").write.text(path)
    return delimited.read_cluster_members(t.spark, path)


MEMBERS_SQL = """members AS (SELECT o_orderkey AS line_no, 'cl' || o_custkey::VARCHAR AS label, unnest([0, 1, 2]) AS pos,
  unnest([(o_custkey % 97)::VARCHAR, (o_orderkey % 1013)::VARCHAR, o_custkey::VARCHAR]) AS member FROM orders),
firsts AS (SELECT member AS id, arg_max(label, line_no) AS label FROM members WHERE pos = 0 GROUP BY 1),
leaders AS (SELECT member AS id, arg_max(label, line_no) AS leader_id FROM members GROUP BY 1)"""


@query("read_cluster_members", f"WITH {MEMBERS_SQL} SELECT label, pos, member FROM members")
def _read_cluster_members(t: Tables):
    return _member_lines(t).drop("line_no")


@query("cluster_first_member", f"WITH {MEMBERS_SQL} SELECT * FROM firsts")
def _cluster_first_member(t: Tables):
    return clusters.cluster_first_member(_member_lines(t))


@query("redundancy_leader", f"WITH {MEMBERS_SQL} SELECT id, leader_id, CASE WHEN id = leader_id THEN 'yes' ELSE 'no' END AS is_leader FROM leaders")
def _redundancy_leader(t: Tables):
    return clusters.redundancy_leader(_member_lines(t))


@query("inherit_clusters", f"""WITH {MEMBERS_SQL}
SELECT c_custkey::VARCHAR AS id, coalesce(f.label, '') AS "sequence-cluster", coalesce(f.label, '') AS "interface-cluster", '' AS "binding-cluster",
  CASE WHEN l.leader_id IS NULL THEN '' WHEN l.id = l.leader_id THEN 'yes' ELSE 'no' END AS is_leader, coalesce(l.leader_id, '') AS leader_id
FROM customer LEFT JOIN firsts f ON f.id = c_custkey::VARCHAR LEFT JOIN leaders l ON l.id = c_custkey::VARCHAR""")
def _inherit_clusters(t: Tables):
    members = _member_lines(t)
    pairs = t.customer.select(F.col("c_custkey").cast("string").alias("id"))
    return clusters.inherit_clusters(pairs, members, members, members.filter(F.lit(False)), members)


@query("cluster_tables_publish", """SELECT 'redundant' AS kind, source AS label, doc_id::VARCHAR AS member FROM documents
UNION ALL SELECT 'identical', min(doc_id) OVER (PARTITION BY text)::VARCHAR, doc_id::VARCHAR FROM documents""")
def _cluster_tables(t: Tables):
    same = groups.exact_cluster(t.documents, "doc_id", "text").select(F.col("cnr_cluster").alias("label"), F.col("id").alias("member"))
    path = written(t)
    publish.cluster_tables_publish({"redundant": t.documents.select(F.col("source").alias("label"), F.col("doc_id").alias("member")), "identical": same}, path)
    return t.spark.read.schema("label string, member string, kind string").option("sep", "\t").csv(path)


# ---- incremental state ----------------------------------------------------------------------------


@query("first_release_ledger", """
WITH led AS (SELECT o_orderkey AS id, o_orderdate::DATE AS first_release FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
cur AS (SELECT o_orderkey AS id FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')
SELECT id, strftime(coalesce(first_release, DATE '2026-08-30'), '%Y-%m-%d') AS first_release, cur.id IS NOT NULL AS current
FROM led FULL OUTER JOIN cur USING (id)""")
def _first_release_ledger(t: Tables):
    ledger = t.orders.filter("o_orderdate < '2000-01-01'").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("first_release"))
    current = t.orders.filter("o_orderdate >= '1998-01-01'").select(F.col("o_orderkey").alias("id"))
    whole, now = incremental.first_release_ledger(ledger, current, "2026-08-30")
    flagged = whole.join(now.select("id", F.lit(True).alias("current")), "id", "left")
    return flagged.select("id", F.col("first_release").cast("string").alias("first_release"), F.coalesce("current", F.lit(False)).alias("current"))


@query("persist_policy", """
SELECT event_id AS id, CASE event_type WHEN 'error' THEN 'no_contacts' ELSE 'ok' END AS status, CASE event_type WHEN 'error' THEN NULL ELSE props END AS record
FROM events WHERE event_type <> 'click'""")
def _persist_policy(t: Tables):
    kind = F.col("event_type")
    records = t.events.select(
        F.col("event_id").alias("id"), F.when(kind == "click", "retry:timeout").when(kind == "error", "no_contacts").otherwise("ok").alias("status"),
        F.when(kind != "error", F.col("props")).alias("record"),
    )
    return incremental.persist_policy(records)


@query("cache_upsert", """
WITH cache AS (SELECT o_orderkey AS id, 0::BIGINT AS n FROM orders WHERE o_orderstatus = 'F')
SELECT id, n FROM cache UNION ALL
SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) FROM orders WHERE o_orderkey NOT IN (SELECT id FROM cache)""")
def _cache_upsert(t: Tables):
    cache = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.lit(0).cast("long").alias("n"))

    def compute(ids):
        lines = t.lineitem.select(F.col("l_orderkey").alias("id")).join(ids, "id", "left_semi")  # known ids are not counted again
        counted = lines.groupBy("id").agg(F.count("*").alias("n"))
        return ids.join(counted, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))

    known = staged(bloom.filters(cache))
    return incremental.cache_upsert(cache, t.orders.select(F.col("o_orderkey").alias("id")), compute, filters=known)


def _price_of_rest(row: dict) -> tuple[dict | None, str]:
    """A line's price in cents by what its quantity has over the last ten; small lines have no record."""
    if row["l_quantity"] < 10:
        return None, "no_lot"
    return {"line": row["l_linenumber"], "cents": round(row["l_extendedprice"] * 100) // int(row["l_quantity"] % 10)}, "ok"


@query("worker_records", """
SELECT l_orderkey AS id, CASE WHEN l_quantity < 10 THEN 'no_lot' WHEN l_quantity % 10 = 0 THEN 'retry:ZeroDivisionError' ELSE 'ok' END AS status,
  CASE WHEN l_quantity >= 10 AND l_quantity % 10 <> 0 THEN l_linenumber::BIGINT END AS line,
  CASE WHEN l_quantity >= 10 AND l_quantity % 10 <> 0 THEN round(l_extendedprice * 100)::BIGINT // (l_quantity % 10)::BIGINT END AS cents FROM lineitem""")
def _worker_records(t: Tables):
    """A worker over every line item; lines of full tens divide by zero and become a status."""
    items = t.lineitem.select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_quantity", "l_extendedprice")
    out = workers.run_worker(items, _price_of_rest, "struct<line: bigint, cents: bigint>")
    return out.select("id", "status", "record.line", "record.cents")


# ---- cells, projections and sinks' row content ------------------------------------------------------


@query("sanitize_cells", r"""SELECT doc_id AS id, replace(replace(replace(replace(text, ';', ','), chr(9), ' '), chr(10), ' '), chr(13), '') AS text,
  replace(source, ';', ',') AS source FROM documents""")
def _sanitize_cells(t: Tables):
    return text.sanitize_cells(t.documents.select(F.col("doc_id").alias("id"), "text", "source"))


@query("project_ordered", """SELECT o_orderstatus AS "O_ORDERSTATUS", '' AS "unknown", o_orderkey::VARCHAR AS o_orderkey,
  o_orderpriority AS "O_OrderPriority" FROM orders""")
def _project_ordered(t: Tables):
    return features.project_ordered(t.orders, ["O_ORDERSTATUS", "unknown", "o_orderkey", "O_OrderPriority"])


def _summary_source(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("TITLE"), F.col("o_orderstatus").alias("is_leader"),
        F.col("o_custkey").alias("PISA_n_hbonds"), F.col("o_orderdate").cast("date").cast("string").alias("resolution"),
    )


@query("explore_projection", """SELECT o_orderkey::VARCHAR || repeat(chr(9), 4) || o_orderpriority || repeat(chr(9), 2) || o_orderstatus || repeat(chr(9), 2)
  || o_custkey::VARCHAR || repeat(chr(9), 4) || strftime(o_orderdate, '%Y-%m-%d') || repeat(chr(9), 12) AS value FROM orders""")
def _explore_projection(t: Tables):
    path = written(t)
    publish.write_summary(_summary_source(t), path)
    return t.spark.read.text(path)


@query("split_per_entry", """SELECT substr(o_orderkey::VARCHAR, 1, 1) AS shard, o_orderpriority || ';' || o_orderkey::VARCHAR || ';' AS value FROM orders""")
def _split_per_entry(t: Tables):
    path = written(t)
    publish.split_per_entry(t.orders, path, "o_orderkey", ["o_orderpriority", "O_ORDERKEY", "absent"])
    return t.spark.read.schema("value string, shard string").text(path)


@query("write_final", """SELECT o_orderkey::VARCHAR || ';' || o_orderstatus || ';' || o_orderpriority AS value FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def _write_final(t: Tables):
    master = membership.master_semi(t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderpriority"), t.lineitem.select(F.col("l_orderkey").alias("id")))
    path = written(t)
    publish.write_final(master, path)
    return publish.text_lines(committed.read_committed(t.spark, path, ";"), ";")


@query("fasta_export", r"""SELECT '>' || doc_id::VARCHAR || ' | ' || CASE WHEN trim(coalesce(s, '')) = '' THEN 'Peptide' ELSE trim(s) END || chr(10) || seq AS value
FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE source || ' ' || lang END AS s, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq FROM documents) d
WHERE seq <> ''""")
def _fasta_export(t: Tables):
    rows = t.documents.select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") != "en", F.concat_ws(" ", "source", "lang")).alias("desc"),
        F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"),
    )
    path = written(t)
    publish.write_fasta(features.fasta_export(rows, "Peptide"), path)
    records = t.spark.read.option("lineSep", "\n>").text(path)  # a record ends where the next one begins
    return records.select(F.concat(F.lit(">"), F.regexp_replace(F.regexp_replace("value", "^>", ""), "\n$", "")).alias("value"))


@query("rename_map", """SELECT l_orderkey AS "No. of polar-polar contacts", l_tax AS "Percentage of apolar NIS residues" FROM lineitem""")
def _rename_map(t: Tables):
    from ..fixed_values import ENERGY_NAMES

    return features.rename_map(t.lineitem.select(F.col("l_orderkey").alias("n_polar_polar"), F.col("l_tax").alias("nis_apolar")), ENERGY_NAMES)


@query("entry_key", """WITH k AS (SELECT 'P' || l_suppkey::VARCHAR AS pdb, l_returnflag AS pep, l_linestatus || l_linenumber::VARCHAR AS prot FROM lineitem)
SELECT pdb || '-' || pep || '-' || prot AS id, pdb, pep AS pep_chain, prot AS prot_chain,
  CASE WHEN length(pdb) >= 3 THEN lower(substr(pdb, 2, 2)) ELSE '_' END AS structure_shard, substr(pdb, 1, 1) AS entry_shard, count(*) AS n
FROM k GROUP BY ALL""")
def _entry_key(t: Tables):
    made = t.lineitem.select(text.entry_id(F.concat(F.lit("P"), "l_suppkey"), F.col("l_returnflag"), F.concat("l_linestatus", "l_linenumber")).alias("id"))
    parts = made.select("id", *[c.alias(n) for n, c in text.entry_parts(F.col("id")).items()])
    return parts.groupBy("id", "pdb", "pep_chain", "prot_chain", text.structure_shard(F.col("pdb")).alias("structure_shard"), text.entry_shard(F.col("id")).alias("entry_shard")).agg(F.count("*").alias("n"))


@query("param_signature", """SELECT o_orderkey AS id, substr(sha1('3|cutoff=' || o_orderstatus || '|ph=' || o_orderpriority), 1, 12) AS signature FROM orders""")
def _param_signature(t: Tables):
    settings = F.array(F.concat(F.lit("ph="), "o_orderpriority"), F.concat(F.lit("cutoff="), "o_orderstatus"))
    return t.orders.select(F.col("o_orderkey").alias("id"), text.param_signature("3", settings).alias("signature"))


@query("content_key", """SELECT o_orderkey // 500 AS chunk, substr(sha1(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR)), 1, 16) AS content
FROM orders GROUP BY 1""")
def _content_key(t: Tables):
    # a chunk covers 500 consecutive keys, so it never collects more than 500 ids
    chunks = t.orders.groupBy(F.floor(F.col("o_orderkey") / 500).alias("chunk")).agg(F.collect_list(F.col("o_orderkey").cast("string")).alias("ids"))
    return chunks.select("chunk", text.content_key(F.col("ids")).alias("content"))


@query("format_date", """SELECT o_orderkey AS id, strftime(o_orderdate, '%b ') || day(o_orderdate)::VARCHAR || strftime(o_orderdate, ', %Y') AS day FROM orders""")
def _format_date(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("id"), text.format_date(F.col("o_orderdate")).alias("day"))


@query("resolution_value", """
WITH r AS (SELECT p_partkey AS pdb, CASE WHEN p_size % 3 = 0 THEN '?' WHEN p_size % 3 = 1 THEN '.' ELSE p_size::VARCHAR || '.50' END AS a,
  CASE WHEN p_size % 2 = 0 THEN '' ELSE p_size::VARCHAR || '.0' END AS b, CASE WHEN p_size > 30 THEN p_brand ELSE '?' END AS c FROM part),
v AS (SELECT pdb, coalesce(CASE WHEN a NOT IN ('', '?', '.') THEN a END, CASE WHEN b NOT IN ('', '?', '.') THEN b END, CASE WHEN c NOT IN ('', '?', '.') THEN c END) AS raw FROM r)
SELECT pdb, coalesce(try_cast(raw AS DOUBLE)::VARCHAR, raw, '') AS "RESOLUTION" FROM v""")
def _resolution_value(t: Tables):
    size = F.col("p_size")
    refine = F.when(size % 3 == 0, "?").when(size % 3 == 1, ".").otherwise(F.concat(size, F.lit(".50")))
    reflns = F.when(size % 2 == 0, "").otherwise(F.concat(size, F.lit(".0")))
    em = F.when(size > 30, F.col("p_brand")).otherwise("?")
    return t.part.select(F.col("p_partkey").alias("pdb"), text.resolution_value(refine, reflns, em).alias("RESOLUTION"))


@query("complete_auth_columns", """SELECT l_orderkey AS id, l_returnflag AS label_atom_id, l_linestatus AS label_comp_id, l_returnflag AS auth_atom_id,
  CASE WHEN l_tax > 0.04 THEN 'own' ELSE l_linestatus END AS auth_comp_id FROM lineitem""")
def _complete_auth_columns(t: Tables):
    from ..operators.structure import complete_auth_columns

    return complete_auth_columns(t.lineitem.select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("label_atom_id"), F.col("l_linestatus").alias("label_comp_id"),
        F.when(F.col("l_tax") > 0.04, "own").alias("auth_comp_id"),
    ))


# ---- labelled rows and model choice -----------------------------------------------------------------


@query("read_labelled_seqs", """
WITH s AS (SELECT doc_id AS row, regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS seq, quality AS y
  FROM documents JOIN labels USING (doc_id))
SELECT seq, y FROM s WHERE length(seq) >= 3""")
def _read_labelled_seqs(t: Tables):
    rows = t.documents.join(t.labels, "doc_id").select(
        F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"),
        F.when(F.col("quality") == 1, " Positive").otherwise("negative").alias("target"),
    )
    path = written(t)
    rows.write.option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return delimited.read_labelled_seqs(t.spark, path).drop("row")


def _reports(t: Tables):
    """Per market segment, nations as models with made-from-data scores and ties."""
    base = t.customer.groupBy(F.col("c_mktsegment").alias("class"), F.concat(F.lit("m"), "c_nationkey").alias("model"), F.col("c_nationkey").alias("pos"))
    return base.agg(
        F.when(F.col("c_nationkey") % 6 == 0, F.lit(float("nan"))).otherwise(F.round(F.count("*") / 100.0, 2)).alias("auc"),
        F.when(F.col("c_nationkey") % 6 == 1, F.lit(float("nan"))).otherwise(F.round(F.count("*") / 50.0, 2)).alias("brier"),
    )


REPORTS_SQL = """rep AS (SELECT c_mktsegment AS class, 'm' || c_nationkey::VARCHAR AS model, c_nationkey AS pos,
  CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE round(count(*) / 100.0::DOUBLE, 2) END AS auc,
  CASE WHEN c_nationkey % 6 = 1 THEN NULL ELSE round(count(*) / 50.0::DOUBLE, 2) END AS brier FROM customer GROUP BY 1, 2, 3)"""


@query("best_by_auc", f"""WITH {REPORTS_SQL} SELECT class, model, auc FROM
(SELECT *, row_number() OVER (PARTITION BY class ORDER BY auc DESC, pos) AS rn FROM rep WHERE auc IS NOT NULL) x WHERE rn = 1""")
def _best_by_auc(t: Tables):
    return quality.best_by_auc(_reports(t))


@query("best_by_brier", f"""WITH {REPORTS_SQL} SELECT class, model, brier, coalesce(auc, -1) AS auc FROM
(SELECT *, row_number() OVER (PARTITION BY class ORDER BY brier, pos) AS rn FROM rep WHERE brier IS NOT NULL) x WHERE rn = 1""")
def _best_by_brier(t: Tables):
    best = quality.best_by_brier(_reports(t))
    return best.withColumn("auc", F.when(F.isnan("auc"), F.lit(-1.0)).otherwise(F.col("auc")))
