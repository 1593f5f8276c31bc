"""Registry of queries and the views they share.

Each query reads whole tables; its SQL twin (where SQL can express it) reads the same tables.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import balanced, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Attribute access to the tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def spread(self, name: str) -> DataFrame:
        """The table for work that costs far more than its bytes, on all cores even if it is one small file."""
        return balanced(getattr(self, name))


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under an operator name, with its SQL twin."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def written(t: Tables) -> str:
    """A new path in the shared folder for files that a query writes and reads back."""
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}"


# ---- texts as residue sequences -------------------------------------------------------------------
# letters are taken before upper-casing, because engines differ on the capitals of some letters

def sequences(t: Tables) -> DataFrame:
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    return t.spread("documents").select(F.col("doc_id").alias("id"), letters.alias("seq"))


SEQ_SQL = """seqs AS (
  SELECT doc_id AS id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS seq FROM documents),
q AS (SELECT id, seq, regexp_replace(seq, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS q FROM seqs)"""


def sequence_pairs(t: Tables) -> DataFrame:
    """Text as the peptide, page letters of the same number (or nothing) as the protein."""
    page = t.spread("pages").select(F.col("page_id").alias("id"), F.upper(F.regexp_replace("html", "[^A-Za-z]", "")).alias("prot_seq"))
    pairs = sequences(t).withColumnRenamed("seq", "pep_seq").join(page, "id", "left")
    return pairs.withColumn("prot_seq", F.coalesce("prot_seq", F.lit("")))


PAIR_SEQ_SQL = """pair_seqs AS (
  SELECT doc_id AS id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS pep_seq,
         coalesce(upper(regexp_replace(html, '[^A-Za-z]', '', 'g')), '') AS prot_seq
  FROM documents LEFT JOIN pages ON page_id = doc_id),
chain_seqs AS (
  SELECT id, 'peptide' AS chain_type, pep_seq AS seq FROM pair_seqs
  UNION ALL SELECT id, 'protein', prot_seq FROM pair_seqs),
q AS (SELECT id, chain_type, seq, regexp_replace(seq, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS q FROM chain_seqs)"""


# ---- line items as atoms ----------------------------------------------------------------------------
# structure = supplier; chains A* and B* are the short ones, C to G the long ones; residue = part

RESIDUE_NAMES = [
    "ALA", "CYS", "ASP", "GLU", "PHE", "GLY", "HIS", "ILE", "LYS", "LEU", "MET", "ASN", "PRO", "GLN", "ARG",
    "SER", "THR", "VAL", "TRP", "TYR", "HOH", "MSE", "ACE",
]


def atoms(t: Tables, scale: float = 1.0) -> DataFrame:
    li = t.lineitem
    code = (F.col("l_partkey") % len(RESIDUE_NAMES)).cast("int")
    chain = F.when(
        F.col("l_linenumber") <= 2, F.concat(F.substring(F.lit("AB"), F.col("l_linenumber"), F.lit(1)), "l_linestatus")
    ).otherwise(F.substring(F.lit("ABCDEFG"), F.col("l_linenumber"), F.lit(1)))
    base = li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("pdb"),
        F.when(F.col("l_tax") > 0.06, 2).otherwise(1).alias("model"), chain.alias("chain"),
        F.concat(F.lit("L"), (F.col("l_orderkey") % 5).cast("string")).alias("label_chain"),
        F.col("l_partkey").cast("int").alias("resseq"),
        F.when(F.col("l_returnflag") == "R", "A").otherwise("").alias("icode"),
        F.get(F.lit(RESIDUE_NAMES), code).alias("resname"),
        F.col("l_returnflag").alias("atom_name"), (F.col("l_partkey") % 8).cast("int").alias("kind"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        (F.col("l_extendedprice") / 500.0 * scale).alias("x"), (F.col("l_quantity") * 4.0 * scale).alias("y"),
        (F.round(F.col("l_discount") * 100.0) * 10.0 * scale).alias("z"),
        F.when((F.col("l_suppkey") % 10 == 3) & (F.col("l_discount") > 0.095), F.lit(None).cast("string"))
        .when(code == 20, ".").when(F.col("l_tax") < 0.005, "?")
        .otherwise(F.col("l_partkey").cast("string")).alias("label_seq"),
        F.when(code >= 20, "HETATM").otherwise("ATOM").alias("group_pdb"),
        (F.lit(1.4) + code / 50.0).alias("radius"),
    )
    return base


def atoms_sql(scale: float = 1.0) -> str:
    names = "[" + ", ".join(f"'{n}'" for n in RESIDUE_NAMES) + "]"
    n = len(RESIDUE_NAMES)
    return f"""atoms AS (
  SELECT 'S' || l_suppkey::VARCHAR AS pdb, CASE WHEN l_tax > 0.06 THEN 2 ELSE 1 END AS model,
         CASE WHEN l_linenumber <= 2 THEN substr('AB', l_linenumber, 1) || l_linestatus
              ELSE substr('ABCDEFG', l_linenumber, 1) END AS chain,
         'L' || (l_orderkey % 5)::VARCHAR AS label_chain, l_partkey::INTEGER AS resseq,
         CASE WHEN l_returnflag = 'R' THEN 'A' ELSE '' END AS icode,
         ({names})[(l_partkey % {n})::INTEGER + 1] AS resname, l_returnflag AS atom_name,
         (l_partkey % 8)::INTEGER AS kind, l_orderkey * 10 + l_linenumber AS pos,
         l_extendedprice / 500.0::DOUBLE * {scale}::DOUBLE AS x, l_quantity * 4.0::DOUBLE * {scale}::DOUBLE AS y,
         round(l_discount * 100.0::DOUBLE) * 10.0::DOUBLE * {scale}::DOUBLE AS z,
         CASE WHEN l_suppkey % 10 = 3 AND l_discount > 0.095 THEN NULL
              WHEN l_partkey % {n} = 20 THEN '.' WHEN l_tax < 0.005 THEN '?' ELSE l_partkey::VARCHAR END AS label_seq,
         CASE WHEN l_partkey % {n} >= 20 THEN 'HETATM' ELSE 'ATOM' END AS group_pdb,
         1.4::DOUBLE + (l_partkey % {n}) / 50.0::DOUBLE AS radius
  FROM lineitem)"""


def is_short():
    return F.col("chain").startswith("A") | F.col("chain").startswith("B")


SHORT_SQL = "(chain LIKE 'A%' OR chain LIKE 'B%')"


def short_atoms(t: Tables, scale: float = 1.0) -> DataFrame:
    return atoms(t, scale).filter(is_short())


def long_atoms(t: Tables, scale: float = 1.0) -> DataFrame:
    return atoms(t, scale).filter(~is_short())


def chain_pairs(t: Tables) -> DataFrame:
    """Every short chain with every long chain of its structure: at most 4 x 5 per structure."""
    chains = atoms(t).select("pdb", "chain").distinct()
    sides = chains.groupBy("pdb").agg(
        F.collect_list(F.when(is_short(), F.col("chain"))).alias("s"), F.collect_list(F.when(~is_short(), F.col("chain"))).alias("l")
    )
    pairs = sides.select("pdb", F.explode("s").alias("pep_chain"), "l").select("pdb", "pep_chain", F.explode("l").alias("prot_chain"))
    return pairs.withColumn("id", F.concat_ws("-", "pdb", "pep_chain", "prot_chain"))


CHAIN_PAIR_SQL = f"""chains AS (SELECT DISTINCT pdb, chain FROM atoms),
pairs AS (
  SELECT s.pdb || '-' || s.chain || '-' || l.chain AS id, s.pdb, s.chain AS pep_chain, l.chain AS prot_chain
  FROM chains s JOIN chains l ON s.pdb = l.pdb
  WHERE {SHORT_SQL.replace('chain', 's.chain')} AND NOT {SHORT_SQL.replace('chain', 'l.chain')})"""
