"""Per-sequence properties and descriptor vectors over whole document texts."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions import descriptors, properties, text
from ..functions.text import bind
from .base import PAIR_SEQ_SQL, SEQ_SQL, Tables, query, sequence_pairs, sequences


def _n(letter: str, column: str = "q") -> str:
    return f"(length({column}) - length(replace({column}, '{letter}', '')))"


def _sum(weights: dict) -> str:
    return " + ".join(f"{_n(r)} * {w!r}::DOUBLE" if isinstance(w, float) else f"{_n(r)} * {w}" for r, w in weights.items())


ELEMENTS = {e: _sum({r: a[i] for r, a in fv.RESIDUE_ATOMS.items()}) for i, e in enumerate("CHNOS")}
ELEMENTS_SQL = ", ".join(f"({sql})::BIGINT AS n_{e}" for e, sql in ELEMENTS.items())
FORMULA_SQL = "'C' || n_C::VARCHAR || 'H' || n_H::VARCHAR || 'N' || n_N::VARCHAR || 'O' || n_O::VARCHAR || CASE WHEN n_S > 0 THEN 'S' || n_S::VARCHAR ELSE '' END"
ALIPHATIC_SQL = f"CASE WHEN length(q) > 0 THEN round(100 * ({_n('A')} + 2.9::DOUBLE * {_n('V')} + 3.9::DOUBLE * ({_n('I')} + {_n('L')})) / length(q), 3) ELSE 0.0::DOUBLE END"
HYDROPHOBIC_SQL = f"CASE WHEN length(q) > 0 THEN round(100.0::DOUBLE * ({' + '.join(_n(r) for r in fv.HYDROPHOBIC)}) / length(q), 3) ELSE 0.0::DOUBLE END"
POS_SQL, NEG_SQL = f"({_n('K')} + {_n('R')})::INTEGER", f"({_n('D')} + {_n('E')})::INTEGER"
REDUCED_SQL = f"(1490 * {_n('Y')} + 5500 * {_n('W')})::INTEGER"
CYSTINE_SQL = f"(1490 * {_n('Y')} + 5500 * {_n('W')} + 125 * ({_n('C')} // 2))::INTEGER"
MASS_UNITS = " + ".join(f"{_n(r)} * {round(m * 10_000)}" for r, m in fv.RESIDUE_MASS.items())
MASS_SQL = f"round(({MASS_UNITS} - (length(q) - 1) * {round(fv.WATER_MASS * 10_000)}) / 10.0::DOUBLE) / 1000.0::DOUBLE"
GRAVY_SQL = f"round(({_sum(fv.HYDROPATHY)}) / length(q), 3)"


def _terminal(values: dict, letter: str, default: float) -> str:
    return f"CASE {letter} " + " ".join(f"WHEN '{r}' THEN {pk}::DOUBLE" for r, pk in values.items()) + f" ELSE {default}::DOUBLE END"


def _pi_sql(keys: str) -> str:
    """Bisection as a recursive query over per-sequence charge-group counts."""
    groups = {**fv.POSITIVE_PK, **fv.NEGATIVE_PK}
    counts = ", ".join(f"{_n(r)} AS n{r}" for r in groups)
    plus = " + ".join([f"1 / (1 + pow(10.0::DOUBLE, ph - nt))", *[f"n{r} / (1 + pow(10.0::DOUBLE, ph - {pk}))" for r, pk in fv.POSITIVE_PK.items()]])
    minus = " + ".join([f"1 / (1 + pow(10.0::DOUBLE, ct - ph))", *[f"n{r} / (1 + pow(10.0::DOUBLE, {pk} - ph))" for r, pk in fv.NEGATIVE_PK.items()]])
    carried = ", ".join(f"n{r}" for r in groups)
    return f"""charged AS (SELECT {keys}, {counts},
    {_terminal(fv.N_TERMINUS_PK_BY_RESIDUE, "substr(q, 1, 1)", fv.N_TERMINUS_PK)} AS nt,
    {_terminal(fv.C_TERMINUS_PK_BY_RESIDUE, "right(q, 1)", fv.C_TERMINUS_PK)} AS ct FROM q WHERE length(q) > 0),
search AS (
  SELECT {keys}, {carried}, nt, ct, {fv.PH_LOW}::DOUBLE AS lo, {fv.PH_HIGH}::DOUBLE AS hi, {fv.PH_START}::DOUBLE AS ph, 0 AS step FROM charged
  UNION ALL
  SELECT {keys}, {carried}, nt, ct, CASE WHEN c > 0 THEN ph ELSE lo END, CASE WHEN c > 0 THEN hi ELSE ph END,
    (CASE WHEN c > 0 THEN ph ELSE lo END + CASE WHEN c > 0 THEN hi ELSE ph END) / 2, step + 1
  FROM (SELECT *, ({plus}) - ({minus}) AS c FROM search WHERE step < {fv.PH_STEPS}) s),
pis AS (SELECT {keys}, round(ph, 3) AS pi FROM search WHERE step = {fv.PH_STEPS})"""


@query("standard_only", f"WITH {SEQ_SQL} SELECT id, q AS clean, (length(seq) - length(q))::INTEGER AS stripped FROM q")
def _standard_only(t: Tables):
    return sequences(t).select("id", text.standard_only(F.col("seq")).alias("clean"), text.stripped_length(F.col("seq")).alias("stripped"))


@query("residue_composition", f"WITH {SEQ_SQL} SELECT id, {', '.join(f'{_n(r)}::INTEGER AS n_{r}' for r in fv.RESIDUES)} FROM q")
def _residue_composition(t: Tables):
    return properties.residue_composition(sequences(t))


@query("formula_atoms", f"""WITH {SEQ_SQL}, e AS (SELECT id, {ELEMENTS_SQL} FROM q)
SELECT id, n_C, n_H, n_N, n_O, n_S, {FORMULA_SQL} AS "Formula", n_C + n_H + n_N + n_O + n_S AS "TotalAtoms" FROM e""")
def _formula_atoms(t: Tables):
    out = properties.formula_atoms(sequences(t))
    return out.select("id", *[F.col(f"n_{e}").cast("long").alias(f"n_{e}") for e in "CHNOS"], "Formula", F.col("TotalAtoms").cast("long").alias("TotalAtoms"))


@query("aliphatic_index", f'WITH {SEQ_SQL} SELECT id, {ALIPHATIC_SQL} AS "Aliphatic" FROM q')
def _aliphatic_index(t: Tables):
    return properties.aliphatic_index(sequences(t))


@query("hydrophobic_percent", f'WITH {SEQ_SQL} SELECT id, {HYDROPHOBIC_SQL} AS "Hydrophobic" FROM q')
def _hydrophobic_percent(t: Tables):
    return properties.hydrophobic_percent(sequences(t))


@query("charge_counts", f'WITH {SEQ_SQL} SELECT id, {POS_SQL} AS "Pos", {NEG_SQL} AS "Neg" FROM q')
def _charge_counts(t: Tables):
    return properties.charge_counts(sequences(t))


@query("extinction_coeff", f'WITH {SEQ_SQL} SELECT id, {CYSTINE_SQL} AS "ExtCoeff_Disulfide", {REDUCED_SQL} AS "ExtCoeff_NoDisulfide" FROM q')
def _extinction_coeff(t: Tables):
    return properties.extinction_coeff(sequences(t))


@query("molecular_weight", f'WITH {SEQ_SQL} SELECT id, {MASS_SQL} AS "MW" FROM q WHERE length(q) > 0')
def _molecular_weight(t: Tables):
    return properties.molecular_weight(sequences(t).filter(F.length(text.standard_only(F.col("seq"))) > 0))


@query("gravy", f'WITH {SEQ_SQL} SELECT id, {GRAVY_SQL} AS "GRAVY" FROM q WHERE length(q) > 0')
def _gravy(t: Tables):
    return properties.gravy(sequences(t).filter(F.length(text.standard_only(F.col("seq"))) > 0))


@query("isoelectric_point", f'WITH RECURSIVE {SEQ_SQL}, {_pi_sql("id")} SELECT id, pi AS "pI" FROM pis')
def _isoelectric_point(t: Tables):
    return properties.isoelectric_point(sequences(t).filter(F.length(text.standard_only(F.col("seq"))) > 0))


# a weight per dipeptide, derived from how much more often it starts a text pair than its reverse would:
# the published table is a parameter, so the registered query supplies one made from the data
def data_weights(t: Tables) -> DataFrame:
    """Share of each dipeptide over all benchmark texts, in per cent."""
    seqs = t.benchmark.select(text.standard_only(F.regexp_replace("text", "[^A-Za-z]", "")).alias("q"))
    counted = seqs.select(F.explode(descriptors.kmer_array(F.col("q"), 2)).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select("kmer", F.round(100.0 * F.col("n") / total, 4).alias("weight"))


def _kmers(source: str, k: int, keys: str = "id") -> str:
    return f"SELECT {keys}, length(q) AS len, unnest(list_transform(range(1, length(q) - {k - 2}), lambda i: substr(q, i, {k}))) AS kmer FROM {source}"


WEIGHTS_SQL = f"""bench AS (SELECT item_id AS id, regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS q FROM benchmark),
bk AS (SELECT kmer, count(*) AS n FROM ({_kmers('bench', 2)}) s GROUP BY 1),
weights AS (SELECT kmer, round(100.0::DOUBLE * n / (SELECT sum(n) FROM bk), 4) AS weight FROM bk)"""


def _instability_sql(keys: str) -> str:
    return f"""dik AS (SELECT {keys}, kmer, count(*) AS n FROM ({_kmers('q', 2, keys)}) s GROUP BY ALL),
scored AS (SELECT {keys}, sum(n * weight) AS w FROM dik JOIN weights USING (kmer) GROUP BY ALL)"""


@query("instability_index", f"""WITH {SEQ_SQL}, {WEIGHTS_SQL}, {_instability_sql('id')}
SELECT id, round(coalesce(w, 0.0::DOUBLE) * 10.0::DOUBLE / length(q), 3) AS "Instability" FROM q LEFT JOIN scored USING (id) WHERE length(q) > 0""")
def _instability_index(t: Tables):
    return descriptors.instability_index(sequences(t), data_weights(t))


@query("physchem_profile", f"""WITH RECURSIVE {PAIR_SEQ_SQL}, {_pi_sql("id, chain_type")}, {WEIGHTS_SQL}, {_instability_sql('id, chain_type')},
e AS (SELECT id, chain_type, {ELEMENTS_SQL} FROM q)
SELECT id, chain_type, length(q)::INTEGER AS clean_len, (length(seq) - length(q))::INTEGER AS stripped, {MASS_SQL} AS "MW", pi AS "pI", {GRAVY_SQL} AS "GRAVY",
  round(coalesce(w, 0.0::DOUBLE) * 10.0::DOUBLE / length(q), 3) AS "Instability", {ALIPHATIC_SQL} AS "Aliphatic", {HYDROPHOBIC_SQL} AS "Hydrophobic",
  {POS_SQL} AS "Pos", {NEG_SQL} AS "Neg", {CYSTINE_SQL} AS "ExtCoeff_Disulfide", {REDUCED_SQL} AS "ExtCoeff_NoDisulfide", {FORMULA_SQL} AS "Formula",
  (n_C + n_H + n_N + n_O + n_S)::INTEGER AS "TotalAtoms"
FROM q JOIN pis USING (id, chain_type) JOIN e USING (id, chain_type) LEFT JOIN scored USING (id, chain_type)""")
def _physchem_profile(t: Tables):
    return properties.physchem_profile(sequence_pairs(t), data_weights(t))


@query("min_length_split", f"""WITH {SEQ_SQL}, s AS (SELECT id, q FROM q UNION ALL
  SELECT 1000000000 + n_nationkey, regexp_replace(upper(regexp_replace(n_name, '[^A-Za-z]', '', 'g')), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') FROM nation
  UNION ALL SELECT 2000000000 + l_orderkey * 10 + l_linenumber, '' || CASE WHEN l_returnflag = 'R' THEN 'RRX' ELSE 'AAA' END FROM lineitem)
SELECT 'kept' AS part, count(DISTINCT id) AS n, sum(0)::BIGINT AS residues FROM s WHERE length(regexp_replace(q, 'X', '', 'g')) >= 3
UNION ALL SELECT 'excluded', count(*), sum(length(regexp_replace(q, 'X', '', 'g')))::BIGINT FROM s
  WHERE length(regexp_replace(q, 'X', '', 'g')) < 3 AND id NOT IN (SELECT id FROM s WHERE length(regexp_replace(q, 'X', '', 'g')) >= 3)""")
def _min_length_split(t: Tables):
    names = t.nation.select((F.lit(1000000000) + F.col("n_nationkey")).cast("long").alias("id"), F.upper(F.regexp_replace("n_name", "[^A-Za-z]", "")).alias("seq"))
    lines = t.lineitem.select(
        (F.lit(2000000000) + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_returnflag") == "R", "RRX").otherwise("AAA").alias("seq")
    )
    kept, excluded = descriptors.min_length_split(sequences(t).unionByName(names).unionByName(lines))
    kept_n = kept.agg(F.lit("kept").alias("part"), F.count("*").alias("n"), F.lit(0).cast("long").alias("residues"))
    return kept_n.unionByName(excluded.agg(F.lit("excluded").alias("part"), F.count("*").alias("n"), F.sum("length").alias("residues")))


# ---- vectors, compared entry by entry (zero entries left out) ------------------------------------------


def entries(df: DataFrame, digits: int = 6) -> DataFrame:
    # the outer form: for the inner one the optimiser adds a size filter that evaluates the vector twice
    long = df.select("id", F.posexplode_outer("vec").alias("pos", "value"))
    return long.select("id", "pos", F.round("value", digits).alias("value")).filter(F.col("value") != 0)


LONG = "WHERE length(q) >= 3"
GROUPS = list(fv.FIVE_GROUPS.values())


def _translate(source: str, groups, letters: str) -> str:
    return f"translate({source}, '{''.join(groups)}', '{''.join(d * len(g) for d, g in zip(letters, groups))}')"


def _rank(alphabet: str, k: int) -> str:
    return " + ".join(f"(position(substr(kmer, {j + 1}, 1) IN '{alphabet}') - 1) * {len(alphabet) ** (k - 1 - j)}" for j in range(k))


def _kmer_sql(view: str, alphabet: str, k: int) -> str:
    """Long counts ``kc(id, len, pos, n)`` of one k-mer kind."""
    return f"""{SEQ_SQL}, src AS (SELECT id, {view} AS q FROM q {LONG}),
kc AS (SELECT id, len, ({_rank(alphabet, k)})::INTEGER AS pos, count(*) AS n FROM ({_kmers('src', k)}) s GROUP BY ALL)"""


def _shares_sql(view: str, alphabet: str, k: int) -> str:
    return f"WITH {_kmer_sql(view, alphabet, k)} SELECT id, pos, round(n / (len - {k - 1})::DOUBLE, 6) AS value FROM kc WHERE round(n / (len - {k - 1})::DOUBLE, 6) <> 0"


def _wide_sql(cells: list[str], source: str = f"q {LONG}") -> str:
    return f"""WITH {SEQ_SQL}, v AS (SELECT id, unnest(range({len(cells)}))::INTEGER AS pos, unnest([{', '.join(f'({c})::DOUBLE' for c in cells)}]) AS x FROM {source})
SELECT id, pos, round(x, 6) AS value FROM v WHERE round(x, 6) <> 0"""


CLASS_VIEWS = [_translate("q", g, "123") for g in fv.THREE_CLASSES.values()]


def _switch(view: str, a: str, b: str) -> str:
    both = " + ".join(f"(length({view}) - length(replace({view}, '{x}', '')))" for x in (a + b, b + a))
    return f"(({both}) / 2::DOUBLE) / (length(q) - 1)"


CTDC_CELLS = [f"{_n(d, v)} / length(q)::DOUBLE" for v in CLASS_VIEWS for d in "123"]
CTDT_CELLS = [_switch(v, a, b) for v in CLASS_VIEWS for a, b in (("1", "2"), ("1", "3"), ("2", "3"))]
CTDD_SQL = f"""{SEQ_SQL}, src AS (SELECT id, length(q) AS len, unnest(range(13)) AS p, unnest([{', '.join(CLASS_VIEWS)}]) AS s FROM q {LONG}),
places AS (SELECT id, len, p, unnest(range(1, len + 1)) AS place, unnest(string_split(s, '')) AS c FROM src),
ranked AS (SELECT id, len, p, c, place, row_number() OVER (PARTITION BY id, p, c ORDER BY place) AS k, count(*) OVER (PARTITION BY id, p, c) AS n FROM places),
quart(f, share) AS (VALUES (0, 0.0::DOUBLE), (1, 0.25::DOUBLE), (2, 0.5::DOUBLE), (3, 0.75::DOUBLE), (4, 1.0::DOUBLE)),
ctdd AS (SELECT id, (p * 15 + (c::INTEGER - 1) * 5 + f)::INTEGER AS pos, place / len::DOUBLE * 100.0::DOUBLE AS x
  FROM ranked JOIN quart ON k = greatest(1, floor(share * n)))"""


@query("aac", _wide_sql([f"{_n(r)} / length(q)::DOUBLE" for r in fv.RESIDUES]))
def _aac(t: Tables):
    return entries(descriptors.aac(sequences(t)))


@query("gaac", _wide_sql([f"({' + '.join(_n(r) for r in g)}) / length(q)::DOUBLE" for g in GROUPS]))
def _gaac(t: Tables):
    return entries(descriptors.gaac(sequences(t)))


@query("dpc", _shares_sql("q", fv.RESIDUES, 2))
def _dpc(t: Tables):
    return entries(descriptors.dpc(sequences(t)))


@query("gdpc", _shares_sql(_translate("q", GROUPS, "12345"), "12345", 2))
def _gdpc(t: Tables):
    return entries(descriptors.gdpc(sequences(t)))


@query("gtpc", _shares_sql(_translate("q", GROUPS, "12345"), "12345", 3))
def _gtpc(t: Tables):
    return entries(descriptors.gtpc(sequences(t)))


TRIAD_VIEW = _translate("q", fv.SEVEN_GROUPS, "abcdefg")


@query("ctriad", f"""WITH {_kmer_sql(TRIAD_VIEW, "abcdefg", 3)},
lim AS (SELECT id, CASE WHEN count(*) = 343 THEN min(n) ELSE 0 END AS lo, max(n) AS hi FROM kc GROUP BY id)
SELECT id, pos, round((n - lo) / hi::DOUBLE, 6) AS value FROM kc JOIN lim USING (id) WHERE round((n - lo) / hi::DOUBLE, 6) <> 0""")
def _ctriad(t: Tables):
    return entries(descriptors.ctriad(sequences(t)))


CODON_SQL = f"""codons(r, c) AS (VALUES {', '.join(f"('{r}', {c})" for r, c in fv.CODONS.items())}),
theory AS (SELECT a.r || b.r AS kmer, ((a.c / 61.0::DOUBLE) * (b.c / 61.0::DOUBLE)) AS tm,
  ((position(a.r IN '{fv.RESIDUES}') - 1) * 20 + position(b.r IN '{fv.RESIDUES}') - 1)::INTEGER AS pos FROM codons a CROSS JOIN codons b)"""
DDE_SQL = f"""{_kmer_sql('q', fv.RESIDUES, 2)}, {CODON_SQL},
dde AS (SELECT s.id, t.pos, (coalesce(k.n, 0) / (s.len - 1)::DOUBLE - tm) / sqrt(tm * (1.0::DOUBLE - tm) / (s.len - 1)) AS x
  FROM (SELECT id, length(q) AS len FROM src) s CROSS JOIN theory t LEFT JOIN kc k ON k.id = s.id AND k.pos = t.pos)"""


@query("dde", f"WITH {DDE_SQL} SELECT id, pos, round(x, 6) AS value FROM dde WHERE round(x, 6) <> 0")
def _dde(t: Tables):
    return entries(descriptors.dde(sequences(t)))


@query("ctdc", _wide_sql(CTDC_CELLS))
def _ctdc(t: Tables):
    return entries(descriptors.ctdc(sequences(t)))


@query("ctdt", _wide_sql(CTDT_CELLS))
def _ctdt(t: Tables):
    return entries(descriptors.ctdt(sequences(t)))


@query("ctdd", f"WITH {CTDD_SQL} SELECT id, pos, round(x, 6) AS value FROM ctdd")
def _ctdd(t: Tables):
    return entries(descriptors.ctdd(sequences(t)))


def _block_sql(name: str, source: str, x: str) -> str:
    return f"SELECT id, '{name}' AS part, count(*) FILTER (WHERE {x} <> 0) AS nonzero, round(sum({x} * sqrt(pos + 2)), 4) AS moment FROM {source} GROUP BY id"


def _cells_view(cells: list[str]) -> str:
    return f"(SELECT id, unnest(range({len(cells)})) AS pos, unnest([{', '.join(f'({c})::DOUBLE' for c in cells)}]) AS x FROM q {LONG}) v"


def _kmer_view(view: str, alphabet: str, k: int) -> str:
    counted = f"SELECT id, len, ({_rank(alphabet, k)}) AS pos, count(*) AS n FROM ({_kmers(f'(SELECT id, {view} AS q FROM q {LONG}) z', k)}) s GROUP BY ALL"
    return f"(SELECT id, pos, n / (len - {k - 1})::DOUBLE AS x FROM ({counted}) c) v"


SIGNATURE_SQL = f"""WITH {DDE_SQL}, {CTDD_SQL.replace(SEQ_SQL + ', src', 'csrc').replace('FROM src)', 'FROM csrc)')}
{_block_sql('aac', _cells_view([f"{_n(r)} / length(q)::DOUBLE" for r in fv.RESIDUES]), 'x')}
UNION ALL {_block_sql('dpc', _kmer_view('q', fv.RESIDUES, 2), 'x')}
UNION ALL {_block_sql('dde', 'dde', 'x')}
UNION ALL {_block_sql('gaac', _cells_view([f"({' + '.join(_n(r) for r in g)}) / length(q)::DOUBLE" for g in GROUPS]), 'x')}
UNION ALL {_block_sql('gdpc', _kmer_view(_translate('q', GROUPS, '12345'), '12345', 2), 'x')}
UNION ALL {_block_sql('gtpc', _kmer_view(_translate('q', GROUPS, '12345'), '12345', 3), 'x')}
UNION ALL {_block_sql('ctdc', _cells_view(CTDC_CELLS), 'x')}
UNION ALL {_block_sql('ctdt', _cells_view(CTDT_CELLS), 'x')}
UNION ALL {_block_sql('ctdd', 'ctdd', 'x')}"""


def signature_blocks(df: DataFrame) -> DataFrame:
    """Per id and descriptor: its non-zero entries and an irrationally weighted sum of all entries."""
    def blocks(vector):
        rows, start = [], 1
        for name in fv.SIGNATURE_ORDER:
            width = fv.SIGNATURE_WIDTH[name]
            part = F.slice(vector, start, width)
            moment = F.aggregate(F.transform(part, lambda x, i: x * F.sqrt(i + 2)), F.lit(0.0), lambda a, x: a + x)
            nonzero = F.size(F.filter(part, lambda x: x != 0)).cast("long")
            rows.append(F.struct(F.lit(name).alias("part"), nonzero.alias("nonzero"), F.round(moment, 4).alias("moment")))
            start += width
        return F.array(*rows)

    return df.select("id", F.inline_outer(bind(F.col("vec"), blocks)))


@query("seq_signature", SIGNATURE_SQL)
def _seq_signature(t: Tables):
    return signature_blocks(descriptors.seq_signature(sequences(t)))


@query("distinct_featurise", _wide_sql([f"{_n(r)} / length(q)::DOUBLE" for r in fv.RESIDUES]))
def _distinct_featurise(t: Tables):
    return entries(descriptors.distinct_featurise(sequences(t), descriptors.aac))
