import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactforge import fixed_values as fv
from contactforge.functions import descriptors, properties, text


@pytest.fixture
def seqs(frame):
    return frame([("a", "XPXGGGGGNGDXEEIPEEYL"), ("b", "TPYDINQML"), ("c", "XXX"), ("d", "CCC"), ("e", "LX"), ("f", "ACDEFGHIKLMNPQRSTVWY" * 3)], "id string, seq string")


def one(df, key):
    return {r.id: r for r in df.collect()}[key]


def test_every_class_table_covers_the_alphabet():
    for groups in [*fv.THREE_CLASSES.values(), fv.SEVEN_GROUPS, list(fv.FIVE_GROUPS.values())]:
        assert sorted("".join(groups)) == sorted(fv.RESIDUES)
    assert sum(fv.CODONS.values()) == fv.CODON_TOTAL


def test_formula_has_no_terminal_water_and_no_empty_sulphur(seqs):
    rows = {r.id: r for r in properties.formula_atoms(seqs).collect()}
    assert rows["d"].Formula == "C9H15N3O3S3" and rows["d"].TotalAtoms == 33
    assert "S" not in rows["a"].Formula
    assert rows["c"].Formula == "C0H0N0O0"


def test_extinction_floors_cystine_pairs(seqs):
    row = one(properties.extinction_coeff(seqs), "d")
    assert (row.ExtCoeff_Disulfide, row.ExtCoeff_NoDisulfide) == (125, 0)


def test_empty_sequence_has_zero_indices(seqs):
    assert one(properties.aliphatic_index(seqs), "c").Aliphatic == 0.0
    assert one(properties.hydrophobic_percent(seqs), "c").Hydrophobic == 0.0


def test_aliphatic_by_hand(seqs):
    # TPYDINQML: one I and one L in nine
    assert one(properties.aliphatic_index(seqs), "b").Aliphatic == round(100 * 3.9 * 2 / 9, 3)


def test_mass_and_gravy_by_hand(seqs):
    clean = "TPYDINQML"
    mass = sum(fv.RESIDUE_MASS[r] for r in clean) - 8 * fv.WATER_MASS
    assert one(properties.molecular_weight(seqs), "b").MW == pytest.approx(mass, abs=6e-4)
    assert one(properties.gravy(seqs), "b").GRAVY == round(sum(fv.HYDROPATHY[r] for r in clean) / 9, 3)


def test_isoelectric_point_is_where_the_charge_vanishes(seqs):
    def charge(seq, ph):
        plus = [fv.N_TERMINUS_PK_BY_RESIDUE.get(seq[0], 7.5)] + [fv.POSITIVE_PK[r] for r in seq if r in fv.POSITIVE_PK]
        minus = [fv.C_TERMINUS_PK_BY_RESIDUE.get(seq[-1], 3.55)] + [fv.NEGATIVE_PK[r] for r in seq if r in fv.NEGATIVE_PK]
        return sum(1 / (1 + 10 ** (ph - k)) for k in plus) - sum(1 / (1 + 10 ** (k - ph)) for k in minus)

    for key, seq in (("f", fv.RESIDUES * 3), ("d", "CCC")):
        pi = one(properties.isoelectric_point(seqs), key).pI
        assert charge(seq, pi - 0.002) > 0 > charge(seq, pi + 0.002)
    assert one(properties.isoelectric_point(seqs), "b").pI == pytest.approx(4.05, abs=2e-3)  # floor of the search


def test_profile_skips_chains_without_residues(frame):
    pairs = frame([("p", "XX", "ACDXX")], "id string, pep_seq string, prot_seq string")
    rows = properties.physchem_profile(pairs).collect()
    assert [(r.chain_type, r.clean_len, r.stripped, r.Instability) for r in rows] == [("protein", 3, 2, None)]


def test_instability_uses_the_given_table(frame, seqs):
    weights = frame([("CC", 2.5), ("TP", 4.0), ("ZZ", 99.0)], "kmer string, weight double")
    rows = {r.id: r.Instability for r in descriptors.instability_index(seqs, weights).collect()}
    assert rows["d"] == round(10 / 3 * 5.0, 3) and rows["b"] == round(10 / 9 * 4, 3) and rows["e"] == 0.0
    assert "c" not in rows


def test_batches_of_sequences_have_the_points_of_a_plain_search(frame):
    def plain(seq):
        groups = [(1, 1, fv.N_TERMINUS_PK_BY_RESIDUE.get(seq[0], fv.N_TERMINUS_PK)), (-1, 1, fv.C_TERMINUS_PK_BY_RESIDUE.get(seq[-1], fv.C_TERMINUS_PK))]
        groups += [(sign, seq.count(r), pk) for sign, pks in ((1, fv.POSITIVE_PK), (-1, fv.NEGATIVE_PK)) for r, pk in pks.items()]
        low, high, ph = fv.PH_LOW, fv.PH_HIGH, fv.PH_START
        for _ in range(fv.PH_STEPS):
            up = sum(s * n / (1 + 10.0 ** (s * (ph - pk))) for s, n, pk in groups) > 0
            low, high = (ph, high) if up else (low, ph)
            ph = (low + high) / 2
        return ph

    random = np.random.default_rng(3)
    texts = ["".join(random.choice(list(fv.RESIDUES), n)) for n in random.integers(1, 90, 5000)] + ["K" * 30_000, "E" * 30_000]
    texts[100], texts[4000], texts[4001] = None, "", "xx"
    got = {r.id: r.pI for r in properties.isoelectric_point(frame(list(enumerate(texts)), "id int, seq string").coalesce(1)).collect()}
    assert len(got) == len(texts) and got[100] is got[4000] is got[4001] is None
    assert all(got[i] == pytest.approx(plain(t), abs=5.01e-4) for i, t in enumerate(texts) if t and t != "xx")


def test_a_null_weight_leaves_no_instability(frame, seqs):
    weights = frame([("CC", 2.5), ("AA", None)], "kmer string, weight double")
    assert [r.Instability for r in descriptors.instability_index(seqs, weights).collect()] == [None] * 5


def test_a_profile_folds_no_list_per_row(frame):
    # a bisection or 400 weights folded by interpreted lambdas cost three quarters of the published assemblies
    weights = frame([("CC", 2.5), ("TP", 4.0)], "kmer string, weight double")
    pairs = frame([("p", "TPCC", None), ("q", None, "CCC")], "id string, pep_seq string, prot_seq string")
    profile = properties.physchem_profile(pairs, weights)
    assert "lambda" not in profile._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.id, r.chain_type): r.Instability for r in profile.collect()} == {("p", "peptide"): round(10 / 4 * 6.5, 3), ("q", "protein"): round(10 / 3 * 5, 3)}


@pytest.mark.parametrize("name", fv.SIGNATURE_ORDER + ["ctriad"])
def test_widths(seqs, name):
    rows = getattr(descriptors, name)(seqs).collect()
    assert {len(r.vec) for r in rows} == {fv.SIGNATURE_WIDTH[name]}
    assert {r.id for r in rows} == {"a", "b", "d", "f"}


@pytest.mark.parametrize("name", ["aac", "dpc", "gaac", "gdpc", "gtpc"])
def test_frequencies_sum_to_one(seqs, name):
    assert all(math.isclose(sum(r.vec), 1.0) for r in getattr(descriptors, name)(seqs).collect())


def test_class_distribution_by_hand(seqs):
    # CCC is class 3 of the first property: first, quartiles and last at places 1, 1, 1, 2, 3 of 3
    vec = one(descriptors.ctdd(seqs), "d").vec
    assert vec[:10] == [0.0] * 10
    assert vec[10:15] == pytest.approx([100 / 3, 100 / 3, 100 / 3, 200 / 3, 100.0])


def test_dipeptide_order(seqs):
    vec = one(descriptors.dpc(seqs), "d").vec
    assert vec[1 * 20 + 1] == 1.0 and sum(vec) == 1.0


def test_signature_is_the_concatenation(seqs):
    whole = {r.id: r.vec for r in descriptors.seq_signature(seqs).collect()}
    parts = [{r.id: r.vec for r in getattr(descriptors, n)(seqs).collect()} for n in fv.SIGNATURE_ORDER]
    for key, vec in whole.items():
        assert len(vec) == 1248 and vec == pytest.approx([x for p in parts for x in p[key]])
    assert {len(r.vec) for r in descriptors.seq_signature(seqs, with_triads=True).collect()} == {1591}
    assert len(descriptors.signature_names()) == 1248


def test_min_length_split(seqs):
    kept, excluded = descriptors.min_length_split(seqs)
    assert {r.id for r in kept.collect()} == {"a", "b", "d", "f"}
    assert {(r.id, r.length) for r in excluded.collect()} == {("c", 0), ("e", 1)}


def test_min_length_split_keeps_the_first_long_row(frame):
    rows = frame([("a", "C", 0), ("a", "ACDEF", 1), ("a", "GGGGGGG", 2), ("a", "A", 3), ("b", "A", 0)], "id string, seq string, n int")
    kept, excluded = descriptors.min_length_split(rows, order="n")
    assert [(r.id, r.seq) for r in kept.collect()] == [("a", "ACDEF")]
    assert sorted((r.id, r.length) for r in excluded.collect()) == [("a", 1), ("b", 1)] and excluded.count() == 2


def test_residue_codes_keep_caps_as_x(frame):
    rows = frame([("ACE",), ("Thr",), ("SEC",), ("HOH",)], "n string").select(text.residue_code(F.col("n")).alias("c")).collect()
    assert [r.c for r in rows] == ["X", "T", "U", "X"]


def test_resolution_text(frame):
    rows = frame([("2.30", "?", ""), ("?", ".", "3.10"), ("NMR", "", ""), ("", "?", ".")], "a string, b string, c string")
    got = [r.v for r in rows.select(text.resolution_value(F.col("a"), F.col("b"), F.col("c")).alias("v")).collect()]
    assert got == ["2.3", "3.1", "NMR", ""]


def test_sanitize_and_signature(frame):
    row = frame([("a;b\tc\nd\re",)], "s string").select(
        text.sanitize(F.col("s")).alias("s"), text.param_signature("1", {"b": 2, "a": 1}).alias("p"), text.param_signature("2", {"a": 1, "b": 2}).alias("q")
    ).first()
    assert row.s == "a,b c de" and len(row.p) == 12 and row.p != row.q


def test_counters_see_batches_bounded_in_bytes_and_count_in_small_pieces(spark, frame, monkeypatch):
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf
    from contactforge.functions import vectorised

    rows = [(k, "ACDE" * 500) for k in range(4000)]
    kept = descriptors._cleaned(frame(rows, "id long, seq string").coalesce(1), "id", "seq")
    size = arrow_udf(lambda c: pa.array([c.nbytes] * len(c)), "long")
    assert kept.select(size("_q").alias("n")).agg({"n": "max"}).first()[0] < 5_000_000
    texts = pa.array(["ACDE" * 500] * 1000)
    assert max(len(text) for text, _ in vectorised._chunks(texts)) <= 1 << 19
    whole = {r["id"]: list(r["vec"]) for r in descriptors.dpc(frame(rows[:3], "id long, seq string")).collect()}
    assert whole[0] == whole[2] and sum(whole[0]) == pytest.approx(1.0)
