import datetime

import pytest
from pyspark.sql import functions as F

from contactforge import fixed_values as fv
from contactforge.operators import clusters, features, groups, interfaces, membership, quality
from contactforge.plans import build
from contactforge.sources import delimited
from contactforge.streaming import incremental


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_exact_cluster_keeps_x_and_takes_the_smallest_id(frame):
    df = frame([("b", "AX"), ("a", "AX"), ("c", "A")], "id string, seq string")
    got = rows(groups.exact_cluster(df), "id", "cnr_cluster", "cnr_size", "is_representative")
    assert got == [("a", "a", 2, "yes"), ("b", "a", 2, "no"), ("c", "c", 1, "yes")]


PAIRS = "id string, pdb string, pep_chain string, prot_chain string, pep_size int, prot_size int, pep_seq string, prot_seq string"


def test_multi_group_needs_two_distinct_partners(frame):
    df = frame([
        ("S-P-B", "S", "P", "B", 9, 60, "pp", "bb"), ("S-P-A", "S", "P", "A", 9, 70, "pp", "aa"), ("S-Q-A", "S", "Q", "A", 8, 70, "qq", "aa"),
        ("T-P-A", "T", "P", "A", 7, 50, "x", "y"), ("T-P-A2", "T", "P", "A", 7, 50, "x", "y"),
    ], PAIRS)
    got = groups.multi_group(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.cluster_id, r["count"], r["items"], r.PROTEIN_CHAIN, r.PROTEIN_SIZE, r.PROTEIN_SEQ, r.PEPTIDE_SIZE) == ("S-P", 2, "S-P-A:S-P-B", "A:B", "70:60", "aa:bb", 9)


@pytest.mark.parametrize("classes, expected", [
    (["biological", "crystal-packing"], "biological"), (["crystal-packing", ""], "crystal-packing"), (["not_applicable", ""], "not_applicable"),
    (["not_applicable", "not_applicable"], "not_applicable"), (["", ""], ""), (["crystal-packing", "indeterminate"], "indeterminate"),
    (["crystal-packing", "not_applicable"], "crystal-packing"), ([None, "biological"], "biological"),
])
def test_class_rules_in_order(frame, classes, expected):
    df = frame([("m", i, c) for i, c in enumerate(classes)], "cluster_id string, pos int, class string")
    got = groups.aggregate_class(df).first()
    assert got["class"] == expected and got.class_per_chain == ":".join(c or "" for c in classes)


def test_colon_values_leave_gaps(frame):
    items = frame([("m", 0, "a"), ("m", 1, "b"), ("m", 2, "c")], "cluster_id string, pos int, id string")
    values = frame([("a", 1), ("c", 3)], "id string, v int")
    assert groups.colon_values(items, values, ["v"]).first().v == "1::3"


def test_cluster_lines(frame):
    lines = frame([(1, "L1\t2\ta, b"), (2, "L2\t1\t , a,, c"), (3, "short\t1"), (4, "L4\t0\t , ")], "line_no long, value string")
    members = delimited.member_rows(lines)
    assert rows(members, "label", "pos", "member") == [("L1", 0, "a"), ("L1", 1, "b"), ("L2", 0, "a"), ("L2", 1, "c")]
    assert rows(clusters.cluster_first_member(members), "id", "label") == [("a", "L2")]
    leaders = delimited.member_rows(frame([(1, "a\t2\ta, b"), (2, "c\t2\tb, c")], "line_no long, value string"))
    assert rows(clusters.redundancy_leader(leaders), "id", "leader_id", "is_leader") == [("a", "a", "yes"), ("b", "c", "no"), ("c", "c", "yes")]
    pairs = frame([("a",), ("zz",)], "id string")
    got = {r.id: tuple(r)[1:] for r in clusters.inherit_clusters(pairs, members, members, members, leaders).collect()}
    assert got == {"a": ("L2", "L2", "L2", "yes", "a"), "zz": ("", "", "", "", "")}


def test_interface_class_edges(frame):
    df = frame([("1", "ok", "0.5"), ("2", "ok", "0.49"), ("3", "ok", ""), ("4", "ok", "n/a"), ("5", "no_interface", "0.9"), ("6", "not_xray", None), ("7", "timeout", "1"), ("8", "missing", None)],
               "id string, status string, css string")
    got = {r.id: r["class"] for r in interfaces.interface_class(df).collect()}
    assert got == {"1": "biological", "2": "crystal-packing", "3": "indeterminate", "4": "indeterminate", "5": "", "6": "not_applicable", "7": "", "8": ""}


def test_interface_table_has_29_columns(frame):
    pairs = frame([("S-A-C", "S", "A", "C"), ("S-A-D", "S", "A", "D"), ("N-A-C", "N", "A", "C"), ("M-A-C", "M", "A", "C")], "id string, pdb string, pep_chain string, prot_chain string")
    face = "struct<" + ",".join(f"{c}:string" for c in fv.INTERFACE_FIELDS) + ">"
    body = "struct<composition:string," + ",".join(f"{c}:string" for c in fv.ASSEMBLY_FIELDS) + ">"

    def one(chain_1, chain_2, area, css):
        return tuple({"chain_1": chain_1, "chain_2": chain_2, "area": area, "css": css}.get(c, "v") for c in fv.INTERFACE_FIELDS)

    records = frame([("S", "ok", "yes", 3, [one("C", "A", "10", "0.2"), one("A", "C", "90", "0.8"), one("A", "A", "x", "1")], [("CA", *"123456"), ("AC", *"999999")])],
                    f"pdb string, status string, assembly_done string, n_interfaces int, interfaces array<{face}>, assemblies array<{body}>")
    methods = frame([("S-A-C", fv.XRAY), ("S-A-D", fv.XRAY), ("N-A-C", "SOLUTION NMR"), ("M-A-C", fv.XRAY)], "id string, STRUCTURE_METHOD string")
    table = interfaces.interface_table(pairs, records, methods)
    assert len(table.columns) == 29
    got = {r.id: r for r in table.collect()}
    assert (got["S-A-C"].pisa_interface_class, got["S-A-C"].pisa_area, got["S-A-C"].pisa_diss_energy) == ("biological", "90", "1")
    assert (got["S-A-D"].pisa_interface_class, got["S-A-D"].pisa_n_interfaces, got["S-A-D"].pisa_css) == ("indeterminate", "3", "")
    assert (got["N-A-C"].pisa_status, got["M-A-C"].pisa_status) == ("not_xray", "missing")


def test_structures_meet_their_pairs_once(frame, monkeypatch):
    face = "struct<" + ",".join(f"{c}:string" for c in fv.INTERFACE_FIELDS) + ">"
    body = "struct<composition:string," + ",".join(f"{c}:string" for c in fv.ASSEMBLY_FIELDS) + ">"
    records = frame([("S", "ok", "yes", 3, [], [])], f"pdb string, status string, assembly_done string, n_interfaces int, interfaces array<{face}>, assemblies array<{body}>")
    # an id that comes twice meets both of its rows, one that is null meets none
    pairs = frame([("a", "S", "A", "C"), ("a", "S", "A", "C"), (None, "S", "A", "C")], "id string, pdb string, pep_chain string, prot_chain string")
    calls, fanout = [], interfaces.pdb_fanout
    monkeypatch.setattr(interfaces, "pdb_fanout", lambda *a, **k: calls.append(a) or fanout(*a, **k))
    table = interfaces.interface_table(pairs, records, frame([("a", fv.XRAY)], "id string, STRUCTURE_METHOD string"))
    rows = table.select("id", "pisa_status", "pisa_n_interfaces").collect()
    assert len(calls) == 1 and sorted(map(tuple, rows), key=str) == [*[("a", "ok", "3")] * 4, (None, "ok", "")]


def test_release_diff_counts(frame):
    old = frame([("same", "x", "1"), ("changed", "x", None), ("gone", "x", "1"), ("null", None, "1")], "id string, a string, dropped string")
    new = frame([("same", "x", 5), ("changed", "y", 5), ("new", "x", 5), ("null", "", 5)], "id string, a string, extra int")
    r = quality.release_diff(new, old).first()
    assert (r.prev_n, r.cur_n, r.added, r.removed, r.common, r.changed) == (4, 4, 1, 1, 3, 1)


def test_self_scorecard_is_complete(frame):
    df = frame([("a", "1.5", "t"), ("b", "2", None)], "id string, MW string, name string")
    card = quality.scorecard({"t": quality.tolerance_hits(df, df, [("MW", "MW", 0.0)]), "e": quality.exact_hits(df, df, ["name"])})
    assert {r.pct for r in card.collect()} == {"100.0%"}
    empty = quality.scorecard({"t": quality.tolerance_hits(df.limit(0), df, [("MW", "MW", 0.0)])}).first()
    assert (empty.n, empty.pct) == (0, "n/a")


def test_tolerance_is_inclusive_and_unparsable_is_a_miss(frame):
    ours = frame([("a", "1.0"), ("b", "n/a"), ("c", "5.0")], "id string, v string")
    theirs = frame([("a", "2.0"), ("b", "2.0"), ("c", "6.01"), ("z", "1")], "id string, w string")
    r = quality.tolerance_hits(ours, theirs, [("v", "w", 1.0)]).first()
    assert (r.hits, r.n, r.pct) == (1, 3, 33.3)


def test_class_breakdown_order(frame):
    df = frame([("zeta",), (None,), ("biological",), ("alpha",), (" ",)], "class string")
    got = quality.class_breakdown(df).collect()
    assert [(r["class"], r.n, r.pct) for r in got] == [("biological", 1, 20.0), ("(blank)", 2, 40.0), ("alpha", 1, 20.0), ("zeta", 1, 20.0)]


def test_best_models_ignore_nan_and_keep_the_first_on_ties(frame):
    df = frame([("c", "m0", float("nan"), "nan", 0), ("c", "m1", 0.2, "0.7", 1), ("c", "m2", 0.2, "0.9", 2), ("c", "m3", 0.4, "0.9", 3)],
               "class string, model string, brier double, auc string, pos int")
    assert quality.best_by_brier(df).first().model == "m1" and quality.best_by_auc(df).first().model == "m2"


def test_ledger_keeps_dates_and_never_shrinks(frame):
    day = datetime.date
    ledger = frame([("old", day(2020, 1, 1)), ("absent", day(2019, 1, 1))], "id string, first_release date")
    whole, now = incremental.first_release_ledger(ledger, frame([("old",), ("new",)], "id string"), "2026-08-30")
    assert rows(whole, "id", "first_release") == [("absent", day(2019, 1, 1)), ("new", day(2026, 8, 30)), ("old", day(2020, 1, 1))]
    assert rows(now, "id") == [("new",), ("old",)]


def test_record_store_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "records")
    records = frame([("a", "ok", "r"), ("b", "retry:timeout", None), ("c", "no_dg", None)], "id string, status string, record string")
    incremental.append_records(records, path, "energy", "sig1")
    stored = incremental.stored_records(spark, path, "energy", "sig1")
    assert rows(stored, "id") == [("a",), ("c",)]
    incremental.append_records(frame([("a", "no_dg", "new")], "id string, status string, record string"), path, "energy", "sig1")
    assert {r.id: r.record for r in incremental.stored_records(spark, path, "energy", "sig1").collect()} == {"a": "new", "c": None}
    done = stored.select("id", F.lit("sig1").alias("signature"))
    items = frame([("a",), ("b",), ("c",)], "id string")
    assert rows(membership.incremental_todo(items, done, "sig1"), "id") == [("b",)]
    assert membership.incremental_todo(items, done, "other").count() == 3


def test_stream_folds_snapshots_into_versions(spark, frame, tmp_path):
    folder, ledger, check = (str(tmp_path / n) for n in ("in", "ledger", "check"))
    frame([("a",), ("b",)], "id string").coalesce(1).write.parquet(folder)
    first = incremental.follow_snapshots(spark, folder, "id string", ledger, "2026-01-01", check)
    frame([("b",), ("c",)], "id string").coalesce(1).write.mode("append").parquet(folder)
    last = incremental.follow_snapshots(spark, folder, "id string", ledger, "2026-02-01", check)
    got = {r.id: str(r.first_release) for r in spark.read.parquet(f"{ledger}/v={last}").collect()}
    again = incremental.follow_snapshots(spark, folder, "id string", ledger, "2026-03-01", str(tmp_path / "lost"))
    kept = {r.id: str(r.first_release) for r in spark.read.parquet(f"{ledger}/v={again}").collect()}
    assert again > last and kept == got
    assert last > first and got == {"a": "2026-01-01", "b": "2026-01-01", "c": "2026-02-01"}


def test_sample_is_seeded_and_complete(frame):
    ids = frame([(f"i{i}",) for i in range(30)], "pdb string")
    one, two = (rows(membership.snapshot_sample(ids, ids, 10, seed), "pdb") for seed in (1, 1))
    assert one == two and len(one) == 10 and one != rows(membership.snapshot_sample(ids, ids, 10, 2), "pdb")
    assert membership.snapshot_sample(ids, ids.limit(3), 10, 1).count() == 3


def test_recall_of_an_empty_oracle_is_null(frame):
    empty = frame([], "pdb string")
    assert membership.oracle_recall(frame([("A",)], "pdb string"), empty)[1].first().recall is None


def test_variant_distance_also_sets_the_energy_distance():
    merged = membership.variant_cutoffs()
    assert merged["dist8"]["energy_distance"] == 8.0 and merged["bsa10"]["energy_distance"] == 6.0 and merged["pep2_30"]["prot_min"] == 31


def test_projection_prefers_the_exact_name(frame):
    df = frame([("low", "up")], "pisa_css string, Other string")
    got = features.project_ordered(df, ["PISA_CSS", "other", "none"]).first()
    assert tuple(got) == ("low", "up", "")


def test_entities_last_chain_wins_and_sources_have_ranks(frame):
    pairs = frame([("S-A-B", "S", "A", "B"), ("T-A-B", "T", "A", "B")], "id string, pdb string, pep_chain string, prot_chain string")
    poly = frame([("S", 0, "1", "A, B"), ("S", 1, "2", "B")], "pdb string, pos int, entity string, strands string")
    entity = frame([("S", "1", "pep"), ("S", "2", "?")], "pdb string, entity string, description string")
    sources = frame([("S", 0, "2", "syn", "made"), ("S", 0, "1", "nat", "?"), ("S", 1, "2", "gen", "homo"), ("T", 0, "9", "syn", "mus")], "pdb string, pos int, entity string, kind string, name string")
    got = {r.id: r for r in features.entity_resolve(pairs, poly, entity, sources).collect()}
    s, t = got["S-A-B"], got["T-A-B"]
    assert (s.PEPTIDE_DESC, s.PROTEIN_DESC, s.organism, s.PEPTIDE_ORGANISM) == ("pep", "", "HOMO", "HOMO")
    assert (t.PEPTIDE_DESC, t.organism) == ("", "MUS")


def _sources(frame, pairs):
    surface = pairs.select("id", *[F.lit(1.5).alias(c) for c in fv.SURFACE_NAMES])
    metadata = pairs.select("id", *[F.lit(f"{c};x").alias(c) for c in fv.METADATA_NAMES])
    energy = pairs.select("id", *[F.lit(2).alias(c) for c in fv.ENERGY_NAMES])
    listed = pairs.select("id", F.array(F.lit(3), F.lit(5)).alias("interface_residues"))
    inherited = pairs.select("id", *[F.lit("c").alias(c) for c in fv.INHERITED_NAMES])
    ledger = pairs.select("id", F.lit("2026-08-30").cast("date").alias("first_release"))
    names = ["assembly_done", "n_interfaces", *fv.INTERFACE_FIELDS, *fv.ASSEMBLY_FIELDS]
    records = pairs.select("id", F.lit("ok").alias("pisa_status"), F.lit("biological").alias("pisa_interface_class"), *[F.lit("7").alias(f"pisa_{c}") for c in names])
    scores = pairs.select("id", *[F.lit("0.5").alias(c) for c in fv.PEPTIDE_CLASSES])
    return {"surface": surface, "metadata": metadata, "energy": energy, "interface": listed, "inherited": inherited, "ledger": ledger, "records": records, "scores": scores,
            "clusters": groups.exact_cluster(pairs, "id", "pep_seq")}


def test_wide_and_multi_tables(frame):
    from contactforge.functions.properties import physchem_profile

    pairs = frame([("S-P-A", "S", "P", "A", 3, 60, "ACD", "ACDEF"), ("S-P-B", "S", "P", "B", 3, 70, "ACD", "XX"), ("S-Q-B", "S", "Q", "B", 3, 70, "AAA", "XX")], PAIRS)
    sources = _sources(frame, pairs)
    sources["surface"] = sources["surface"].filter("id <> 'S-Q-B'")
    wide = build.build_wide(pairs, sources)
    assert wide.columns == fv.WIDE_ORDER + fv.ADDED_ORDER and len(wide.columns) == 102
    got = {r.id: r for r in wide.collect()}
    assert set(got) == {"S-P-A", "S-P-B"}
    assert got["S-P-A"]["Interface Residues"] == "3,5" and got["S-P-A"].peptide_Formula.startswith("C10") and got["S-P-B"].protein_MW == ""
    assert got["S-P-B"].seq100_clusters == "S-P-A" and got["S-P-A"].FIRST_RELEASE == "2026-08-30"

    multi = groups.multi_group(pairs.filter("id <> 'S-Q-B'"))
    keyed = multi.select("cluster_id")
    per_multi = {**sources, "surface": keyed.select("cluster_id", *[F.lit(9.5).alias(c) for c in fv.SURFACE_NAMES]),
                 "energy": keyed.select("cluster_id", *[F.lit("1:2").alias(c) for c in fv.ENERGY_NAMES])}
    table = build.build_multi(multi, per_multi, physchem_profile(pairs))
    assert len(table.columns) == 68
    row = table.first()
    assert row[0] == row[56] == "S-P" and row["Interface Residues"] == "3,5:3,5" and row.pisa_css_per_chain == "7:7"
    assert row.protein_MW.endswith(":") and row.peptide_Length == "3" and row.pisa_interface_class_per_chain == "biological:biological"


def test_metadata_of_pairs(frame):
    from contactforge.plans import build

    pairs = frame([("1ABC-A-B", "1ABC", "A", "B"), ("1ABC-A-Z", "1ABC", "A", "Z"), ("2XYZ-A-B", "2XYZ", "A", "B"), ("3NON-A-B", "3NON", "A", "B")], "id string, pdb string, pep_chain string, prot_chain string")
    items = frame([
        ("1ABC", 1, "_struct.title", "?"), ("1ABC", 2, "_struct.title", "a\tb"), ("1ABC", 3, "_struct.title", "later"), ("1ABC", 9, "_refine.ls_d_res_high", "."),
        ("1ABC", 5, "_reflns.d_resolution_high", "2.30"), ("1ABC", 4, "_em_3d_reconstruction.resolution", "9"), ("1ABC", 6, "_exptl.method", None),
        ("2XYZ", 1, "_cell.length_a", "3"),
    ], "pdb string, pos int, item string, value string")
    poly = frame([("1ABC", 1, 1, "A, C"), ("1ABC", 2, 2, "B")], "pdb string, pos int, entity int, strands string")
    entity = frame([("1ABC", 1, "pep"), ("1ABC", 2, ".")], "pdb string, entity int, description string")
    sources = frame([("1ABC", 1, 2, "nat", "Homo sapiens"), ("1ABC", 2, 1, "gen", "?")], "pdb string, pos int, entity int, kind string, name string")
    rows = {r.id: r.asDict() for r in build.build_metadata(pairs, items, poly, entity, sources).collect()}
    assert set(rows) == {"1ABC-A-B", "1ABC-A-Z", "2XYZ-A-B"}  # the third structure has no header
    one = rows["1ABC-A-B"]
    assert (one["TITLE"], one["RESOLUTION"], one["STRUCTURE_METHOD"], one["CLASSIFICATION"]) == ("a b", "2.3", "", "")
    assert (one["PEPTIDE_DESC"], one["PROTEIN_DESC"], one["organism"], one["PEPTIDE_ORGANISM"]) == ("pep", "", "HOMO SAPIENS", "HOMO SAPIENS")
    assert rows["1ABC-A-Z"]["PROTEIN_DESC"] == "" and set(rows["2XYZ-A-B"].values()) == {"2XYZ-A-B", ""}
    assert build.build_metadata(pairs, items.limit(0), poly, entity, sources).count() == 0


def test_extraction_hits(frame):
    from contactforge.operators.quality import extraction_hits

    pairs = frame([("a", 5, "ACD"), ("b", 6, "AC"), ("c", 7, None), ("d", 8, "X")], "id string, pep_size int, pep_seq string")
    before = frame([("a", "5", "ACD"), ("b", "06", " AC"), ("c", None, "")], "id string, PEPTIDE_SIZE string, PEPTIDE_SEQ string")
    assert {tuple(r) for r in extraction_hits(pairs, before).collect()} == {("size", 1, 3, 33.3), ("sequence", 2, 3, 66.7)}
    assert {tuple(r) for r in extraction_hits(pairs, before.limit(0)).collect()} == {("size", 0, 0, None), ("sequence", 0, 0, None)}


def test_interface_records_are_made_after_the_grouping(spark, frame, tmp_path, monkeypatch):
    from contactforge.catalog import relational

    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_tax double, l_returnflag string, l_linestatus string"
    frame([(1, n, p, 3, 0.0, "R", "F") for n, p in ((2, 7), (1, 9), (1, None))], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    frame([(1,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    plans = []
    monkeypatch.setattr(relational, "staged", lambda df: plans.append(df) or df)
    relational._interface_table(relational.Tables(spark, str(tmp_path)))
    shuffled = [line for line in plans[0]._jdf.queryExecution().executedPlan().toString().splitlines() if "collect_list" in line]
    assert shuffled and all(line.count("collect_list") == 1 and "CASE" not in line and "concat" not in line for line in shuffled)
    record = plans[0].first()
    assert [(r["interface_id"], r["area"], r["chain_1"]) for r in record["interfaces"]] == [("1", None, "R"), ("1", None, "R"), ("2", None, "R")]
    assert record["n_interfaces"] == 3 and [a["composition"] for a in record["assemblies"]] == ["RF"] * 3
