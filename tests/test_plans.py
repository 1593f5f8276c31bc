from contactforge import fixed_values as fv
from contactforge.plans import build, publish


def test_surface_and_energy_of_one_pair(frame):
    rows = [("S", "P", i, "LYS", 3.0 * i, 0.0, 0.0, 1.8) for i in range(3)] + [("S", "Q", i, "GLU", 3.0 * i, 4.5, 0.0, 1.8) for i in range(6)]
    atoms = frame(rows, "pdb string, chain string, resseq int, resname string, x double, y double, z double, radius double")
    pairs = frame([("S-P-Q", "S", "P", "Q")], "id string, pdb string, pep_chain string, prot_chain string")
    surface = build.build_surface(pairs, atoms, n_points=100).first()
    assert surface.BSA > 0 and abs(surface.BPepA + surface.BProA - 2 * surface.BSA) < 0.03
    energy = build.build_energy(pairs, atoms, n_points=100).first()
    # within 6 of each other: 2 + 3 + 3 residue pairs (steps of 3 along x, 4.5 apart in y)
    assert energy.n_intermolecular == energy.n_charged_charged == 8
    assert (energy.nis_apolar, energy.nis_charged) == (0.0, 100.0)
    assert abs(energy.dg - (fv.ENERGY_INTERCEPT - 0.09459 * 8 + 13.81)) < 1e-9


def _letters(frame, pairs):
    from pyspark.sql import functions as F

    named = pairs.select("id", *[F.lit("7").alias(f"pisa_{c}") for c in ("css", *[c for c in fv.INTERFACE_FIELDS if c != "css"])], F.lit("biological").alias("pisa_interface_class"))
    return {"surface": pairs.select("id", *[F.lit(1.5).alias(c) for c in fv.SURFACE_NAMES]), "records": named,
            "metadata": pairs.select("id", *[F.lit("m").alias(c) for c in fv.METADATA_NAMES]), "inherited": pairs.select("id", *[F.lit("c").alias(c) for c in fv.INHERITED_NAMES]),
            "ledger": pairs.select("id", F.lit("2026-01-01").cast("date").alias("first_release")), "interface": pairs.select("id", F.array(F.lit(3)).alias("interface_residues")),
            "scores": pairs.select("id", *[F.lit("0.5").alias(c) for c in fv.PEPTIDE_CLASSES])}


def test_bucketed_sources_meet_without_an_exchange(spark, frame):
    from contactforge.functions.properties import physchem_profile
    from contactforge.plans.bucketed import bucketed, bucketed_sources

    pairs = frame([(f"S-P-{c}", "S", "P", c, 3, 60, "ACD", "ACDEF") for c in "ABCDEF"], "id string, pdb string, pep_chain string, prot_chain string, pep_size int, prot_size int, pep_seq string, prot_seq string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sources, profile = _letters(frame, pairs), physchem_profile(pairs)
        plain = build.build_wide(pairs, sources, profile)
        kept = bucketed_sources({**sources, "profile": profile})
        wide = build.build_wide(bucketed(pairs), kept, kept["profile"])
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("ReusedExchange", "") and plan.count("SortMergeJoin") >= 8
        assert "Exchange hashpartitioning" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(wide.collect()) == sorted(plain.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_placed_rows_are_bucketed_without_a_shuffle(spark, frame):
    from contactforge.functions.properties import physchem_profile
    from contactforge.plans.bucketed import bucketed, bucketed_sources

    pairs = bucketed(frame([(f"S-P-{c}", "ACD", "ACDEF") for c in "ABCDEFGH"], "id string, pep_seq string, prot_seq string"))
    profile = physchem_profile(pairs, frame([("AC", 2.0)], "kmer string, weight double"))
    shuffles = spark.sparkContext._jsc.sc().newShuffleId()
    placed = bucketed_sources({"profile": profile}, placed=("profile",))["profile"]
    assert spark.sparkContext._jsc.sc().newShuffleId() == shuffles + 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = pairs.join(placed, "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(placed.collect()) == sorted(profile.collect()) and joined.count() == 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_the_first_item_carries_the_cells_of_the_peptide(spark, frame, monkeypatch):
    from pyspark.sql import functions as F

    from contactforge.functions.properties import physchem_profile
    from contactforge.operators import groups

    pairs = frame([(f"S-P-{c}", "S", "P", c, 3, 60, "ACD", "ACDEF") for c in "ABC"], "id string, pdb string, pep_chain string, prot_chain string, pep_size int, prot_size int, pep_seq string, prot_seq string")
    multi = groups.multi_group(pairs)
    sources = {**_letters(frame, pairs), "surface": multi.select("cluster_id", *[F.lit(9.5).alias(c) for c in fv.SURFACE_NAMES]), "energy": multi.select("cluster_id", *[F.lit("1").alias(c) for c in fv.ENERGY_NAMES])}
    sources["metadata"] = pairs.select("id", *[F.concat(F.lit("of "), "prot_chain").alias(c) for c in fv.METADATA_NAMES])
    collected, collect = [], F.collect_list
    monkeypatch.setattr(F, "collect_list", lambda c: collected.append(c) or collect(c))
    row = build.build_multi(multi, sources, physchem_profile(pairs)).first()
    assert row.TITLE == "of A" and row.PROTEIN_DESC == "of A:of B:of C" and row.peptide_MW
    assert "(pos, 0) THEN" in str(collected[-1])


def test_class_of_a_list_is_the_grouped_rule(frame):
    from itertools import product

    from pyspark.sql import functions as F

    from contactforge.operators import groups

    kinds = ["biological", "crystal-packing", "indeterminate", "not_applicable", ""]
    rows = [(f"{i}", pos, c) for i, cs in enumerate([*product(kinds, repeat=2), *product(kinds, repeat=3)]) for pos, c in enumerate(cs)]
    df = frame(rows, "cluster_id string, pos int, class string")
    lists = df.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("pos", "class"))).alias("m")).select("cluster_id", groups.class_of_list(F.col("m.class")).alias("class"))
    assert sorted(lists.collect()) == sorted(groups.aggregate_class(df).select("cluster_id", "class").collect())


def test_workers_need_no_package_of_their_own(spark):
    import zipfile

    from contactforge.session import ship

    ship(spark)
    shipped = [f for f in spark.sparkContext.listFiles if f.endswith("contactforge.zip")]
    ship(spark)
    assert len(shipped) == 1 == len([f for f in spark.sparkContext.listFiles if f.endswith("contactforge.zip")])
    names = zipfile.ZipFile(f"{__import__('pyspark').SparkFiles.get('contactforge.zip')}").namelist()
    assert "contactforge/operators/octree.py" in names


def test_deliverables_are_counted_while_they_are_written(spark, frame, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    rows = spark.range(1000)
    frames = {"all": rows.mapInArrow(seen, "id long"), "sorted": rows.filter("id < 10").orderBy("id"), "none": rows.filter("id < 0"), "literal": frame([], "id long")}
    counts = publish.release_snapshot(frames, str(tmp_path), "2026-08-30")
    assert {r.deliverable: r.n for r in counts.collect()} == {"all": 1000, "sorted": 10, "none": 0, "literal": 0}
    assert runs.value == 1000  # computed once
    manifest = spark.read.text(f"{tmp_path}/release-2026-08-30/manifest").first().value
    assert '"release-2026-08-30"' in manifest and "1000" in manifest
