import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contactforge.plans import publish
from contactforge.sources import atoms, delimited, interface_xml

CIF = """data_1ABC
loop_
_atom_site.group_PDB
_atom_site.id
_atom_site.label_atom_id
_atom_site.label_comp_id
_atom_site.label_asym_id
_atom_site.label_seq_id
_atom_site.pdbx_PDB_ins_code
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.auth_seq_id
_atom_site.auth_asym_id
_atom_site.pdbx_PDB_model_num
ATOM   1 N  ALA A 1 ? 1.0 2.0 3.0 11 X 1
HETATM 2 O  HOH B . ? 4.0 5.0 6.5 99 X 1
ATOM   3 CA GLY A 2 B 7.0 8.0 9.0 12 X
#
ATOM   4 late rows are outside the loop
"""


def lines(folder):
    out = []
    for root, _, names in os.walk(folder):
        for name in sorted(names):
            if name.startswith("part-"):
                with open(os.path.join(root, name)) as fh:
                    out += fh.read().splitlines()
    return out


def test_coordinate_text(spark, tmp_path):
    shard = tmp_path / "ab"
    shard.mkdir()
    with gzip.open(shard / "1ABC.cif.gz", "wt") as fh:
        fh.write(CIF)
    (tmp_path / "2XYZ.cif").write_text(CIF.replace("_atom_site.label_seq_id\n", "").replace("A 1 ?", "A ?").replace("B . ?", "B ?").replace("A 2 B", "A B"))
    got = {(r.pdb, r.pos): r for r in atoms.atom_site_table(spark, str(tmp_path)).collect()}
    assert sorted(got) == [("1ABC", 0), ("1ABC", 1), ("1ABC", 2), ("2XYZ", 0), ("2XYZ", 1), ("2XYZ", 2)]
    r = got["1ABC", 1]
    assert (r.group_pdb, r.chain, r.label_chain, r.resseq, r.label_seq, r.resname, r.z, r.model) == ("HETATM", "X", "B", 99, ".", "HOH", 6.5, 1)
    assert got["1ABC", 2].icode == "B" and got["1ABC", 2].model is None
    assert got["2XYZ", 0].label_seq is None and got["2XYZ", 0].x == 1.0


XML = """<pisa><name>x</name><interface><id>1</id><type>1</type><int_area>977.1</int_area><int_solv_en>-5</int_solv_en><pvalue>0.1</pvalue><css>0.8</css>
<h-bonds><n_bonds>9</n_bonds></h-bonds><molecule><chain_id>C</chain_id><int_nres>9</int_nres><int_natoms>67</int_natoms></molecule>
<molecule><chain_id>A</chain_id><int_nres>35</int_nres></molecule></interface>
<interface><id>2</id><molecule><chain_id>B</chain_id></molecule></interface></pisa>"""
ASSEMBLIES = "<r><asm_set><assembly><composition>AC</composition><diss_energy>8.067</diss_energy></assembly></asm_set></r>"


def test_interface_xml(spark, tmp_path):
    (tmp_path / "1A1M_interfaces.xml").write_text(XML)
    got = {r.interface_id: r for r in interface_xml.read_interfaces_xml(spark, str(tmp_path / "1A1M_interfaces.xml")).collect()}
    assert (got["1"].pdb, got["1"].chain_1, got["1"].chain_2, got["1"].n_hbonds, got["1"].n_saltbridges, got["1"].nres_2) == ("1A1M", "C", "A", "9", "", "35")
    assert (got["2"].chain_1, got["2"].chain_2, got["2"].css) == ("B", "", "")
    (tmp_path / "1A1M_assemblies.xml").write_text(ASSEMBLIES)
    row = interface_xml.read_assemblies_xml(spark, str(tmp_path / "1A1M_assemblies.xml")).first()
    assert (row.pdb, row.composition, row.diss_energy, row.asa) == ("1A1M", "AC", "8.067", "")


def test_delimited_sources(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('id\tv\na\t\nb\t"q"\n')
    assert [tuple(r) for r in delimited.read_delimited(spark, str(tmp_path / "t.tsv")).collect()] == [("a", ""), ("b", '"q"')]
    (tmp_path / "v.csv").write_text("a,1,2.5\n")
    assert delimited.read_vectors(spark, str(tmp_path / "v.csv")).first().vec == [1.0, 2.5]
    (tmp_path / "ids.txt").write_text(" 1abc\n\n1ABC\n2def\n")
    assert sorted(r.pdb for r in delimited.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["1ABC", "2DEF"]
    (tmp_path / "ids.csv").write_text("id;PDB_ID\nx;1abc\ny;\n")
    assert [r.pdb for r in delimited.read_id_list(spark, str(tmp_path / "ids.csv")).collect()] == ["1ABC"]
    (tmp_path / "order.txt").write_text("# note\n\nid\n BSA \n")
    order = delimited.read_column_order(spark, str(tmp_path / "order.txt"))
    assert sorted(map(tuple, order.collect())) == [(0, "id"), (1, "BSA")]
    (tmp_path / "train.tsv").write_text("seq\ttarget\nacdx\tPositive\nAX\tpos\nACDE\tneg\n")
    got = [(r.seq, r.y) for r in delimited.read_labelled_seqs(spark, str(tmp_path / "train.tsv")).orderBy("row").collect()]
    assert got == [("ACD", 1), ("ACDE", 0)]
    (tmp_path / "members.tsv").write_text("L\t1\ta\nM\t2\ta, b\n")
    assert delimited.read_cluster_members(spark, str(tmp_path / "members.tsv")).count() == 3


def test_final_table_is_sorted_sanitised_and_may_repeat_a_name(frame, tmp_path):
    df = frame([("b", "x;y", "1"), ("a", "t\tq", None)], "id string, v string, again string").coalesce(1)
    publish.write_final(df, str(tmp_path / "out"), header=["id", "v", "id"])
    assert [l for l in lines(tmp_path / "out") if l != "id;v;id"] == ["a;t q;", "b;x,y;1"]
    assert "id;v;id" in lines(tmp_path / "out")


def test_entry_files(frame, tmp_path):
    df = frame([("1AB-C-D", "t", 3), ("2XY-C-D", "u", 4)], "id string, TITLE string, n int")
    publish.split_per_entry(df, str(tmp_path / "e"), order=["title", "gone", "id"])
    assert lines(tmp_path / "e" / "shard=1") == ["t;;1AB-C-D"] and lines(tmp_path / "e" / "shard=2") == ["u;;2XY-C-D"]
    publish.split_per_entry(df, str(tmp_path / "plain"))
    assert lines(tmp_path / "plain" / "shard=1") == ["1AB-C-D;t;3"]
    publish.write_summary(df, str(tmp_path / "s"))
    assert all(len(l.split("\t")) == 25 for l in lines(tmp_path / "s"))


def test_fasta(frame, tmp_path):
    from contactforge.operators.features import column_manifest, fasta_export

    df = frame([("a", " ACD ", "one\r\ntwo"), ("b", "", "x"), ("c", "GG", None)], "id string, seq string, desc string")
    publish.write_fasta(fasta_export(df, "Peptide"), str(tmp_path / "f"))
    assert lines(tmp_path / "f") == [">a | one  two", "ACD", ">c | Peptide", "GG"]
    assert [tuple(r) for r in column_manifest(df).collect()] == [(0, "id"), (1, "seq"), (2, "desc")]


def test_sharded_sinks(spark, frame, tmp_path):
    contacts = frame([("1AB-C-D", "C", 2.5)], "id string, chain1 string, distance double")
    publish.contacts_publish(contacts, str(tmp_path / "c"))
    assert "1AB-C-D,C,2.5" in lines(tmp_path / "c" / "shard=1")
    publish.structures_publish(frame([("1ABC", 1.0)], "pdb string, x double"), str(tmp_path / "a"))
    assert os.path.isdir(tmp_path / "a" / "shard=ab")
    publish.cluster_tables_publish({"sequence": frame([("L", "m")], "label string, member string")}, str(tmp_path / "k"))
    assert lines(tmp_path / "k" / "kind=sequence") == ["L\tm"]


def test_release_is_immutable(spark, frame, tmp_path):
    df = frame([("a",), ("b",)], "id string")
    counts = publish.release_snapshot({"pairs": df}, str(tmp_path), "2026-08-30")
    assert [tuple(r) for r in counts.collect()] == [("pairs", 2)]
    assert '\\"pairs\\":2' in lines(tmp_path / "release-2026-08-30" / "manifest")[0]
    with pytest.raises(PySparkException):
        publish.release_snapshot({"pairs": df}, str(tmp_path), "2026-08-30")


def test_interface_files_are_written_compressed(spark, frame, tmp_path, monkeypatch):
    from contactforge.catalog import storage

    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_tax double, l_returnflag string, l_linestatus string"
    frame([(k, k % 7 + 1, 10 * k, k % 3, 0.01 * (k % 2), "R", "F") for k in range(30)], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(storage, "written", lambda t: f"{tmp_path}/xml")
    found = storage._read_interfaces_xml(storage.Tables(spark, str(tmp_path))).collect()
    assert sorted((r["pdb"], r["pos"]) for r in found) == [(f"S{s}", p) for s in range(3) for p in range(10)]
    assert {r["interface_id"] for r in found if r["pdb"] == "S1"} == {str(k) for k in range(1, 30, 3)}
    written = [p.name for p in (tmp_path / "xml").rglob("part-*")]
    assert written and all(name.endswith(".xml.gz") for name in written)
