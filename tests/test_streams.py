"""Streaming sources: records across pieces, early ends, positions, and memory that doesn't follow a text's length."""
import gzip
import resource

from contactforge import fixed_values as fv
from contactforge.sources import atoms, interface_xml, streams

HEADER = "".join(f"_atom_site.{n}\n" for n in atoms.FIELDS.values())
LINE = "ATOM A A {0} 1 ? ALA CA 1.5 2.5 {0}.25 1\n"


def loop(n):
    return "data_x\nloop_\n" + HEADER + "".join(LINE.format(i) for i in range(n)) + "#\nATOM after the loop\n"


def test_lines_are_whole_whatever_the_piece(tmp_path, monkeypatch):
    (tmp_path / "a.cif").write_text(loop(50))
    whole = [b.to_pylist() for b in atoms.atom_batches(str(tmp_path / "a.cif"))]
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(streams, "PIECE", size)
        rows = [r for b in atoms.atom_batches(f"file:{tmp_path}/a.cif") for r in b.to_pylist()]
        assert rows == [r for b in whole for r in b] and [r["pos"] for r in rows] == list(range(50)) and rows[49]["z"] == "49.25"


def test_texts_without_a_loop_and_short_lines(tmp_path):
    for name, text in (("empty", ""), ("none", "data_x\n#\n"), ("bare", "ATOM 1 2\n"), ("cut", "loop_\n" + HEADER + "ATOM A B 1\nHETATM A\n")):
        (tmp_path / name).write_text(text)
    read = {p.name: [r for b in atoms.atom_batches(str(p)) for r in b.to_pylist()] for p in tmp_path.iterdir()}
    assert read["empty"] == read["none"] == []
    assert len(read["bare"]) == 1 and set(read["bare"][0].values()) == {0, None}
    assert [(r["group_pdb"], r["label_chain"], r["resseq"], r["x"]) for r in read["cut"]] == [("ATOM", "A", "1", None), ("HETATM", "A", None, None)]


def test_a_long_compressed_text_is_never_held_whole(tmp_path):
    """400 MB of lines in a small gzip file; what a reader adds to the process stays far below."""
    block = "".join(LINE.format(i % 1000) for i in range(100_000)).encode()
    with gzip.open(tmp_path / "long.cif.gz", "wb", compresslevel=1) as out:
        out.write(("loop_\n" + HEADER).encode())
        for _ in range(100):
            out.write(block)
    before, n, last = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, 0, -1
    for batch in atoms.atom_batches(str(tmp_path / "long.cif.gz")):
        assert batch.column("pos")[0].as_py() == last + 1
        n, last = n + batch.num_rows, batch.column("pos")[batch.num_rows - 1].as_py()
    assert n == 10_000_000 and len(block) * 100 > 390_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000


def test_xml_records_keep_their_place_in_the_file(spark, tmp_path, monkeypatch):
    record = "<interface><id>{0}</id><h-bonds><n_bonds>2</n_bonds></h-bonds><molecule><chain_id>A</chain_id></molecule><molecule><chain_id>B</chain_id><int_area>{0}.5</int_area></molecule></interface>"
    for name, n in (("1AAA_interfaces.xml", 25), ("2BBB_interfaces.xml", 3), ("3CCC_interfaces.xml", 0)):
        (tmp_path / name).write_text("<pdb_entry>" + "".join(record.format(i) for i in range(n)) + "</pdb_entry>")
    monkeypatch.setattr(interface_xml, "RECORDS", 10)
    monkeypatch.setattr(streams, "PIECE", 50)
    read = interface_xml._records("interface", interface_xml.interface_record, fv.INTERFACE_FIELDS)
    batches = list(read(str(tmp_path / "1AAA_interfaces.xml")))
    assert [b.num_rows for b in batches] == [10, 10, 5] and [r["pos"] for b in batches for r in b.to_pylist()] == list(range(25))
    rows = interface_xml.read_interfaces_xml(spark, str(tmp_path)).collect()
    assert len(rows) == 28 and rows[0].asDict().keys() == {"pdb", "pos", *fv.INTERFACE_FIELDS}
    assert all(r["interface_id"] == str(r["pos"]) and r["area_2"] == f"{r['pos']}.5" and r["area_1"] == "" and r["n_hbonds"] == "2" for r in rows)
