"""Atoms table from a folder of coordinate text files (plain or compressed)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .streams import line_pieces, streamed

FIELDS = {
    "group_pdb": "group_PDB", "label_chain": "label_asym_id", "chain": "auth_asym_id", "resseq": "auth_seq_id",
    "label_seq": "label_seq_id", "icode": "pdbx_PDB_ins_code", "resname": "label_comp_id", "atom_name": "label_atom_id",
    "x": "Cartn_x", "y": "Cartn_y", "z": "Cartn_z", "model": "pdbx_PDB_model_num",
}
TYPES = {"resseq": "int", "model": "int", "x": "double", "y": "double", "z": "double"}
ROW = ("ATOM ", "HETATM")
FILE_NAME = r"([^/]+?)(\.cif)?(\.gz)?$"


def _cells(lines: list[str], columns: list[int | None], pos: int) -> pa.RecordBatch:
    """The wanted fields of coordinate lines; null where the header doesn't name one or a line ends before it."""
    fields = pc.ascii_split_whitespace(pa.array(lines, pa.string()))
    offsets, values = fields.offsets.to_numpy(), fields.values
    out = []
    for column in columns:
        if column is None:
            out.append(pa.nulls(len(lines), pa.string()))
            continue
        at = offsets[:-1] + column
        out.append(values.take(pa.array(at, mask=at >= offsets[1:])))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(pos, pos + len(lines)), pa.int64()), *out], names=["pos", *FIELDS])


def atom_batches(path: str) -> Iterator[pa.RecordBatch]:
    """The coordinate loop of one text: its header, then its lines up to the first other one, where reading ends."""
    names, columns, pos = [], None, 0
    for lines in line_pieces(path):
        start = 0
        if columns is None:
            for start, line in enumerate(lines):
                if line.startswith("_atom_site."):
                    names.append(line.split()[0].removeprefix("_atom_site."))
                elif line.startswith(ROW):
                    columns = [names.index(f) if f in names else None for f in FIELDS.values()]
                    break
            else:
                continue
        end = next((i for i in range(start, len(lines)) if not lines[i].startswith(ROW)), len(lines))
        if end > start:
            yield _cells(lines[start:end], columns, pos)
            pos += end - start
        if end < len(lines):
            return


def atom_site_table(spark: SparkSession, folder: str, id_pattern: str = FILE_NAME) -> DataFrame:
    """One row per coordinate line of every file below ``folder``, with its position in the loop.

    Files are independent streams, so the scan needs no shuffle and no text is held whole. A field the header does not name is null, as is a
    number that cannot be read. ``id_pattern`` takes the structure id from the path.
    """
    text = streamed(spark, folder, atom_batches, "pos long, " + ", ".join(f"{n} string" for n in FIELDS), id_pattern)
    out = {n: F.col(n).try_cast(TYPES[n]) if n in TYPES else F.col(n) for n in FIELDS}
    out["icode"] = F.when(~F.col("icode").isin("?", "."), F.col("icode")).otherwise(F.lit(""))
    return text.select("pdb", "pos", *[c.alias(n) for n, c in out.items()])
