"""Text-level column expressions: cleaning, keys, dates and parameter signatures."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import RESIDUES, THREE_TO_ONE


def standard_only(seq: Column) -> Column:
    """The sequence in capitals with every letter outside the twenty residues removed."""
    return F.regexp_replace(F.upper(seq), f"[^{RESIDUES}]", "")


def stripped_length(seq: Column) -> Column:
    return F.length(seq) - F.length(standard_only(seq))


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, which may read it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def literal_map(values: dict) -> Column:
    """A constant lookup table as a map literal: needs no join and no broadcast."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def residue_code(name: Column) -> Column:
    """Three-letter residue name to its letter; anything unknown is ``X``."""
    return F.coalesce(F.element_at(literal_map(THREE_TO_ONE), F.upper(name)), F.lit("X"))


def sanitize(value: Column) -> Column:
    """Make a cell safe for a ``;`` table: ``;`` to comma, tab and newline to blank, CR removed."""
    return F.translate(value, ";\t\n\r", ",  ")


def sanitize_cells(df: DataFrame) -> DataFrame:
    """:func:`sanitize` over every string column."""
    return df.withColumns({f.name: sanitize(F.col(f"`{f.name}`")) for f in df.schema if f.dataType.typeName() == "string"})


def entry_id(pdb: Column, pep: Column, prot: Column) -> Column:
    return F.concat_ws("-", pdb, pep, prot)


def entry_parts(entry: Column) -> dict[str, Column]:
    bits = F.split(entry, "-")
    return {"pdb": bits[0], "pep_chain": bits[1], "prot_chain": bits[2]}


def structure_shard(pdb: Column) -> Column:
    """Characters two and three in lower case; ``_`` for ids shorter than three."""
    return F.when(F.length(pdb) >= 3, F.lower(F.substring(pdb, 2, 2))).otherwise(F.lit("_"))


def entry_shard(entry: Column) -> Column:
    return F.substring(entry, 1, 1)


def format_date(day: Column) -> Column:
    """``Mon D, YYYY``."""
    return F.date_format(day, "MMM d, yyyy")


def known(value: Column) -> Column:
    """Null for the markers of a missing value: blank, ``?`` and ``.``."""
    return F.when(~value.isin("", "?", "."), value)


def resolution_value(*sources: Column) -> Column:
    """First known source; numbers lose trailing zeros (``2.30`` to ``2.3``), other text is kept."""
    raw = F.coalesce(*[known(s) for s in sources])
    return F.coalesce(raw.try_cast("double").cast("string"), raw, F.lit(""))


def param_signature(version: str, params: dict[str, object] | Column) -> Column:
    """First 12 hex digits of a SHA-1 over the version and the sorted ``name=value`` settings."""
    if isinstance(params, dict):
        params = F.array(*[F.concat(F.lit(f"{k}="), F.lit(str(v))) for k, v in sorted(params.items())])
    return F.substring(F.sha1(F.concat_ws("|", F.lit(str(version)), F.array_sort(params))), 1, 12)


def content_key(ids: Column) -> Column:
    """First 16 hex digits of a SHA-1 over a sorted, comma-joined id array."""
    return F.substring(F.sha1(F.array_join(F.array_sort(ids), ",")), 1, 16)


def status_head(status: Column) -> Column:
    """The part of a status before its ``:`` payload."""
    return F.split(status, ":")[0]
