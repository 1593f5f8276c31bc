"""Sequence descriptors: k-mer frequencies, codon deviations, class composition/transition/distribution.

All descriptors are narrow: counting happens inside each sequence (see ``vectorised``) and the rest is
column arithmetic, so a signature of the whole table needs no shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..session import byte_batches, staged
from .properties import letter_count
from .text import bind, standard_only
from .vectorised import class_profiler, kmer_counter, kmer_scorer

FIVE = list(fv.FIVE_GROUPS.values())
DIPEPTIDE, GROUP_PAIR, GROUP_TRIPLE, TRIAD = (list(fv.RESIDUES), 2), (FIVE, 2), (FIVE, 3), (fv.SEVEN_GROUPS, 3)
SWITCHES = 3 * len(fv.THREE_CLASSES)
PLACES = 15 * len(fv.THREE_CLASSES)


def kmer_array(seq: Column, k: int) -> Column:
    """All overlapping k-mers as text, phase by phase (their order along the sequence is not kept)."""
    phases = [F.regexp_extract_all(F.substring(seq, j + 1, 2**31 - 1), F.lit("." * k), F.lit(0)) for j in range(k)]
    return phases[0] if k == 1 else F.concat(*phases)


def kmer_rank(kmer: Column, alphabet: str, k: int) -> Column:
    """Rank of a k-mer in the alphabet's k-fold product, first letter slowest."""
    rank = F.lit(0)
    for j in range(k):
        rank = rank * len(alphabet) + F.position(F.substring(kmer, j + 1, 1), F.lit(alphabet)) - 1
    return rank


def dense(sparse: Column, width: int) -> Column:
    """Sorted ``array<struct<i, n>>`` to an ``array<double>`` of fixed width, gaps filled with zero."""

    def with_gap(entry: Column, at: Column) -> Column:
        before = F.coalesce(F.get(sparse, at - 1)["i"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0.0), entry["i"] - before - 1), F.array(entry["n"].cast("double")))

    last = F.coalesce(F.get(sparse, F.size(sparse) - 1)["i"], F.lit(-1))
    tail = F.array_repeat(F.lit(0.0), F.lit(width - 1) - last)
    return F.flatten(F.concat(F.transform(sparse, with_gap), F.array(tail)))


# ---- vector expressions --------------------------------------------------------------------------


def _with(counts: Column, n: Column, use) -> Column:
    """Hand counts and a length to ``use``, each evaluated once.

    The optimiser inlines columns into lambdas, where a text length would be measured again for every
    element; a bound variable cannot be inlined.
    """
    return bind(F.struct(counts.alias("c"), n.alias("n")), lambda b: use(b["c"], b["n"]))


def _shares(counts: Column, total: Column) -> Column:
    return _with(counts, total, lambda c, n: F.transform(c, lambda x: x / n))


def _group_shares(q: Column, groups) -> list[Column]:
    """Share of each residue group, summed from letter counts."""
    return [sum((letter_count(q, r) for r in group), F.lit(0)) / F.length(q) for group in groups]


def aac_vector(q: Column) -> Column:
    return F.array(*_group_shares(q, fv.RESIDUES))


def gaac_vector(q: Column) -> Column:
    return F.array(*_group_shares(q, FIVE))


def ctdc_vector(q: Column) -> Column:
    """Share of each class of each property, from the twenty letter shares."""
    members = [[fv.RESIDUES.index(r) for r in group] for groups in fv.THREE_CLASSES.values() for group in groups]

    def classes(c: Column, n: Column) -> Column:
        return F.transform(F.lit(members), lambda rs: F.aggregate(rs, F.lit(0), lambda a, r: a + F.get(c, r)) / n)

    return _with(F.array(*[letter_count(q, r) for r in fv.RESIDUES]), F.length(q), classes)


def dde_vector(dipeptides: Column, n: Column) -> Column:
    """Deviation of each dipeptide share from its codon mean, in standard deviations."""
    means = [
        (fv.CODONS[a] / fv.CODON_TOTAL) * (fv.CODONS[b] / fv.CODON_TOTAL) for a in fv.RESIDUES for b in fv.RESIDUES
    ]
    def deviations(counts: Column, steps: Column) -> Column:
        return F.zip_with(
            counts, F.lit(means), lambda c, mean: (c / steps - mean) / F.sqrt(mean * (1.0 - mean) / steps)
        )

    return _with(dipeptides, n - 1, deviations)


def triad_vector(counts: Column) -> Column:
    """Triad counts scaled by their range within the sequence."""
    def scaled(c: Column) -> Column:
        limits = F.struct(F.array_min(c).alias("low"), F.array_max(c).alias("high"))
        return bind(limits, lambda m: F.transform(c, lambda x: (x - m["low"]) / m["high"]))

    return bind(counts, scaled)


# ---- DataFrame operators: DF[id, seq] -> DF[id, vec] -----------------------------------------------


def _cleaned(df: DataFrame, key: str, seq: str, length: int = fv.MIN_SIGNATURE_LENGTH) -> DataFrame:
    cleaned = df.select(key, standard_only(F.col(seq)).alias("_q")).withColumn("_len", F.length("_q"))
    return byte_batches(cleaned.filter(F.col("_len") >= length))


def _operator(name: str, vector, kinds: list[tuple] | None = None, profile: bool = False):
    """``vector(q, n, counts, profile)`` builds the vector of one cleaned sequence."""

    def operator(df: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
        base = _cleaned(df, key, seq)
        if kinds:
            base = base.withColumn("_counts", kmer_counter(kinds)("_q"))
        if profile:
            base = base.withColumn("_profile", class_profiler()("_q"))
        cell = vector(F.col("_q"), F.col("_len"), F.col("_counts"), F.col("_profile"))
        return base.select(key, cell.alias("vec"))

    operator.__name__ = name
    return operator


aac = _operator("aac", lambda q, n, c, p: aac_vector(q))
gaac = _operator("gaac", lambda q, n, c, p: gaac_vector(q))
dpc = _operator("dpc", lambda q, n, c, p: _shares(c, n - 1), [DIPEPTIDE])
dde = _operator("dde", lambda q, n, c, p: dde_vector(c, n), [DIPEPTIDE])
gdpc = _operator("gdpc", lambda q, n, c, p: _shares(c, n - 1), [GROUP_PAIR])
gtpc = _operator("gtpc", lambda q, n, c, p: _shares(c, n - 2), [GROUP_TRIPLE])
ctriad = _operator("ctriad", lambda q, n, c, p: triad_vector(c), [TRIAD])
ctdc = _operator("ctdc", lambda q, n, c, p: ctdc_vector(q))
ctdt = _operator("ctdt", lambda q, n, c, p: F.slice(p, 1, SWITCHES), profile=True)
ctdd = _operator("ctdd", lambda q, n, c, p: F.slice(p, SWITCHES + 1, PLACES), profile=True)


def min_length_split(df: DataFrame, length: int = fv.MIN_SIGNATURE_LENGTH, key: str = "id", seq: str = "seq", order: str | None = None):
    """(kept ``DF[key, seq]`` with cleaned sequences, excluded ``DF[key, length]``).

    Of an id's rows the first that is long enough is kept (by ``order``; without one, the longest), and what
    comes after it is passed over; short rows before it are excluded.
    """
    place = F.col(order) if order else -F.length(standard_only(F.col(seq)))
    cleaned = df.select(key, standard_only(F.col(seq)).alias("seq"), place.alias("_at")).withColumn("length", F.length("seq"))
    first = F.min(F.struct("_at", "seq")).alias("_first")
    kept = cleaned.filter(F.col("length") >= length).groupBy(key).agg(first)
    short = cleaned.filter(F.col("length") < length).join(kept, key, "left")
    early = F.col("_first").isNull() | (F.col("_at") < F.col("_first._at"))
    return kept.select(key, "_first.seq"), short.filter(early).select(key, "length")


def seq_signature(df: DataFrame, key: str = "id", seq: str = "seq", with_triads: bool = False) -> DataFrame:
    """The nine descriptors in fixed order as one 1248-wide vector (1591 with triads).

    Every part has a fixed width, so a row that passes the length rule is complete by construction.
    """
    kinds = [DIPEPTIDE, GROUP_PAIR, GROUP_TRIPLE] + ([TRIAD] if with_triads else [])
    base = _cleaned(df, key, seq).withColumns({"_counts": kmer_counter(kinds)("_q"), "_profile": class_profiler()("_q")})
    q, n, counts, profile = F.col("_q"), F.col("_len"), F.col("_counts"), F.col("_profile")
    dipeptides, pairs, triples = F.slice(counts, 1, 400), F.slice(counts, 401, 25), F.slice(counts, 426, 125)
    parts = {
        "aac": aac_vector(q), "dpc": _shares(dipeptides, n - 1), "dde": dde_vector(dipeptides, n),
        "gaac": gaac_vector(q), "gdpc": _shares(pairs, n - 1), "gtpc": _shares(triples, n - 2),
        "ctdc": ctdc_vector(q), "ctdt": F.slice(profile, 1, SWITCHES), "ctdd": F.slice(profile, SWITCHES + 1, PLACES),
    }
    cells = [parts[name] for name in fv.SIGNATURE_ORDER]
    cells += [triad_vector(F.slice(counts, 551, 343))] if with_triads else []
    return base.select(key, F.concat(*cells).alias("vec"))


def distinct_featurise(df: DataFrame, build, key: str = "id", seq: str = "seq") -> DataFrame:
    """Featurise each distinct cleaned sequence once, then hand the vector back to every id.

    The join back runs on a digest of the sequence, and popular sequences are spread over tasks.
    """
    from ..operators.skew import attach_group

    keyed = df.select(F.col(key), standard_only(F.col(seq)).alias("seq")).withColumn("_digest", F.sha2("seq", 256))
    distinct = staged(keyed.groupBy("_digest").agg(F.first("seq").alias("seq"), F.count("*").alias("_n")))
    vectors = build(distinct.select(F.col("_digest").alias("id"), "seq")).withColumnRenamed("id", "_digest")
    return attach_group(keyed.select(key, "_digest"), distinct.select("_digest", "_n"), vectors, "_digest", key).select(key, "vec")


def instability_index(df: DataFrame, weights: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """Ten over the length times the summed weight of every dipeptide.

    ``weights`` is the published table ``DF[kmer, weight]``. After the residue filter it holds 400 rows at
    most, so it is collected as one dense row that the tasks count with. A dipeptide without a weight has none.
    """
    known = weights.filter(F.col("kmer").rlike(f"^[{fv.RESIDUES}]{{2}}$")).dropDuplicates(["kmer"])
    ranked = known.select(kmer_rank(F.col("kmer"), fv.RESIDUES, 2).alias("i"), F.col("weight").alias("n"))
    row = ranked.agg(F.array_sort(F.collect_list(F.struct("i", "n"))).alias("s")).select(dense(F.col("s"), 400).alias("w")).first()
    base = _cleaned(df, key, seq, 1).withColumn("_total", kmer_scorer(DIPEPTIDE, row.w)("_q"))
    return base.select(key, F.round(F.col("_total") * 10.0 / F.col("_len"), 3).alias("Instability"))


def signature_names() -> list[str]:
    """Column names of the 1248 positions, ``DESCRIPTOR_position``."""
    return [f"{name.upper()}_{i}" for name in fv.SIGNATURE_ORDER for i in range(fv.SIGNATURE_WIDTH[name])]
