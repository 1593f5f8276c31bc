"""Alignment of two tokenizers over a corpus, with pair counts by external spill counting.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece file that writes a space before
every text. Both see space + text. Byte offsets where a token of A and one of B both end cut the tokens into groups;
the two tokens that end there are linked.

*Aligning.* Texts are cut where a space follows something that is no white space: no pre-token of A and no piece of B
crosses such a place, so a unit's ids, links and group text are worked out once, for all new units of a batch
together, and looked up afterwards. For the same reason A is given many units as one text.

*Counting.* Each task turns its documents into records (pair, document, times), ordered by B id, then A id (side-major)
and radix-partitioned by the B id. About ``RUN_RECORDS`` records make a run; for each radix it is one row of zstd frames,
written to the shared folder beside the documents' rows. Only the pairs of a run and their totals are shuffled, by radix,
so a pair costs its partition one entry a run, however many documents hold it. There the runs are merged from a heap:
equal pairs are next to each other, so their counts add up, and when the last pair of a B id has gone by, its highest
count is known and every run of that B id gets counts and flags back in its own order. With them a run adds up what its
documents are owed. No document list leaves its run, and a group is a run or the headers of one radix.

Defined results: null and empty texts have no tokens, nor do texts that a tokenizer does not give back byte for byte
(U+2581 inside a text, say): all numbers are 0 and the group text is empty. Control strings inside texts are ordinary
text. Repeated rows count each. An empty table gives none. Other columns are passed on; columns named as an output are
replaced. Vocabularies that the cut would change raise an error.
"""
from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import staged
from .byte_bpe import byte_characters
from .common import chunks, small_batches, texts_of

#: Records after which a run is written, and documents: a run's arrays are what a task holds.
RUN_RECORDS = 2_000_000
RUN_DOCS = 200_000
#: Bytes of units and group texts that a worker keeps; it starts anew beyond them.
STORE_BYTES = 96_000_000
#: Units that tokenizer A is given as one text.
JOINED = 1024
#: A pair is one number, the B id above the A id.
A_BITS = 24
#: The radix is taken from the B id; its range follows the session's shuffle partitions between these bounds.
RADIX_LEAST, RADIX_MOST = 64, 4096
BLOCK = 4096
GAP = "▁"
UNIT = re.compile(r" *[^ ]+(?:(?<=\s) +[^ ]+)*| +")
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as file:
            plan = json.load(file)
        cut = plan.get("pre_tokenizer") or {}
        if plan.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("use_regex") is False or cut.get("add_prefix_space"):
            raise ValueError(f"{path_a}: only byte-level BPE with the usual pre-token pattern and no normalizer can be cut into units")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = m = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: bytes([i]) for i, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = b"".join(byte_of.get(c, c.encode()) for c in token)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if any(GAP in p.lstrip(GAP) for p in pieces):
            raise ValueError(f"{path_b}: has pieces with a space after other characters; texts cannot be cut into units")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(GAP, " ").encode() for i, p in enumerate(pieces)]
        self.space = m.encode("x ")[len(m.encode("x")) :]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << A_BITS:
            raise ValueError("a vocabulary is too large")
        self.size_a, self.size_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # an id as it is written inside and at the end of a group's side: those of A, then those of B
        self.names = [f"{i}{after}" for side, last in ((self.bytes_a, "|"), (self.bytes_b, ";")) for i in range(len(side)) for after in (",", last)]
        self.names_b, self.name_size = 2 * len(self.bytes_a), np.array(list(map(len, self.names)), np.int64)

    def encode_a(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]

    def flat_a(self, units: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after the other, and how many each has.

        A unit that does not end in white space may be followed by the next one, since both start where texts are cut: such units
        are encoded as one text, and the bytes of the tokens tell them apart. Where they do not, units are encoded by themselves.
        """
        texts, part = [], []
        for unit in units:
            part.append(unit)
            if unit[-1].isspace() or len(part) == JOINED:
                texts.append("".join(part))
                part = []
        if part:
            texts.append("".join(part))
        ids = _flat(self.encode_a(texts))
        unit_end, end = np.cumsum([len(r) for r in raw]), np.cumsum(self.size_a[ids])
        upto = np.searchsorted(end, unit_end, "right")
        if len(end) and end[-1] == unit_end[-1] and (end[upto - 1] == unit_end).all():
            return ids, np.diff(upto, prepend=0)
        lists = self.encode_a(units)
        return _flat(lists), np.array(list(map(len, lists)), np.int64)

    def encode_b(self, units: list[str]) -> list[list[int]]:
        """Every unit starts with a space, which this tokenizer puts there itself, unless nothing follows it."""
        return [ids if u != " " else self.space for u, ids in zip(units, self.b.encode([u[1:] for u in units], num_threads=1))]


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _faithful(ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray, table: list[bytes], raw: list[bytes], whole: bytes) -> np.ndarray:
    """Whether the tokens of a unit are its bytes, for every unit."""
    found, upto = b"".join(map(table.__getitem__, ids.tolist())), np.cumsum(counts)
    ends = np.concatenate([[0], np.cumsum(sizes[ids])])[upto]
    if found == whole and np.array_equal(ends, np.cumsum([len(r) for r in raw])):
        return np.ones(len(raw), bool)
    return np.array([found[a:b] == r for a, b, r in zip([0, *ends.tolist()], ends.tolist(), raw)], bool)


class UnitStore:
    """What was worked out for the units seen so far: a worker's memory between batches."""

    def __init__(self, tools: Tokenizers):
        self.tools = tools
        self.empty()

    def empty(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.held = 0
        self.numbers = np.zeros((0, 3), np.int64)  # tokens of A, of B, links
        self.good = np.zeros(0, bool)
        self.first = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def learn(self, units: list[str]) -> None:
        if self.held > STORE_BYTES:
            self.empty()
        new = [u for u in dict.fromkeys(units) if u not in self.place]
        if not new:
            return
        tools, raw = self.tools, [u.encode() for u in new]
        whole, b = b"".join(raw), tools.encode_b(new)
        (ids_a, n_a), (ids_b, n_b) = tools.flat_a(new, raw), (_flat(b), np.array(list(map(len, b)), np.int64))
        good = _faithful(ids_a, n_a, tools.size_a, tools.bytes_a, raw, whole) & _faithful(ids_b, n_b, tools.size_b, tools.bytes_b, raw, whole)
        sizes = np.array([len(r) for r in raw], np.int64)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b, sizes = n_a * good, n_b * good, sizes * good
        end_a, end_b, unit_end = np.cumsum(tools.size_a[ids_a]), np.cumsum(tools.size_b[ids_b]), np.cumsum(sizes)
        # the last token of each side that ends at a byte
        last_a, last_b = (np.full(int(unit_end[-1]) + 1, -1) for _ in range(2))
        last_a[end_a], last_b[end_b] = np.arange(len(end_a)), np.arange(len(end_b))
        both = np.flatnonzero((last_a >= 0) & (last_b >= 0))
        at_a, at_b = last_a[both], last_b[both]
        upto = np.searchsorted(both, unit_end, "right")
        n_links = np.diff(upto, prepend=0)
        # every token is written once: those of B stand behind the tokens of A of their group, those of A behind the groups before
        group_a = np.diff(at_a, prepend=-1)
        group_b = np.diff(at_b, prepend=-1)
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        follow_a, follow_b = ids_a * 2, ids_b * 2 + tools.names_b
        follow_a[at_a] += 1
        follow_b[at_b] += 1
        written[np.arange(len(ids_a)) + np.repeat(at_b + 1 - group_b, group_a)] = follow_a
        written[np.arange(len(ids_b)) + np.repeat(at_a + 1, group_b)] = follow_b
        text = "".join(map(tools.names.__getitem__, written.tolist()))
        ends = np.concatenate([[0], np.cumsum(tools.name_size[written])])[np.cumsum(n_a + n_b)].tolist()
        # a separator ends every unit's text but that of one without tokens
        self.groups += [text[i : j - 1] if j > i else "" for i, j in zip([0, *ends], ends)]
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.first = np.concatenate([self.first, len(self.links) + upto - n_links])
        self.links = np.concatenate([self.links, ids_b[at_b] << A_BITS | ids_a[at_a]])
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, n_links], 1)])
        self.good = np.concatenate([self.good, good])
        self.held += 3 * len(whole) + len(text) + 250 * len(new)

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Numbers and group text of every text; the links of all of them and the text each belongs to."""
        cut = [UNIT.findall(" " + t) if t else [] for t in texts]
        n_units = np.array([len(x) for x in cut], np.int64)
        units = list(chain.from_iterable(cut))
        self.learn(units)
        places = list(map(self.place.__getitem__, units))
        flat, upto = np.array(places, np.int64), np.cumsum(n_units).tolist()
        owner = np.repeat(np.arange(len(texts)), n_units)
        whole = np.bincount(owner[~self.good[flat]], minlength=len(texts)) == 0
        keep = whole[owner]
        flat, owner = flat[keep], owner[keep]
        numbers = np.stack([np.bincount(owner, self.numbers[flat, k], len(texts)).astype(np.int64) for k in range(3)], 1).reshape(-1, 3)
        groups = [";".join(map(self.groups.__getitem__, places[i:j])) if ok else "" for i, j, ok in zip([0, *upto], upto, whole.tolist())]
        count = self.numbers[flat, 2]
        start = np.repeat(self.first[flat] - (np.cumsum(count) - count), count)
        return numbers, groups, self.links[start + np.arange(count.sum())], np.repeat(owner, count)


def packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values, kind).tobytes())


def unpacked(frame: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), kind)


class Run:
    """Records of one run while it grows; ``rows`` gives it as one row a radix."""

    def __init__(self, chunk: int, radixes: int):
        self.chunk, self.radixes, self.docs, self.held = chunk, radixes, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, n_docs: int, links: np.ndarray, owner: np.ndarray) -> None:
        """One record for each pair of a document."""
        order = np.lexsort((links, owner))
        links, owner = links[order], owner[order]
        new = np.flatnonzero(np.concatenate([[True], (links[1:] != links[:-1]) | (owner[1:] != owner[:-1])])) if len(links) else np.zeros(0, np.int64)
        self.parts.append((links[new], (owner[new] + self.docs).astype(np.int32), np.diff(new, append=len(links)).astype(np.int32)))
        self.docs += n_docs
        self.held += len(new)

    def rows(self) -> list[dict]:
        pair, doc, times = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        radix = (pair >> A_BITS) % self.radixes
        order = np.lexsort((doc, pair, radix))
        pair, doc, times, radix = pair[order], doc[order], times[order], radix[order]
        cut = np.searchsorted(radix, np.arange(self.radixes + 1))
        out = []
        for r in range(self.radixes):
            a, b = cut[r], cut[r + 1]
            if a == b:
                continue
            own, n = pair[a:b], times[a:b]
            new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            out.append({
                "chunk": self.chunk, "radix": r,
                "pairs": packed(np.diff(own[new], prepend=0), "<i8"), "totals": packed(np.add.reduceat(n.astype(np.int64), new), "<i8"),
                "lengths": packed(np.diff(new, append=b - a), "<i4"), "docs": packed(np.diff(doc[a:b], prepend=0), "<i4"), "times": packed(n, "<i4"),
            })
        return out


RUN_COLUMNS = [("chunk", T.LongType()), ("radix", T.IntegerType())] + [(c, T.BinaryType()) for c in ("pairs", "totals", "lengths", "docs", "times")]


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """A row (struct ``doc``, numbers, ``groups``, ``chunk``, ``place``) for each document, and the rows of the runs."""
    kept = [c for c in docs.columns if c != text and c not in [*NUMBERS, "groups", "n_best", "count_sum"]]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")]).alias("doc"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc", source.schema["doc"].dataType), *[T.StructField(c, T.LongType()) for c in NUMBERS], T.StructField("groups", T.StringType()), T.StructField("place", T.IntegerType()), *[T.StructField(*c) for c in RUN_COLUMNS]])
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    radixes = min(RADIX_MOST, max(RADIX_LEAST, 1 << (partitions - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, task, doc_type = UnitStore(tokenizers_of(path_a, path_b)), TaskContext.get().partitionId(), None
        number = 0
        open_run = Run(task << 32, radixes)

        def shaped(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            kinds = {"doc": doc_type, **dict.fromkeys(NUMBERS, pa.int64()), "groups": pa.string(), "place": pa.int32(), "chunk": pa.int64(), "radix": pa.int32(), **dict.fromkeys(("pairs", "totals", "lengths", "docs", "times"), pa.binary())}
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kind)) for c, kind in kinds.items()], names=list(kinds))

        def closed() -> Iterator[pa.RecordBatch]:
            for row in open_run.rows():
                yield shaped(1, {c: pa.array([v], pa.int64() if c == "chunk" else pa.int32() if c == "radix" else pa.binary()) for c, v in row.items()})

        for batch in chunks(batches, "text"):
            doc_type = batch.schema.field("doc").type
            numbers, groups, links, owner = store.align(texts_of(batch, "text"))
            n = batch.num_rows
            values = [numbers[:, 0], numbers[:, 1], numbers[:, 2], numbers[:, 2]]
            yield shaped(n, {
                "doc": batch.column("doc"), **{c: pa.array(v, pa.int64()) for c, v in zip(NUMBERS, values)}, "groups": pa.array(groups, pa.string()),
                "place": pa.array(np.arange(open_run.docs, open_run.docs + n), pa.int32()), "chunk": pa.array([open_run.chunk] * n, pa.int64()),
            })
            open_run.add(n, links, owner)
            if open_run.held >= RUN_RECORDS or open_run.docs >= RUN_DOCS:
                yield from closed()
                number += 1
                open_run = Run(task << 32 | number, radixes)
        if open_run.parts:
            yield from closed()

    return small_batches(source).mapInArrow(run, schema)


def entries(run: int, pairs: np.ndarray, totals: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for at in range(0, len(pairs), BLOCK):
        yield from zip(pairs[at : at + BLOCK].tolist(), repeat(run), totals[at : at + BLOCK].tolist())


def merged_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[array, bytearray]]:
    """Corpus-wide counts of the pairs of sorted runs and whether a count is its B id's highest, for each run in its order."""
    back = [(array("q"), bytearray()) for _ in runs]
    stream = heapq.merge(*(entries(i, *r) for i, r in enumerate(runs)))
    for _, side in groupby(stream, key=lambda x: x[0] >> A_BITS):
        counted = []
        for _, same in groupby(side, key=itemgetter(0)):
            holders = list(same)
            counted.append((sum(h[2] for h in holders), holders))
        top = max(c for c, _ in counted)
        for count, holders in counted:
            for _, run, _ in holders:
                counts, best = back[run]
                counts.append(count)
                best.append(count == top)
    return back


def _merge(table: pa.Table) -> pa.Table:
    runs = [(np.cumsum(unpacked(p, "<i8")), unpacked(t, "<i8")) for p, t in zip(table["pairs"].to_pylist(), table["totals"].to_pylist())]
    back = merged_runs(runs)
    return pa.table({
        "chunk": table["chunk"].cast(pa.int64()), "radix": table["radix"].cast(pa.int32()),
        "counts": pa.array([packed(np.frombuffer(c, np.int64), "<i8") for c, _ in back], pa.binary()),
        "best": pa.array([packed(np.frombuffer(bytes(b), np.uint8), "u1") for _, b in back], pa.binary()),
    })


def _owed(lists: pa.Table, counts: pa.Table) -> pa.Table:
    """What the documents of one run get: the sum of the counts of their links, and how many links are their B id's best."""
    found = {r["radix"]: r for r in counts.to_pylist()}
    total = best = np.zeros(0, np.int64)
    chunk = lists["chunk"][0].as_py()
    for row in lists.to_pylist():
        mine, lengths = found[row["radix"]], unpacked(row["lengths"], "<i4")
        doc, times = np.cumsum(unpacked(row["docs"], "<i4")), unpacked(row["times"], "<i4").astype(np.int64)
        need = int(doc.max()) + 1
        if need > len(total):
            total, best = (np.concatenate([x, np.zeros(need - len(x), np.int64)]) for x in (total, best))
        np.add.at(total, doc, np.repeat(unpacked(mine["counts"], "<i8"), lengths) * times)
        np.add.at(best, doc, np.repeat(unpacked(mine["best"], "u1"), lengths) * times)
    place = np.flatnonzero(total)
    return pa.table({"chunk": pa.array([chunk] * len(place), pa.int64()), "place": pa.array(place, pa.int32()), "count_sum": pa.array(total[place], pa.int64()), "n_best": pa.array(best[place], pa.int64())})


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", show: dict[str, Column] | None = None) -> DataFrame:
    """The documents' columns without ``text``, ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and the group text.

    ``show`` names columns made from ``groups``, which are then kept in its place.
    """
    shown = {"groups": F.col("groups")} if show is None else show
    rows = staged(aligned(docs, path_a, path_b, text).withColumns(shown).select("doc", *NUMBERS, *shown, "place", *[c for c, _ in RUN_COLUMNS]))
    runs = rows.filter(F.col("radix").isNotNull())
    counts = runs.select("chunk", "radix", "pairs", "totals").groupBy("radix").applyInArrow(_merge, "chunk long, radix int, counts binary, best binary")
    lists = runs.select("chunk", "radix", "lengths", "docs", "times")
    owed = lists.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_owed, "chunk long, place int, count_sum long, n_best long")
    own = rows.filter(F.col("radix").isNull()).join(owed, ["chunk", "place"], "left")
    names = [c for c in rows.schema["doc"].dataType.names if c != "none" or c in docs.columns]
    return own.select(
        *[F.col("doc").getField(c).alias(c) for c in names if c not in shown], *NUMBERS,
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"), F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), *shown,
    )
