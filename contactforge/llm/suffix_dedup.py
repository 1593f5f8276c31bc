"""Exact substring deduplication: every byte goes that a repeated 50-byte string of an earlier document covers.

A full suffix array of a corpus cannot be shuffled, so the suffixes to sort are found first.

1. Documents are packed into blocks (record batches, compressed) that are written once.
2. Each window of ``LENGTH`` bytes is owned by an *anchor*: the least hash among its ``GRAM``-byte strings, the
   leftmost of equals. Equal windows have equal anchors, whatever surrounds them. The anchors' hashes go to
   partitions of bounded size, once per block; an anchor that two documents hold comes back as a bit.
3. The windows of shared anchors, as one stretch of text for each anchor, go to the partition of the anchor.
   There their suffixes are sorted: multikey quicksort with eight-byte characters to depth ``SHALLOW``; then
   blind tries order what is left, each group by the first difference from one of its members, which is all a
   trie node has to look at. Suffixes equal for ``LENGTH`` bytes form a class, and its smallest document is found.
4. The smallest documents of a stretch's windows come back to each block that sent it, as runs of windows. The
   block finds all places of the stretch in its own texts, and cuts what a smaller document has.

A block sends a stretch once, with its smallest and largest document there, and gets it back once: a group of copies
costs a partition one entry per block and distinct stretch, however many documents hold it.

Defined results: ids are integers; null ids count as larger than all others; rows with the same id do not remove
from each other; null texts are empty; an empty table gives none. Other columns are passed on; columns named as
an output are replaced. Cuts follow bytes; in ``kept_text`` what is left of a cut character is dropped.
"""
from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import staged
from .common import BATCH_BYTES, chunks, give_back, small_batches, texts_of
from .shingling import MIX, mixed

LENGTH, GRAM, SHALLOW = 50, 20, 16
#: A batch that Spark sends is one block, unless its last text is long.
BLOCK_BYTES = BATCH_BYTES + 1_000_000
PART_BYTES = 2_000_000
#: How hard blocks are compressed, which cross the network twice, and stretches, which do once.
BLOCK_LEVEL, LEVEL = 9, 3
#: Window starts that are hashed at once; a longer block is hashed in overlapping pieces.
PIECE = 1 << 18
PLACE_BITS = np.uint64(24)
LAST_ID = np.iinfo(np.int64).max


# ---- blocks ---------------------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    raw = io.BytesIO()
    for a in arrays:
        np.save(raw, a)
    return zstandard.ZstdCompressor(level=LEVEL).compress(raw.getvalue())


def unpack(data: bytes) -> list[np.ndarray]:
    raw, out = io.BytesIO(zstandard.ZstdDecompressor().decompress(data)), []
    while raw.tell() < len(raw.getbuffer()):
        out.append(np.load(raw))
    return out


def make_blocks(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch in enumerate(chunks(batches, text, BLOCK_BYTES)):
            raw = io.BytesIO()
            with pa.ipc.new_stream(raw, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", BLOCK_LEVEL))) as out:
                out.write_batch(batch)
            size = sum(len(t.encode()) for t in texts_of(batch, text))
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId() << 32 | i]), pa.array([size]), pa.array([raw.getvalue()], pa.binary()),
            ], names=["block", "size", "rows"])

    return small_batches(docs).mapInArrow(run, "block long, size long, rows binary")


def open_block(rows: bytes, key: str, text: str) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
    """The batch, all text bytes in a row, where each text starts, and the documents' ids."""
    batch = next(iter(pa.ipc.open_stream(rows)))
    raw = [t.encode() for t in texts_of(batch, text)]
    start = np.cumsum([0, *map(len, raw)])
    ids = np.array([LAST_ID if i is None else i for i in batch.column(key).to_pylist()], np.int64)
    return batch, np.frombuffer(b"".join(raw), np.uint8), start, ids


# ---- anchors --------------------------------------------------------------------------------------

def anchors(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every anchor of a block with the first and last window start that it owns."""
    found: list[tuple] = []
    for a in range(0, len(data), PIECE):
        piece = data[a : a + PIECE + LENGTH - 1]
        if len(piece) >= LENGTH:
            h, first, last = _anchors(piece)
            found.append((h, first + a, last + a))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, first, last = map(np.concatenate, zip(*found))
    # windows stay inside their document
    end = start[np.searchsorted(start, first, side="right")]
    last_end = start[np.searchsorted(start, last, side="right")]
    over = np.flatnonzero(last_end != end)  # a run over a document's end: its other part
    h = np.concatenate([h, h[over]])
    first = np.concatenate([first, start[np.searchsorted(start, last[over], side="right") - 1]])
    last = np.concatenate([last, last[over]])
    end = np.concatenate([end, last_end[over]])
    last = np.minimum(last, end - LENGTH)
    ok = last >= first
    order = np.argsort(first[ok], kind="stable")
    return h[ok][order], first[ok][order], last[ok][order]


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        one = data.astype(np.uint64) + np.uint64(1)
        power, width, by_width, factor = one, 1, {1: one}, {1: MIX}
        while width * 2 <= GRAM:
            power = power[: len(power) - width] * factor[width] + power[width:]
            factor[2 * width] = factor[width] * factor[width]
            width *= 2
            by_width[width] = power
        grams, done = by_width[width], width
        while done < GRAM:  # the rest of the gram, by smaller powers
            rest = 1 << (GRAM - done).bit_length() - 1
            tail = by_width[rest][done:]
            grams = grams[: len(tail)] * factor[rest] + tail
            done += rest
        h = mixed(grams)
    key = (h >> PLACE_BITS) << PLACE_BITS | np.arange(len(h), dtype=np.uint64)
    span, low = LENGTH - GRAM + 1, key
    width = 1
    while width * 2 <= span:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[: len(key) - span + 1], low[span - width :])
    place = (low & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    return h[place[first]], first, np.append(first[1:] - 1, len(place) - 1)


def routed(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition and, inside it, the 40-bit key of an anchor."""
    return ((h >> np.uint64(40)) % np.uint64(parts)).astype(np.int64), h & np.uint64((1 << 40) - 1)


def distinct_anchors(data, start, ids, parts):
    """Anchors of a block and their numbering by (partition, key): places, numbers, bounds of partitions, keys."""
    h, first, last = anchors(data, start)
    part, key = routed(h, parts)
    whole = part.astype(np.uint64) << np.uint64(40) | key
    named, number = np.unique(whole, return_inverse=True)
    own = ids[np.searchsorted(start, first, side="right") - 1]
    return first, last, own, named, number


def shared_in(number: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    low, high = np.full(n, LAST_ID), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, number, own)
    np.maximum.at(high, number, own)
    return low < high


def sliced(named: np.ndarray) -> list[tuple[int, int, int]]:
    """(partition, from, to) over sorted names."""
    part = (named >> np.uint64(40)).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]) if len(part) else np.zeros(1, int)
    return [(int(part[a]), int(a), int(b)) for a, b in zip(cut[:-1], cut[1:])]


def send_anchors(blocks: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column("block").to_pylist(), batch.column("rows").to_pylist()):
                _, data, start, ids = open_block(rows, key, text)
                _, _, own, named, number = distinct_anchors(data, start, ids, parts)
                twice = shared_in(number, own, len(named))
                short = named.view(np.uint8).reshape(-1, 8)[:, :5]
                out = [(p, short[a:b].tobytes(), np.packbits(twice[a:b]).tobytes()) for p, a, b in sliced(named)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int32()), pa.array([block] * len(out), pa.int64()),
                    pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary()),
                ], names=["part", "block", "keys", "twice"])
                give_back()

    return blocks.select("block", "rows").mapInArrow(run, "part int, block long, keys binary, twice binary")


def shared_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    """For one partition: which of each block's anchors are held by two documents."""
    sizes = [len(k) // 5 for k in rows["keys"]]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :5] = np.frombuffer(b"".join(rows["keys"]), np.uint8).reshape(-1, 5)
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(rows["twice"], sizes)])
    _, number, count = np.unique(wide.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
    hit = (count > 1) | (np.bincount(number, twice) > 0)
    cut = np.cumsum([0, *sizes])
    bits = [np.packbits(hit[number[a:b]]).tobytes() if hit[number[a:b]].any() else None for a, b in zip(cut[:-1], cut[1:])]
    out = pd.DataFrame({"block": rows["block"], "part": rows["part"], "bits": bits})
    return out[out["bits"].notna()]


# ---- stretches of text, sorted --------------------------------------------------------------------

def send_stretches(blocks: DataFrame, flags: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """``part, block, packed``: the distinct stretches under shared anchors, with one place and the smallest and
    largest document of each."""
    by_block = flags.groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("flags"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows, flagged in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "flags"))):
                _, data, start, ids = open_block(rows, key, text)
                first, last, own, named, number = distinct_anchors(data, start, ids, parts)
                bits, shared = {f["part"]: f["bits"] for f in flagged}, np.zeros(len(named), bool)
                for p, a, b in sliced(named):
                    if p in bits:
                        shared[a:b] = np.unpackbits(np.frombuffer(bits[p], np.uint8), count=b - a)
                hit = np.flatnonzero(shared[number])
                hit = hit[np.argsort(named[number[hit]] >> np.uint64(40), kind="stable")]
                out, raw = [], data.tobytes()
                part = (named[number[hit]] >> np.uint64(40)).astype(np.int64)
                cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]) if len(part) else np.zeros(1, int)
                for a, b in zip(cut[:-1], cut[1:]):
                    at = hit[a:b]
                    known: dict[bytes, int] = {}
                    which = [known.setdefault(raw[s:e], len(known)) for s, e in zip(first[at].tolist(), (last[at] + LENGTH).tolist())]
                    stretches = [*known]
                    place, low, high = np.zeros(len(known), np.int64), np.full(len(known), LAST_ID), np.full(len(known), np.iinfo(np.int64).min)
                    place[which] = first[at]
                    np.minimum.at(low, which, own[at])
                    np.maximum.at(high, which, own[at])
                    out.append((int(part[a]), pack(
                        np.frombuffer(b"".join(stretches), np.uint8), np.array([len(s) for s in stretches], np.int32),
                        place.astype(np.int32 if len(data) < 2**31 else np.int64), low, high,
                    )))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                    names=["part", "block", "packed"],
                )
                give_back()

    return blocks.select("block", "rows").join(by_block, "block").select("block", "rows", "flags").mapInArrow(run, "part int, block long, packed binary")


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one big-endian number (a view)."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))


def deep_shallow(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sort the ``length`` bytes from each start on; the order, and in it the flag of every first of equals."""
    order, group, words = np.arange(len(starts)), np.zeros(len(starts), np.int64), _words(text)
    for depth in range(0, min(SHALLOW, length - 7), 8):
        key = words[starts[order] + depth].astype(np.uint64)
        by = np.lexsort((key, group))
        order, key, group = order[by], key[by], group[by]
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (group[1:] != group[:-1]))]) if len(by) else group
    edge = np.ones(len(order), bool)
    edge[1:] = group[1:] != group[:-1]
    live = _in_company(edge, np.arange(len(order)))
    looks = [*range(SHALLOW, length - 7, 8), length - 8]
    while len(live):
        low = np.maximum.accumulate(np.where(edge, np.arange(len(edge)), 0))[live]
        member, node = starts[order[live]], starts[order[low]]
        depth = np.full(len(live), length)
        for at in looks:
            open_ = np.flatnonzero(depth == length)
            differ = words[member[open_] + at].astype(np.uint64) ^ words[node[open_] + at].astype(np.uint64)
            some = differ != 0
            x = differ[some]
            lead = sum((x < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
            depth[open_[some]] = at + lead
        apart = depth < length
        byte = np.where(apart, text[member + np.minimum(depth, length - 1)], 0).astype(np.int64)
        side = np.where(apart, np.sign(byte - text[node + np.minimum(depth, length - 1)]), 0)
        turn = np.where(side < 0, depth, -depth)  # below the node an early branch is smaller, above it larger
        by = np.lexsort((byte, turn, side, low))
        order[live] = order[live][by]
        low, side, turn, byte = low[by], side[by], turn[by], byte[by]
        edge[live[1:]] |= (low[1:] != low[:-1]) | (side[1:] != side[:-1]) | (turn[1:] != turn[:-1]) | (byte[1:] != byte[:-1])
        live = _in_company(edge, live[side != 0])
    return order, edge


def _in_company(edge: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The slots of groups with two members or more."""
    alone = edge & np.append(edge[1:], True) if len(edge) else edge
    return slots[~alone[slots]]


def _named(text: np.ndarray, sizes: np.ndarray, known: dict[bytes, int]) -> np.ndarray:
    """Number of every stretch among all that are known; new ones are added."""
    raw, end = text.tobytes(), np.cumsum(sizes).tolist()
    return np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip([0, *end], end)], np.int64)


def repeated_windows(rows: pd.DataFrame) -> pd.DataFrame:
    """For one partition: per block the runs of windows of its stretches that have an earlier document."""
    packed = [unpack(p) for p in rows["packed"]]
    # blocks that send the same stretch share its suffixes
    known: dict[bytes, int] = {}
    which = np.concatenate([_named(p[0], p[1], known) for p in packed])
    sizes = np.fromiter(map(len, known), np.int64, len(known))
    place, low, high = (np.concatenate([p[k] for p in packed]).astype(np.int64) for k in (2, 3, 4))
    text = np.frombuffer(b"".join(known) + bytes(8), np.uint8)
    windows = sizes - LENGTH + 1
    from_ = np.cumsum(windows) - windows
    holder = np.repeat(np.arange(len(sizes)), windows)
    starts = (np.cumsum(sizes) - sizes)[holder] + np.arange(len(holder)) - from_[holder]
    earliest = np.full(len(sizes), LAST_ID)
    np.minimum.at(earliest, which, low)
    order, edge = deep_shallow(text, starts)
    of_class = np.minimum.reduceat(earliest[holder[order]], np.flatnonzero(edge))
    least = np.empty(len(order), np.int64)
    least[order] = of_class[np.cumsum(edge) - 1]
    # runs of a stretch's windows with the same earliest document
    run = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (holder[1:] != holder[:-1])))
    count, begin, least = np.diff(np.append(run, len(least))), run - from_[holder[run]], least[run]
    # back to every block that sent the stretch and has a later document with it
    sent, at = _spread(np.bincount(holder[run], minlength=len(sizes)), which)
    keep = np.flatnonzero(least[at] < high[sent])
    sent, at = sent[keep], at[keep]
    cut = np.searchsorted(sent, np.cumsum([0, *(len(p[1]) for p in packed)]))
    found = (place[sent], sizes[which[sent]], begin[at], count[at], least[at])
    out = [(block, pack(*(x[a:b] for x in found))) for block, a, b in zip(rows["block"], cut[:-1], cut[1:]) if b > a]
    give_back()
    return pd.DataFrame(out, columns=["block", "spans"])


def _spread(runs: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries that name one of several lists of runs, laid end to end: every entry with each of its runs."""
    n = runs[which]
    entry = np.repeat(np.arange(len(which)), n)
    return entry, (np.cumsum(runs) - runs)[which][entry] + np.arange(len(entry)) - (np.cumsum(n) - n)[entry]


# ---- cutting --------------------------------------------------------------------------------------

def covered(data: np.ndarray, start: np.ndarray, ids: np.ndarray, spans: list[bytes]) -> np.ndarray:
    """Which bytes of a block repeat an earlier document, wherever in the block the returned stretches stand."""
    if not spans:
        return np.zeros(len(data), bool)
    place, size, begin, count, least = map(np.concatenate, zip(*map(unpack, spans)))
    raw, known = data.tobytes(), {}
    number = np.array([known.setdefault(raw[p : p + n], len(known)) for p, n in zip(place.tolist(), size.tolist())])
    order = np.argsort(number, kind="stable")
    _, first, last = anchors(data, start)
    which = np.array([known.get(raw[s:e], -1) for s, e in zip(first.tolist(), (last + LENGTH).tolist())])
    first, which = first[which >= 0], which[which >= 0]
    own = ids[np.searchsorted(start, first, side="right") - 1]
    entry, at = _spread(np.bincount(number), which)
    at = order[at]
    earlier = np.flatnonzero(least[at] < own[entry])
    entry, at = entry[earlier], at[earlier]
    opened = first[entry] + begin[at]
    change = np.bincount(opened, minlength=len(data) + 1) - np.bincount(opened + count[at] + LENGTH - 1, minlength=len(data) + 1)
    return np.cumsum(change)[:-1] > 0


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", as_text: bool = False) -> DataFrame:
    """The rows with ``n_bytes, n_removed, n_spans, kept`` (bytes) and, if wished, ``kept_text``."""
    extra = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept", T.BinaryType())]
    extra += [T.StructField("kept_text", T.StringType())] * as_text
    source = docs.drop(*[f.name for f in extra])
    schema = T.StructType(source.schema.fields + extra)
    blocks = staged(make_blocks(source, text))
    total = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(8, -(-total // PART_BYTES))
    flags = send_anchors(blocks, key, text, parts).groupBy("part").applyInPandas(shared_anchors, "block long, part int, bits binary")
    stretches = send_stretches(blocks, flags, key, text, parts)
    spans = stretches.groupBy("part").applyInPandas(repeated_windows, "block long, spans binary")
    by_block = spans.groupBy("block").agg(F.collect_list("spans").alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, spans in zip(batch.column("rows").to_pylist(), batch.column("spans").to_pylist()):
                own, data, start, ids = open_block(rows, key, text)
                gone = covered(data, start, ids, spans)
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                opens[start[:-1][start[:-1] < len(data)]] = gone[start[:-1][start[:-1] < len(data)]]
                removed, runs = (np.concatenate([[0], np.cumsum(x)])[start] for x in (gone, opens))
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(start[:-1], start[1:])]
                columns = [pa.array(np.diff(start)), pa.array(np.diff(removed)), pa.array(np.diff(runs)), pa.array(kept, pa.binary())]
                if as_text:
                    columns.append(pa.array([k.decode("utf-8", "ignore") for k in kept]))
                yield pa.RecordBatch.from_arrays([*own.columns, *columns], names=schema.names)
                give_back()

    return blocks.select("block", "rows").join(by_block, "block", "left").select("rows", "spans").mapInArrow(cut, schema)
