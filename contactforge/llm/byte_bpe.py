"""Byte-level BPE: encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary is a rank file (base64 token, rank). Bytes are written as printable characters (the usual
byte-level table), and the merge list is derived from the ranks: a token's two parts are what the lower ranks
make of it. Texts are cut at white space into units that the pre-token pattern never crosses; a unit that was
seen before is looked up, the others go through the library as one batch.

Defined results: null and empty texts have no ids; ids are packed as little-endian unsigned 32-bit integers;
offsets are the code points at which a token starts and ends (the character that holds its first byte, and the
end of the one that holds its last), so tokens that share a split character overlap there. Decoding gives
the exact bytes and a text in which bytes that are no UTF-8 (a cut inside a character) become U+FFFD. Special
tokens are ordinary text. Repeated rows are encoded each; an empty table gives none. Other columns are passed
on; columns named as an output are replaced.
"""
from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import chunks, small_batches, texts_of

#: Bytes of units and their ids that a worker keeps in each of two generations; a full one takes the place of the older one.
STORE_BYTES = 64_000_000
#: Bytes that a unit costs besides its text and ids.
UNIT_COST = 220
#: White space of Unicode, as the pre-token pattern has it.
SPACE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_characters() -> list[str]:
    """The printable character of every byte: itself where it is visible Latin-1, else the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def parts_of(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The two pieces that the ranks below the token's own leave of it."""
    pieces, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(pieces) > 2:
        found = [(ranks.get(pieces[i] + pieces[i + 1], own), i) for i in range(len(pieces) - 1)]
        rank, i = min(found)
        if rank >= own:
            raise ValueError(f"rank {own} cannot be built from lower ranks")
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
    return pieces


class Codec:
    """Encoder and decoder for one rank file; one for each Python worker."""

    def __init__(self, path: str, pattern: str):
        chars = byte_characters()
        self.ranks, self.pattern, self.known, self.older, self.held = read_ranks(path), pattern, {}, {}, 0
        self.written = {token: "".join(chars[b] for b in token) for token in self.ranks}
        byte_of = {c: b for b, c in enumerate(chars)}
        self.bytes_of = {self.ranks[t]: bytes(byte_of[c] for c in w) for t, w in self.written.items()}

    @cached_property
    def library(self):
        """The encoder; a worker that only decodes does without."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        merges = [tuple(self.written[p] for p in parts_of(t, self.ranks)) for t in sorted(self.ranks, key=self.ranks.get) if len(t) > 1]
        tool = Tokenizer(models.BPE(vocab={self.written[t]: r for t, r in self.ranks.items()}, merges=merges))
        tool.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(self.pattern), behavior="isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        return tool

    def encode(self, texts: list[str]) -> list[bytes]:
        units = [UNIT.findall(t) for t in texts]
        known, older, used = self.known, self.older, set().union(*units)
        missing = used - known.keys()
        again = missing & older.keys()
        new = list(missing - again)
        known.update((u, older[u]) for u in again)
        known.update((u, np.asarray(code.ids, "<u4").tobytes()) for u, code in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)))
        out = [b"".join(map(known.__getitem__, u)) for u in units]
        self.held += sum(UNIT_COST + 2 * len(u) + len(known[u]) for u in missing)
        if self.held > STORE_BYTES:
            self.known, self.older, self.held = {}, known, 0
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and end code point of every token."""
        tokens = [self.bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()]
        at = np.cumsum([0, *map(len, tokens)])
        char = np.cumsum((np.frombuffer(b"".join(tokens), np.uint8) & 0xC0) != 0x80) - 1
        return (char[at[:-1]], char[at[1:] - 1] + 1) if tokens else (np.zeros(0, int), np.zeros(0, int))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _extended(df: DataFrame, extra: list[tuple[str, T.DataType]]) -> tuple[DataFrame, T.StructType]:
    kept = df.drop(*[name for name, _ in extra])
    return kept, T.StructType(kept.schema.fields + [T.StructField(*x) for x in extra])


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False, keep_text: bool = False, decoded: bool = False, decoded_text: bool = False,
) -> DataFrame:
    """Adds ``ids`` (packed), ``n_tokens`` and, if wished, ``starts`` and ``ends``; takes the text away.

    ``decoded`` and ``decoded_text`` add what ``decode`` makes of the ids, without another pass.
    """
    extra = [("ids", T.BinaryType()), ("n_tokens", T.LongType())]
    if offsets:
        extra += [("starts", T.ArrayType(T.LongType())), ("ends", T.ArrayType(T.LongType()))]
    extra += [("decoded", T.BinaryType())] * decoded + [("decoded_text", T.StringType())] * decoded_text
    source, schema = _extended(docs, extra)
    schema = schema if keep_text else T.StructType([f for f in schema if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in chunks(batches, text):
            ids = tool.encode(texts_of(batch, text))
            out = {"ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            if offsets:
                places = [tool.offsets(x) for x in ids]
                out |= {n: pa.array([p[k] for p in places], pa.list_(pa.int64())) for k, n in enumerate(("starts", "ends"))}
            if decoded or decoded_text:
                raw = [tool.decode(x) for x in ids]
                out |= {"decoded": pa.array(raw, pa.binary())} if decoded else {}
                out |= {"decoded_text": pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())} if decoded_text else {}
            yield _with(batch if keep_text else batch.drop_columns([text]), out)

    return small_batches(source).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", text: bool = False) -> DataFrame:
    """Adds ``decoded`` (bytes) and, if wished, ``decoded_text`` with U+FFFD where a character is cut."""
    source, schema = _extended(encoded, [("decoded", T.BinaryType())] + [("decoded_text", T.StringType())] * text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in chunks(batches, ids):
            raw = [tool.decode(x or b"") for x in batch.column(ids).to_pylist()]
            out = {"decoded": pa.array(raw, pa.binary())}
            if text:
                out["decoded_text"] = pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())
            yield _with(batch, out)

    return small_batches(source).mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
