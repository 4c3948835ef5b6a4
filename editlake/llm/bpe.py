"""Byte-level BPE encoding and decoding through a sentencepiece model made from the rank file.

The model is serialised by hand, straight from the vocabulary: a piece is the token's bytes, each
byte shown as one printable character; its score is the negative rank, so that the best merge is the
one of lowest rank; normalisation is the identity. Pre-tokens are encoded one by one, ids are
decoded by the inverse mapping of their pieces.

Null text counts as empty: no ids. Nothing is shuffled; a row never meets another row.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame

from .util import chunks, id_and_text

#: Bytes of text whose different parts are encoded together. Workers outlive a stage and keep the memory of their largest chunk.
CHUNK = 1 << 20
#: Different parts, without a mark at their end, that a worker remembers from one chunk to the next.
KNOWN = 100_000
MARKS = ",."


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto of type BPE in which a piece's id is its rank; the last piece is the unknown one."""
    chars = byte_characters()
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    pieces = [
        _field(1, _field(1, "".join(chars[b] for b in token).encode()) + b"\x15" + struct.pack("<f", -rank))
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + b"\x18\x02"))
    trainer = b"\x18\x02" + b"\x20" + _varint(len(pieces)) + b"\xc0\x02" + _varint(len(tokens))
    normalizer = _field(1, b"identity") + b"\x18\x00\x20\x00\x28\x00"
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def split_by_bytes(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of ``ids`` (of so many bytes each) make up each part, from where the parts end in bytes."""
    return np.diff(np.searchsorted(np.cumsum(sizes), ends, side="right"), prepend=0)


def joined_text(strings: pa.Array) -> str:
    """All strings (large_string, no nulls) in a row."""
    if not len(strings):
        return ""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)
    a, b = offsets[strings.offset], offsets[strings.offset + len(strings)]
    return bytes(memoryview(strings.buffers()[2])[a:b]).decode()


class PieceEncoder:
    """Encodes texts cut at single spaces and line feeds between other characters, each different part once.

    A pre-token never runs over such a character and one always begins there, so the parts of a text are
    independent. Texts in which one touches other white space are encoded without cutting.
    ``whole`` gives the ids of each of some strings; ``parts`` those of an Arrow array of parts (each begins with
    its space or line feed), as ids in a row and numbers of ids.
    """

    def __init__(
        self,
        whole: Callable[[list[str]], list[np.ndarray]],
        parts: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
        kind: str,
    ):
        self.whole, self.parts, self.kind = whole, parts, kind
        self.marks = np.concatenate(whole(list(MARKS)))
        if len(self.marks) != len(MARKS):
            raise ValueError("a mark is not one id")
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.values, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _stems(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``values`` the ids of different stems begin and how many they are; new ones are encoded and kept."""
        if len(self.known) > KNOWN:
            self._forget()
        new = stems.filter(pc.is_null(pc.index_in(stems, value_set=self.known)))
        blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        begun = pc.if_else(pc.starts_with(new, "\n"), new, pc.binary_join_element_wise(nothing, new, blank))
        ids, counts = self.parts(begun)
        self.known = pa.concat_arrays([self.known, new])
        self.values, self.sizes = np.concatenate([self.values, ids]), np.concatenate([self.sizes, counts])
        at = pc.index_in(stems, value_set=self.known).to_numpy()
        return (np.cumsum(self.sizes) - self.sizes)[at], self.sizes[at]

    def _different(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and numbers of ids of different parts. A mark after a letter at a part's end is a pre-token of its
        own, so only what stands before it is encoded."""
        ends = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
        data = np.frombuffer(parts.buffers()[2], np.uint8) if len(parts) else np.zeros(0, np.uint8)
        marked = np.diff(ends) > 1
        last, before = data[np.maximum(ends[1:] - 1, 0)], data[np.maximum(ends[1:] - 2, 0)] | 32
        mark = np.full(len(parts), -1)
        for k, m in enumerate(MARKS):
            mark[marked & (last == ord(m)) & (before >= 97) & (before <= 122)] = k
        cut = pc.if_else(pa.array(mark >= 0), pc.utf8_slice_codeunits(parts, 0, -1), parts)
        coded = cut.dictionary_encode()
        starts, sizes = self._stems(coded.dictionary)
        at = coded.indices.to_numpy()
        begin, lengths = np.empty((len(parts), 2), np.int64), np.empty((len(parts), 2), np.int64)
        begin[:, 0], lengths[:, 0] = starts[at], sizes[at]
        begin[:, 1], lengths[:, 1] = len(self.values) + mark, mark >= 0
        return gather(np.concatenate([self.values, self.marks]), begin.ravel(), lengths.ravel()), lengths.sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (large_string, no nulls) in a row, and how many each text has."""
        # A part keeps its line feed and loses its space; a space before a line feed leaves an empty part.
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets, flat = cut.offsets.to_numpy().astype(np.int64), cut.values
        head = np.zeros(len(flat), bool)
        head[offsets[:-1]] = True
        coded = flat.filter(pa.array(~head)).dictionary_encode()
        at, different = coded.indices.to_numpy(), coded.dictionary
        inner = pc.if_else(pc.starts_with(different, "\n"), pc.utf8_slice_codeunits(different, 1), different)
        fine = np.asarray(pc.equal(pc.utf8_trim_whitespace(inner), inner)) & (np.asarray(pc.binary_length(inner)) > 0)
        ids, counts = self._different(different.filter(pa.array(fine)))
        sizes = np.zeros(len(different), np.int64)
        sizes[fine] = counts
        starts = np.cumsum(sizes) - sizes
        heads = flat.take(pa.array(offsets[:-1])).to_pylist()
        owner = np.repeat(np.arange(len(heads)), np.diff(offsets) - 1)
        odd = np.bincount(owner, ~fine[at], minlength=len(heads)) > 0
        for k in np.flatnonzero(np.diff(offsets) > 1).tolist():
            odd[k] |= heads[k][-1:].isspace()
        for k in np.flatnonzero(odd).tolist():
            heads[k] = texts[k].as_py()
        first = self.whole(heads)
        own = np.fromiter(map(len, first), np.int64, len(first))
        values = np.concatenate([*first, ids]).astype(self.kind)
        lengths, begin = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
        lengths[head], begin[head] = own, np.cumsum(own) - own
        lengths[~head], begin[~head] = np.where(odd[owner], 0, sizes[at]), own.sum() + starts[at]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        return gather(values, begin, lengths), np.diff(sums[offsets])


class ByteBPE:
    """Encoder and decoder over the serialised model; ``pattern`` splits a text into pre-tokens."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.findall = regex.compile(pattern).findall
        chars = byte_characters()
        self.shown = str.maketrans({b: chars[b] for b in range(256)})
        self.shown_apart = {k: v for k, v in self.shown.items() if k != 10}
        back = {c: b for b, c in enumerate(chars)}
        n = self.sp.get_piece_size() - 1
        self.bytes_of = [bytes(map(back.__getitem__, self.sp.id_to_piece(k))) for k in range(n)]
        self.sizes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.rank = {t: k for k, t in enumerate(self.bytes_of)}
        self.encoder = PieceEncoder(lambda texts: [self._tokens(self.findall(t)) for t in texts], self._parts, "<u4")

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self._tokens(self.findall(joined_text(parts)))
        ends = np.cumsum(np.asarray(pc.binary_length(parts)).astype(np.int64))
        return ids, split_by_bytes(ids, self.sizes[ids], ends)

    def _tokens(self, tokens: list[str]) -> np.ndarray:
        """Ids of pre-tokens in a row; a pre-token that is in the vocabulary is one id."""
        coded = pa.array(tokens, pa.large_string()).dictionary_encode()
        different = [t.encode() for t in coded.dictionary.to_pylist()]
        ranks = [self.rank.get(t, -1) for t in different]
        hard = [k for k, r in enumerate(ranks) if r < 0]
        merged = self._merged([different[k] for k in hard])
        values = np.concatenate([np.array(ranks, np.int64), merged[0]])
        sizes, starts = np.ones(len(different), np.int64), np.arange(len(different))
        sizes[hard] = merged[1]
        starts[hard] = len(different) + np.cumsum(merged[1]) - merged[1]
        at = coded.indices.to_numpy()
        return gather(values, starts[at], sizes[at])

    def _merged(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens in a row and their numbers. Many go through the model in one call: no piece has a line
        feed, so none is built over one, and each comes out as the unknown id."""
        ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        unknown = len(self.bytes_of)
        for k in range(0, len(tokens), 4096):
            part = tokens[k : k + 4096]
            shown = b"\n".join(part)
            if shown.count(b"\n") > len(part) - 1:  # line feeds inside pre-tokens are shown as characters
                shown = "\n".join([t.decode("latin-1").translate(self.shown) for t in part])
            else:
                shown = shown.decode("latin-1").translate(self.shown_apart)
            made = np.array(self.sp.encode(shown, out_type=int, num_threads=1), np.int64)
            apart = np.append(np.flatnonzero(made == unknown), len(made))
            counts.append(np.diff(apart, prepend=-1) - 1)
            ids.append(made[made != unknown])
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, counts = self.encoder.encode(pa.array(texts, pa.large_string()))
        return cut_bytes(ids, counts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def cut_bytes(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The ids' bytes, cut into texts."""
    raw, ends = ids.tobytes(), (np.cumsum(counts) * ids.itemsize).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


@functools.lru_cache(maxsize=2)
def _loaded(model: bytes, pattern: str) -> ByteBPE:
    gc.disable()  # millions of strings and no cycles
    return ByteBPE(model, pattern)


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int, pa.Array]]:
    """Row ranges of about ``most`` bytes with their texts, null as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    for a, b in chunks(offsets, most):
        yield a, b, texts.slice(a, b - a)


def text_batches(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges of about a megabyte with their texts as Python strings, null as empty."""
    for a, b, part in text_slices(texts, 1 << 20):
        yield a, b, part.to_pylist()


def encode_bpe(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, [ids array<int>,] ids_sha256, decoded_sha256, round_trip.

    ``path`` is the rank file, read on the driver; the model (under 2 MB, of a fixed vocabulary) goes
    to the executors as a broadcast. round_trip says whether the decoded bytes are the text's.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(serialize_model(read_ranks(path)))
    fields = "doc_id bigint, n_tokens bigint," + "ids array<int>," * with_ids
    schema = f"{fields} ids_sha256 string, decoded_sha256 string, round_trip boolean"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(model.value, pattern)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), CHUNK):
                every, counts = bpe.encoder.encode(texts)
                ids = cut_bytes(every, counts)
                decoded = [bpe.decode(x) for x in ids]
                columns = [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(counts)]
                if with_ids:
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    flat = pa.array(every.view("<i4"), pa.int32())
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
                columns += [
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                    pc.equal(pa.array(decoded, pa.large_binary()), texts.cast(pa.large_binary())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(",")])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
