"""Byte-level BPE through sentencepiece: encode pre-tokens, decode by the inverse mapping.

A rank file becomes a sentencepiece model without training: every byte is written as one
printable character, every token as the string of its bytes' characters with the score
-rank, and normalisation is the identity. Merging the pair of highest score first is then
merging the pair of lowest rank first. Tokens that merging does not reach are looked up
whole, as a rank-based encoder does.
"""

import base64
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evrange.llm import pretokens
from evrange.llm.common import col, fresh, giving_back

#: Chunks that a worker keeps: few enough to stay beside what other operators keep there.
CACHED = 250_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank. Ranks must be 0, 1, 2, ... without a gap."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks have gaps")
    return [ranks[r] for r in range(len(ranks))]


def byte_chars() -> list[str]:
    """A visible character for each byte: itself if it is printable Latin-1, else one from U+0100 on."""
    shown = [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else "" for b in range(256)]
    spare = iter(range(256, 512))
    return [c or chr(next(spare)) for c in shown]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One protocol-buffer field: bytes, a 32-bit float or an integer."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; one more id stands for the unknown."""
    chars = byte_chars()
    pieces = ["".join(chars[b] for b in token) for token in tokens]
    out = [_field(1, _field(1, p.encode()) + _field(2, float(-rank))) for rank, p in enumerate(pieces)]
    out.append(_field(1, _field(1, "⁇".encode()) + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces) + 1) + _field(40, len(pieces))
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes with a model from model_bytes(). One is kept per worker and model."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.findall = regex.compile(pattern).findall
        chars = byte_chars()
        self.shown = dict(zip(range(256), chars))
        back = {c: b for b, c in enumerate(chars)}
        n = self.model.get_piece_size() - 1
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.token = [bytes(back[c] for c in p) for p in pieces]
        self.whole = {p: [i] for i, (p, ids) in enumerate(zip(pieces, self.model.encode(pieces, num_threads=1)))
                      if ids != [i]}
        self.table = pretokens.Table(self._encode_many, CACHED)

    def _encode_many(self, chunks: list[str]) -> list[bytes]:
        words, ends = [], []
        for chunk in chunks:
            words += self.findall(chunk)
            ends.append(len(words))
        mapped = [w.encode().decode("latin-1").translate(self.shown) for w in words]
        ids = self.model.encode(mapped, num_threads=1)
        if self.whole:
            ids = [self.whole.get(w, i) for w, i in zip(mapped, ids)]
        raw = [struct.pack(f"<{len(i)}I", *i) for i in ids]
        return [b"".join(raw[a:b]) for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.table.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


_codecs: dict = {}


def _codec(model, pattern) -> Codec:
    key = (model.value, pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(*key)
    return _codecs[key]


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, text: str = "text", ids: str = "ids",
           decoded: str | None = "decoded") -> DataFrame:
    """`docs` with two more columns: the ids of `text` as little-endian unsigned 32-bit
    integers, and the bytes that decoding those ids gives back (decoded=None: left out).

    Every match of `pattern` is encoded by itself; there are no special tokens, so their
    strings are ordinary text. A null text counts as empty and has no ids. Other columns pass
    through, null or not; names that clash with `ids` or `decoded` raise. Rows are independent,
    so repeated rows have equal results and an empty table gives an empty table.
    """
    added = [c for c in (ids, decoded) if c]
    if fresh(docs, *added) != added:
        raise ValueError(f"the table has a column {ids} or {decoded} already")
    session = docs.sparkSession
    model = session.sparkContext.broadcast(model_bytes(tokens))
    place = docs.columns.index(text)
    schema = docs.select("*", *(F.lit(b"").alias(c) for c in added)).schema
    names = [f"c{i}" for i in range(len(schema))]
    safe = docs.toDF(*names[:len(docs.columns)])

    def run(batches):
        codec = _codec(model, pattern)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(place).to_pylist()]
                for a, b in pretokens.blocks(texts):
                    raw = codec.encode(texts[a:b])
                    columns = [*batch.slice(a, b - a).columns, pa.array(raw, pa.binary())]
                    if decoded:
                        columns.append(pa.array([codec.decode(r) for r in raw], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            # the worker goes on to other operators, which need the memory
            codec.table.known.clear()

    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema))
    return safe.mapInArrow(giving_back(run), kinds).toDF(*schema.names)


def digests(encoded: DataFrame, keep: list[str], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Number of ids, and the SHA-256 of the ids and of the decoded bytes."""
    return encoded.select(*map(col, keep), (F.octet_length(col(ids)) / 4).cast("long").alias("n_tokens"),
                          F.sha2(col(ids), 256).alias("ids_sha256"),
                          F.sha2(col(decoded), 256).alias("decoded_sha256"))
