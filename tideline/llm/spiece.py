"""SentencePiece encoding and decoding: the model file rebuilt for the tokenizers library."""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm._shared import map_batches

#: A public SentencePiece model; operators take any path that the driver can open.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Fixed values of the model's format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message: integers, or the bytes of longer values."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 0x7F) << shift
            i, shift = i + 1, shift + 7
            if byte < 0x80:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        wire = key & 7
        if wire == 0:
            value, i = varint(i)
        else:
            n, i = varint(i) if wire == 2 else ({1: 8, 5: 4}[wire], i)
            value, i = data[i : i + n], i + n
        yield key >> 3, value


@dataclass(frozen=True)
class Model:
    kind: int
    pieces: tuple[tuple[str, float, int], ...]
    byte_fallback: bool
    unk_id: int
    charsmap: bytes
    dummy_prefix: bool
    squeeze_spaces: bool
    escape_spaces: bool
    suffix_mark: bool


def parse_model(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    unk = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    return Model(trainer.get(3, UNIGRAM), tuple(pieces), bool(trainer.get(35, 0)), unk, normalizer.get(2, b""), bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)), bool(trainer.get(24, 0)))


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every way to put a piece together from two, best score first, as the library ranks them."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL:
            for i in range(1, len(piece)):
                a, b = piece[:i], piece[i:]
                if a in ids and b in ids:
                    found.append((-score, ids[piece], ids[a], ids[b], a, b))
    return [(a, b) for *_, a, b in sorted(found)]


def build_tokenizer(model: Model):
    """(tokenizer, normalise): the tokenizers.Tokenizer that encodes normalised texts and decodes as the model does, and the function that normalises.

    A model that only marks spaces is normalised by str.replace, which is much faster than the library's steps.
    """
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if any(kind == USER_DEFINED for *_, kind in model.pieces) or model.suffix_mark or not model.escape_spaces:
        raise ValueError("models with user-defined pieces, marks after words or plain spaces are not supported")
    unk = model.pieces[model.unk_id][0]
    if model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model), unk_token=unk, fuse_unk=True, byte_fallback=model.byte_fallback, cache_capacity=0)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"models of kind {model.kind} are not supported")
    out = Tokenizer(core)
    out.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Metaspace(MARK, prepend_scheme="never")])
    if not model.charsmap and not model.squeeze_spaces:
        return out, lambda text: (MARK * (model.dummy_prefix and text != "") + text).replace(" ", MARK)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    return out, normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)]).normalize_str


#: Rows of a batch that are worked on at once.
SLICE = 256


class Codec:
    """Encodes and decodes batches of whole texts by a tokenizer built of a model, each batch in one multithreaded call."""

    def __init__(self, data: bytes):
        self.model = parse_model(data)
        self.tokenizer, self.normalize = build_tokenizer(self.model)

    def encode(self, texts: list[str], library=None) -> tuple[list[list[int]], list[bool | None]]:
        """The ids of each text and, given the library's processor, whether it has the same for the text as it stands."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([self.normalize(t) for t in texts], add_special_tokens=False)]
        return ids, [x == y for x, y in zip(ids, library.encode(texts, num_threads=1), strict=True)] if library else [None] * len(texts)

    def decode(self, ids: list[list[int]]) -> list[str]:
        """The texts of ids; the space of the mark that was put before a text goes."""
        texts = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [t[1:] if t.startswith(" ") else t for t in texts] if self.model.dummy_prefix else texts


@functools.lru_cache(maxsize=2)
def _ready(data: bytes) -> Codec:
    return Codec(data)


@functools.lru_cache(maxsize=2)
def _library(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def read_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, text_col: str = "text", verify: bool = True, ids: bool = True) -> DataFrame:
    """Returns the documents with n_tokens, token_ids, ids_sha256, decoded, round_trip and parity.

    token_ids are those of the whole text, without added ones; decoded is what they decode to; round_trip is whether
    that is the text; ids_sha256 is the lowercase hex digest of the ids as 32-bit little-endian integers. With verify,
    parity is whether the sentencepiece library gives the same ids for the whole text, else null. Without ids,
    token_ids and decoded are left out, and decoded_sha256 stands for the latter.

    Batches are encoded by as many threads as the worker may use. Null and empty texts have no tokens and decode to
    an empty text; a null's round_trip is that of an empty one. A very long text is encoded whole, and must fit in a
    task with its ids. Equal texts, repeated rows too, give equal results. Empty tables stay empty. Input columns named
    as the results are replaced. The model (some hundred kilobytes) goes with the tasks.
    """
    results = [("n_tokens", T.LongType())]
    results += [("token_ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())] if ids else [("decoded_sha256", T.StringType())]
    results += [("ids_sha256", T.StringType()), ("round_trip", T.BooleanType()), ("parity", T.BooleanType())]
    taken = {"n_tokens", "token_ids", "ids_sha256", "decoded", "decoded_sha256", "round_trip", "parity"}
    keep = [f for f in docs.schema.fields if f.name.lower() not in taken]
    names = [f.name for f in keep]

    def apply(batches):
        import pyarrow as pa

        codec = _ready(model)
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            found, same = codec.encode(texts, _library(model) if verify else None)
            back, coded = codec.decode(found), [np.array(x, "<i4").tobytes() for x in found]
            ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
            columns = [pa.array(np.diff(ends), pa.int64())]
            if ids:
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32())
                columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), pa.array(back, pa.string())]
            else:
                columns.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()))
            columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()))
            columns.append(pa.array([x == y for x, y in zip(texts, back, strict=True)], pa.bool_()))
            columns.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names, *(r for r, _ in results)])

    schema = T.StructType([*keep, *(T.StructField(n, t) for n, t in results)])
    return map_batches(docs.select(*[f"`{x}`" for x in names], F.col(text_col).alias("__text")), apply, schema)
