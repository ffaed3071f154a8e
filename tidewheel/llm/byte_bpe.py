"""Byte-level BPE by a sentencepiece model that is made from a rank file.

The vocabulary is a file of base64 pieces and ranks. Each byte stands for one letter (U+0100 plus
the byte), each piece is scored by its negative rank and nothing is normalised, so sentencepiece
merges in the order of the ranks. A text is cut into pre-tokens by a pattern first; each is
encoded apart. Decoding maps ids to pieces and letters back to bytes.

A null text counts as empty and has no ids. Texts are taken whole. Equal texts give equal ids. Extra
columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tidewheel.llm.workers import importable

# First of the 256 letters that stand for bytes.
LETTERS = 0x100
TO_LETTERS = {b: LETTERS + b for b in range(256)}

# Pre-tokens whose ids a worker remembers; past that it starts afresh.
REMEMBERED = 1 << 17
# Texts whose ids are held before they are handed on.
TOGETHER = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """The pieces of a rank file by their rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def as_letters(piece: bytes) -> str:
    return piece.decode("latin-1").translate(TO_LETTERS)


def as_bytes(letters: str) -> bytes:
    return bytes(ord(letter) - LETTERS for letter in letters)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece n is the n-th piece by rank; the unknown piece is last."""
    model = proto.ModelProto()
    for piece, rank in sorted(ranks.items(), key=lambda item: item[1]):
        model.pieces.add(piece=as_letters(piece), score=-float(rank), type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(ranks)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes single texts with a serialised model.

    ``numbers`` holds the rank of each piece of the model, which is the id that is given out.
    """

    def __init__(self, model: bytes, numbers: list[int], pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.numbers = np.array(numbers, dtype="<u4")
        pieces = [as_bytes(self.processor.id_to_piece(n)) for n in range(len(numbers))]
        self.bytes_of = dict(zip(numbers, pieces, strict=True))
        self.whole = {piece: number for number, piece in self.bytes_of.items()}
        self.known: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        tokens = self.split(text or "")
        new = list(set(tokens).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(set(tokens))
        spelled = [token.encode() for token in new]
        merged = self.processor.encode([as_letters(token) for token in spelled], out_type=int, num_threads=1)
        for token, raw, ids in zip(new, spelled, merged, strict=True):
            # A pre-token that is a piece itself is taken without merging.
            number = self.whole.get(raw)
            found = self.numbers[ids] if number is None else np.array([number], dtype="<u4")
            self.known[token] = found.tobytes()
        return b"".join(map(self.known.__getitem__, tokens))

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids or b"", dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def codec(model: bytes, numbers: tuple[int, ...], pattern: str) -> Codec:
    """One for each vocabulary that a Python worker meets."""
    return Codec(model, list(numbers), pattern)


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def coders(path: str, pattern: str) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """Column functions from text to ids and from ids to the bytes of the text.

    Ids are binary: little-endian unsigned 32-bit integers one after another. The rank file is
    read here, on the driver; tasks get the model, whose size is that of the vocabulary.
    """
    ranks = read_ranks(path)
    settings = (serialise(ranks), tuple(sorted(ranks.values())), pattern)

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(*settings)
        for texts in batches:
            for start in range(0, len(texts), TOGETHER):
                yield _binary([own.encode(text.as_py()) for text in texts.slice(start, TOGETHER)])

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(*settings)
        for ids in batches:
            for start in range(0, len(ids), TOGETHER):
                yield _binary([own.decode(one.as_py()) for one in ids.slice(start, TOGETHER)])

    return encode, decode


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of ``text``; a column that is called ``out`` already is replaced."""
    importable(docs.sparkSession)
    encode, _ = coders(path, pattern)
    return docs.withColumn(out, encode(F.col(text)))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Each document's number of ids, and digests of its ids and of what they decode to.

    Every row of ``docs`` gives one, repeated rows too; other columns are left out.
    """
    _, decode = coders(path, pattern)
    ids = encoded(docs.select("doc_id", "text"), path, pattern).drop("text")
    return ids.withColumn("_decoded", decode(F.col("token_ids"))).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("_decoded"), 256).alias("decoded_sha256"),
    )
