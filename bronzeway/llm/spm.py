"""SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is parsed and its normaliser, metaspace marker, scores and
byte fallback are rebuilt as a ``tokenizers`` pipeline, which encodes batches
with several threads. Every text is encoded by the original library too (or a
share, where a caller asks for less), and the two must agree.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bronzeway.llm.common import with_fields

#: Public model on every machine of the sandbox; a parameter everywhere.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
#: Characters encoded at once: the library holds about 200 bytes for each token.
SLICE_CHARS = 1 << 18
MARK = "▁"
# Kinds of pieces and models in the model's protobuf (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _merges(pieces) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, best score of the result first."""
    index = {p.piece: i for i, p in enumerate(pieces)}
    ranked = []
    for i, p in enumerate(pieces):
        if p.type != NORMAL:
            continue
        for cut in range(1, len(p.piece)):
            left, right = p.piece[:cut], p.piece[cut:]
            if left in index and right in index:
                ranked.append((-p.score, i, index[left], index[right], left, right))
    return [(left, right) for *_, left, right in sorted(ranked)]


def build_tokenizer(model: bytes, by_word: bool = False):
    """The ``tokenizers`` pipeline that encodes and decodes as ``model`` does.

    Unigram and BPE models are known. User-defined pieces are refused, as they
    are matched ahead of the model. ``by_word`` encodes word by word: slower, with
    the same ids, in memory that doesn't grow with the text; for long texts.
    """
    from sentencepiece import sentencepiece_model_pb2
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    pieces, kind = list(proto.pieces), proto.trainer_spec.model_type
    if any(p.type == USER_DEFINED for p in pieces):
        raise ValueError("user-defined pieces are not supported")
    unknown = next(i for i, p in enumerate(pieces) if p.type == UNKNOWN)
    fallback = any(p.type == BYTE for p in pieces)
    if kind == UNIGRAM:
        # Only normal pieces stand for text that reads like them; the library has no kinds.
        far = min((p.score for p in pieces if p.type == NORMAL), default=0.0) - 1000
        scored = [(p.piece, p.score if p.type == NORMAL else far) for p in pieces]
        core = models.Unigram(scored, unk_id=unknown, byte_fallback=fallback)
    elif kind == BPE:
        core = models.BPE(
            vocab={p.piece: i for i, p in enumerate(pieces)},
            merges=_merges(pieces),
            unk_token=pieces[unknown].piece,
            fuse_unk=True,
            byte_fallback=fallback,
        )
    else:
        raise ValueError(f"model type {kind} is not supported")

    spec = proto.normalizer_spec
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence(steps)
    # Where no piece has the marker behind another character, no piece crosses
    # the place in front of a run of markers: words may be encoded one by one.
    if by_word and not any(MARK in p.piece.lstrip(MARK) for p in pieces):
        words = Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        tokenizer.pre_tokenizer = pre_tokenizers.Split(words, "isolated")
    # Bytes never make a marker, as it is a piece, so markers are replaced once, at the end.
    undo = [decoders.ByteFallback()] if fallback else []
    undo += [decoders.Fuse(), decoders.Replace(MARK, " ")]
    if spec.add_dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    return tokenizer


class _Ids(NamedTuple):
    ids: list[int]


class _Many:
    """Lists of texts and of their ids; with the library's flag, which must be off, one
    text and its ids, as the library's tokenizers take them."""

    def encode(self, given, add_special_tokens: bool | None = None):
        if add_special_tokens is None:
            return self.encode_all(given)
        if add_special_tokens:
            raise ValueError("texts are encoded without special tokens")
        return _Ids(self.encode_all([given])[0])

    def decode(self, ids, skip_special_tokens: bool | None = None):
        if skip_special_tokens is None:
            return self.decode_all(ids)
        if skip_special_tokens:
            raise ValueError("special tokens are decoded like others")
        return self.decode_all([ids])[0]


@dataclass(frozen=True)
class _Plain(_Many):
    """A pipeline whose marker is put in and taken out as plain text, a text at a time.

    The library's own steps track every character's place, which nobody asks for here.
    """

    tokenizer: object
    prefix: bool

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        start = MARK if self.prefix else ""
        marked = [text and start + text.replace(" ", MARK) for text in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]

    def decode_all(self, ids: list[list[int]]) -> list[str]:
        shown = (text.replace(MARK, " ") for text in self.tokenizer.decode_batch(ids, skip_special_tokens=False))
        return [text.removeprefix(" ") for text in shown] if self.prefix else list(shown)


@dataclass(frozen=True)
class _Whole(_Many):
    """A pipeline as it is."""

    tokenizer: object

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode_all(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def _quick(model: bytes, by_word: bool = False) -> _Plain | _Whole:
    """``build_tokenizer`` with the same ids and texts; where the normaliser only marks
    spaces, Python does that."""
    from sentencepiece import sentencepiece_model_pb2
    from tokenizers import decoders

    tokenizer = build_tokenizer(model, by_word)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        return _Whole(tokenizer)
    fallback = any(p.type == BYTE for p in proto.pieces)
    tokenizer.normalizer = None
    tokenizer.decoder = decoders.Sequence(([decoders.ByteFallback()] if fallback else []) + [decoders.Fuse()])
    return _Plain(tokenizer, spec.add_dummy_prefix)


@lru_cache(maxsize=2)
def _pipelines(model: bytes, threads: int):
    # Read by the library when it first starts its threads in this worker.
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    import sentencepiece

    return (
        _quick(model),
        _quick(model, by_word=True),
        sentencepiece.SentencePieceProcessor(model_proto=model),
    )


def _slices(texts: list[str]) -> Iterator[list[int]]:
    """Positions in runs of up to SLICE_CHARS of text; a longer text is alone."""
    at, size = [], 0
    for i, text in enumerate(texts):
        if at and size + len(text) > SLICE_CHARS:
            yield at
            at, size = [], 0
        at.append(i)
        size += len(text)
    if at:
        yield at


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame,
    model: bytes,
    text: str = "text",
    verify_one_in: int = 1,
    threads: int = THREADS,
) -> DataFrame:
    """Add ``ids`` (array<int>), ``decoded`` (string) and ``parity`` (boolean).

    Every whole text is encoded, and its ids are decoded again. ``parity`` tells
    whether the original library gives the same ids and the same decoded text. With
    ``verify_one_in`` above 1, it is NULL but for about one text in so many.
    No shuffle: rows stay where they are.

    A NULL text has NULL ids, decoded and parity; an empty text has no ids and
    decodes to an empty one. Texts of any length are encoded whole. Repeated rows are
    encoded each, and no rows give none; input columns of the result's names are replaced.
    """
    kept = docs.drop("ids", "decoded", "parity")
    out = with_fields(kept, ids="array<int>", decoded="string", parity="boolean")
    names = kept.columns
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        tokenizer, worded, original = _pipelines(shipped.value, threads)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for at in _slices([t or "" for t in texts]):
                full = [i for i in at if texts[i] is not None]
                given = [texts[i] for i in full]
                long = len(given) == 1 and len(given[0]) > SLICE_CHARS
                ids = (worded if long else tokenizer).encode(given)
                back = tokenizer.decode(ids)
                chosen = [k for k, value in enumerate(given) if _chosen(value, verify_one_in)]
                expected = original.encode([given[k] for k in chosen], num_threads=1) if chosen else []
                # Where the ids agree, the original decodes the very same ones.
                again = original.decode(expected, num_threads=1) if chosen else []
                parity = [None] * len(given)
                for k, theirs, shown in zip(chosen, expected, again):
                    parity[k] = theirs == ids[k] and shown == back[k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(at)) for c in names]
                    + [
                        _flat_lists(ids, full, at),
                        _spread(pa.array(back, pa.string()), full, at),
                        _spread(pa.array(parity, pa.bool_()), full, at),
                    ],
                    names=names + ["ids", "decoded", "parity"],
                )

    return docs.mapInArrow(run, out)


def _spread(values: pa.Array, full: list[int], at: list[int]) -> pa.Array:
    """Values of the rows ``full`` at the rows ``at``; the others are NULL."""
    if len(full) == len(at):
        return values
    place = {i: k for k, i in enumerate(full)}
    return values.take(pa.array([place.get(i) for i in at], pa.int64()))


def _flat_lists(lists: list[list[int]], full: list[int], at: list[int]) -> pa.Array:
    """Lists as one flat array with offsets."""
    offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
    return _spread(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), full, at)


def _chosen(text: str, one_in: int) -> bool:
    if one_in == 1:
        return True
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little") % one_in == 0
