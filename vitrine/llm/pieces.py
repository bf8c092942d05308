"""SentencePiece models on the tokenizers library.

The model's protobuf is read field by field; normaliser, metaspace marker,
scores and byte fallback are rebuilt as a tokenizers pipeline, which encodes
batches on several threads.  What it yields is held against the sentencepiece
library itself for every text: unit by unit where texts are cut into units.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from vitrine.llm.words import blocks, text_bytes

MARKER = "▁"
# Fixed values of the model format: kinds of model and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLOCK_BYTES = 1 << 21
UNITS_AT_ONCE = 20_000
THREADS = 2
RESULT = "doc_id long, ids array<int>, n_tokens long, n_bytes_fallback long, decoded_equal boolean, parity boolean"


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_blanks: bool = True
    escape_blanks: bool = True


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _varint(data, at)
            value = data[at : at + size]
            at += size
        yield number, value


def read_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            normalizer = dict(_fields(value))
            model.charsmap = normalizer.get(2, b"")
            model.dummy_prefix = bool(normalizer.get(3, 1))
            model.trim_blanks = bool(normalizer.get(4, 1))
            model.escape_blanks = bool(normalizer.get(5, 1))
    return model


def build_tokenizer(model: Model, units: bool = False) -> Tokenizer:
    """The same model as a tokenizers pipeline; for ``units``, whose blanks are markers already, without normaliser."""
    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind == UNIGRAM:
        # a control piece is never found in text
        vocabulary = [(p, s if k not in (CONTROL, UNUSED) else -1e30) for p, s, k in model.pieces]
        tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=model.byte_fallback))
    elif model.kind == BPE:
        tokenizer = Tokenizer(
            models.BPE(
                {p: i for i, (p, _, _) in enumerate(model.pieces)},
                _merges(model),
                unk_token=model.pieces[unknown][0],
                fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        )
    else:
        raise ValueError(f"model kind {model.kind} is neither unigram nor BPE")
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trim_blanks:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER if model.escape_blanks else " "))
    if model.escape_blanks:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence([] if units else steps)
    parts = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix and not units:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


def splits_at_blanks(model: Model) -> bool:
    """Whether a text can be encoded in units, each a run of blanks and what follows up to the next run.

    So it is if the text is taken as it is and no piece has a marker after
    another character: nothing is then ever merged across the start of a run.
    Unigram models are left out, whose scores are rounded as they add up over the
    text, and those where a lone marker is unknown and joins its neighbours.
    """
    usable = [p for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)]
    as_is = model.dummy_prefix and model.escape_blanks and not model.trim_blanks and not model.charsmap
    apart = model.kind == BPE and (model.byte_fallback or MARKER in usable)
    return as_is and apart and not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in usable)


def _merges(model: Model) -> list[tuple[str, str]]:
    """All ways to make a piece of two, in the order in which SentencePiece prefers them.

    That is by score, and for equal scores the leftmost pair in the text.  Equal
    scores occur among runs of markers; there the leftmost pair is the one whose
    left part has grown most, so longer left parts come first.
    """
    scores = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    order = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    found = []
    for piece, score in scores.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in scores and right in scores:
                run = not piece.strip(MARKER)
                found.append((-score, (-cut, 0) if run else (0, order[piece]), left, right))
    found.sort(key=lambda m: m[:2])
    return [(left, right) for _, _, left, right in found]


def ship_model(spark, path: str) -> str:
    """Sends the model file to all executors and returns the name they find it by."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _library_units(library, units: list[str]) -> list[list[int]]:
    """What the library yields for units, each of which begins with a blank, as it puts one in front of a text."""
    found = library.encode([u[1:] for u in units], num_threads=THREADS)
    for n, unit in enumerate(units):
        if unit == " ":  # nothing by itself, one blank behind something
            found[n] = library.encode("a ")[len(library.encode("a")) :]
    return found


def _encode_units(
    tokenizer: Tokenizer, library, units: pa.Array
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids of the units, how many each has, whether each decodes to itself and was what the library yields.

    The ids are the library's where the tokenizer's differ.
    """
    flat, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    sound, alike = [np.ones(0, bool)], [np.ones(0, bool)]
    gc.disable()  # the many small lists have no cycles, and looking for some takes a third of the time
    for start in range(0, len(units), UNITS_AT_ONCE):
        some = units.slice(start, UNITS_AT_ONCE)
        marked = pc.replace_substring(some, " ", MARKER).to_numpy(zero_copy_only=False).tolist()
        found = [e.ids for e in tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
        same = np.ones(len(found), bool)
        theirs = _library_units(library, some.to_pylist())
        if theirs != found:
            same = np.array([a == b for a, b in zip(theirs, found, strict=True)], bool)
            found = theirs
        ids = [i for own in found for i in own]
        fine = np.ones(len(found), bool)
        if tokenizer.decode(ids, skip_special_tokens=False).encode() != text_bytes(some)[0].tobytes():
            back = tokenizer.decode_batch(found, skip_special_tokens=False)
            fine = np.array([u == d for u, d in zip(some.to_pylist(), back, strict=True)], bool)
        flat.append(np.array(ids, np.int32))
        sizes.append(np.array([len(own) for own in found], np.int32))
        sound.append(fine)
        alike.append(same)
    gc.enable()
    return np.concatenate(flat), np.concatenate(sizes), np.concatenate(sound), np.concatenate(alike)


def _loaded(name: str):
    import sentencepiece

    # few threads a task: the tasks of an executor fill its cores already
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    path = SparkFiles.get(name)
    with open(path, "rb") as file:
        model = read_model(file.read())
    bytewise = np.array([kind == BYTE for _, _, kind in model.pieces])
    units = build_tokenizer(model, units=True) if splits_at_blanks(model) else None
    return build_tokenizer(model), sentencepiece.SentencePieceProcessor(model_file=path), model, bytewise, units


def _by_units(
    tokenizer: Tokenizer, library, texts: pa.Array
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat ids, number of ids per text, whether each text's units decode to themselves and were the library's."""
    data, offsets = text_bytes(texts)
    sizes = np.diff(offsets)
    some = sizes > 0  # a text that isn't empty gets one blank in front
    cuts = np.concatenate(([0], np.cumsum(sizes + some)))
    buffer = np.full(cuts[-1], 0x20, np.uint8)
    own = np.ones(len(buffer), bool)
    own[cuts[:-1][some]] = False
    buffer[own] = data
    blank = buffer == 0x20
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    first[cuts[:-1][some]] = True
    starts = np.flatnonzero(first)
    count = len(starts)
    edges = np.append(starts, len(buffer)).astype(np.int32)
    found = pa.StringArray.from_buffers(count, pa.py_buffer(edges), pa.py_buffer(buffer)).dictionary_encode()
    held, sizes_of, sound, alike = _encode_units(tokenizer, library, found.dictionary)
    starts_of = np.cumsum(sizes_of, dtype=np.int32) - sizes_of
    rows = found.indices.to_numpy()
    text = np.searchsorted(cuts, starts, side="right") - 1
    n = sizes_of[rows]
    places = np.repeat(starts_of[rows] - (np.cumsum(n, dtype=np.int32) - n), n)
    places += np.arange(len(places), dtype=np.int32)
    flat = held[places]
    per_text = np.bincount(text, weights=n, minlength=len(texts)).astype(np.int64)
    unsound = np.bincount(text, weights=~sound[rows], minlength=len(texts))
    unlike = np.bincount(text, weights=~alike[rows], minlength=len(texts))
    return flat, per_text, unsound == 0, unlike == 0


def encode(docs: DataFrame, model_path: str, parity_share: int = 64) -> DataFrame:
    """Token ids of each row of ``docs`` (doc_id, text; other columns are not read).

    Returns doc_id, ids, n_tokens, n_bytes_fallback (ids of single bytes),
    decoded_equal (decoding the ids gives the text again, as the normaliser
    leaves it) and parity: whether the rebuilt tokenizer yields the same ids as
    the sentencepiece library, which is asked about every text.  Where it
    differs the library's ids are returned.

    Where the model allows, a text is encoded in units that start at runs of
    blanks: each distinct unit of a group is encoded by both and decoded once.
    Texts with a marker character, and all texts of other models, are encoded
    whole by both.  One in ``parity_share`` texts, by a hash of the text, goes to
    the library whole besides, which tells whether the cut into units holds.

    Special pieces in a text are ordinary text.  A null or empty text has no
    ids.  Repeated rows are encoded alike; an empty table gives an empty result.
    Texts are encoded in groups of about two megabytes on several threads, a
    longer text on its own.
    """
    name = ship_model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, library, model, bytewise, units = _loaded(name)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            data, offsets = text_bytes(texts)
            for a, b in blocks(offsets, BLOCK_BYTES):
                part = texts.slice(a, b - a)
                whole = np.ones(b - a, bool)
                flat, sizes, equal = np.zeros(0, np.int32), np.zeros(b - a, np.int64), np.ones(b - a, bool)
                same = np.ones(b - a, bool)
                if units is not None:
                    whole = pc.match_substring(part, MARKER).to_numpy(zero_copy_only=False)
                    flat, sizes, equal, same = _by_units(units, library, pc.if_else(pa.array(whole), "", part))
                ids = np.split(flat, np.cumsum(sizes)[:-1])
                asked = whole.copy()
                for i, text in enumerate(part.to_pylist()):
                    asked[i] |= zlib.crc32(data[offsets[a + i] : offsets[a + i + 1]]) % parity_share == 0
                    if whole[i]:
                        ids[i] = np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
                        back = tokenizer.decode(ids[i].tolist(), skip_special_tokens=False)
                        equal[i] = back == _expected(model, library, text)
                for i in np.flatnonzero(asked).tolist():
                    theirs = np.array(library.encode(part[i].as_py()), np.int32)
                    if not np.array_equal(theirs, ids[i]):
                        same[i], ids[i] = False, theirs
                        back = tokenizer.decode(theirs.tolist(), skip_special_tokens=False)
                        equal[i] = back == _expected(model, library, part[i].as_py())
                sizes = np.array([len(x) for x in ids], np.int64)
                flat = np.concatenate(ids).astype(np.int32)
                cuts = np.concatenate(([0], np.cumsum(sizes)))
                fallback = np.concatenate(([0], np.cumsum(bytewise[flat])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat)),
                        pa.array(sizes),
                        pa.array(fallback[cuts[1:]] - fallback[cuts[:-1]], pa.int64()),
                        pa.array(equal),
                        pa.array(same),
                    ],
                    ["doc_id", "ids", "n_tokens", "n_bytes_fallback", "decoded_equal", "parity"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def _expected(model: Model, library, text: str) -> str:
    """What decoding should give: the text, normalised where the model does so; markers read as blanks."""
    if model.charsmap or model.trim_blanks:
        text = library.normalize(text).removeprefix(MARKER if model.dummy_prefix else "")
    return text.replace(MARKER, " ") if model.escape_blanks else text


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give an empty text."""
    name = ship_model(encoded.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded(name)[0]
        for batch in batches:
            texts = tokenizer.decode_batch([ids or [] for ids in batch.column(1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
