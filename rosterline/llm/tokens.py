"""Token ids of whole texts, for packing and for binary output.

White space never takes part in a token of the vocabulary used here and never joins two, and letters or digits never join
with ASCII marks, so a text's ids are the ids of such pieces in order.  Each distinct piece is encoded once per worker by the
tokenizers library.  A vocabulary that normalises or splits texts in another way gets whole texts, since none of this holds for it."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from . import common

#: Pieces whose ids a Python worker keeps; beyond it the table starts anew (a speed matter only).
KEPT_PIECES = 1_000_000

#: Byte classes: 1 letter or digit, 2 mark that may be cut off, 0 anything else.  The apostrophe starts contractions, "<", "|"
#: and ">" spell special tokens, and what a byte above 127 belongs to is not decided here.
_CLASS = np.zeros(256, np.int8)
_CLASS[[c for c in range(33, 127) if chr(c).isalnum()]] = 1
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<|>"]] = 2


#: The vocabulary spells bytes as printable characters: those that print stand for themselves, the others follow from 256 on.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: chr(b) for b in _PRINTS} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PRINTS))}
#: Runs of these letters are one pre-token that normalisation leaves as it is.
_PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+").fullmatch


# How the vocabulary that texts may be cut for normalises and splits them.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def may_be_cut(path: str) -> bool:
    """Whether texts may be cut into pieces for the vocabulary file: its normaliser and splitter are those known here, and all its
    added tokens begin with ``<|``, which no cut falls into."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return (spec.get("normalizer") == {"type": "Sequence", "normalizers": _NORMALIZERS} and
            spec.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]} and
            all(t["content"].startswith("<|") for t in spec.get("added_tokens", [])))


class Known:
    """Numbers of 64-bit hashes, by open addressing in arrays: 12 bytes a slot."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.hash = np.zeros(1 << bits, np.uint64)
        self.number = np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        left, slot = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(left):
            held = self.hash[slot]
            hit = held == hashes[left]
            out[left[hit]] = self.number[slot[hit]]
            on = ~hit & (held != 0)
            left, slot = left[on], (slot[on] + 1) & self.mask
        return out

    def put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct hashes that are not there yet."""
        slot = (hashes >> self.shift).astype(np.int64)
        while len(hashes):
            free = self.hash[slot] == 0
            self.hash[slot[free]] = hashes[free]  # of several the last one stays
            done = self.hash[slot] == hashes
            self.number[slot[done]] = numbers[done]
            hashes, numbers, slot = hashes[~done], numbers[~done], (slot[~done] + 1) & self.mask


class Encoder:
    """Ids of texts by ``tokenizer.encode(text, add_special_tokens=False)``, with ``end_id`` after each text."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = may_be_cut(path)
        self.end_id = end_id
        self._reset()

    def _reset(self) -> None:
        self.known = Known(KEPT_PIECES.bit_length() + 1)
        # number 0 is the end id
        self.first, self.size = np.zeros(1, np.int32), np.ones(1, np.int32)
        self.flat = np.array([self.end_id], np.uint32)

    def _learn(self, pieces: list[bytes]) -> None:
        model = self.tokenizer.model
        texts = [p.decode() for p in pieces]
        plain = [_PLAIN(t) is not None for t in texts]
        odd = [t for t, p in zip(texts, plain) if not p]
        by_library = iter([e.ids for at in range(0, len(odd), 4096)
                           for e in self.tokenizer.encode_batch_fast(odd[at:at + 4096], add_special_tokens=False)])
        found = []
        for raw, text, p in zip(pieces, texts, plain):
            if p:
                found.append([t.id for t in model.tokenize(text if len(raw) == len(text) else "".join([_SPELLED[b] for b in raw]))])
            else:
                found.append(next(by_library))
        size = np.array([len(f) for f in found], np.int32)
        first = (np.cumsum(size) - size + len(self.flat)).astype(np.int32)
        self.first, self.size = np.concatenate([self.first, first]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.array([i for f in found for i in f], np.uint32)])

    def _numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each piece; new ones are encoded."""
        hashes = common.mix(common.Rolling(common._BYTE_VALUE[data]).spans(start, end) + (end - start).astype(np.uint64)) | np.uint64(1)
        if len(self.size) > KEPT_PIECES:
            self._reset()
        out = self.known.find(hashes)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new, at = np.unique(hashes[missing], return_index=True)
            raw = data.tobytes()
            fresh = missing[at]
            numbers = np.arange(len(new), dtype=np.int32) + len(self.size)
            self._learn([raw[a:b] for a, b in zip(start[fresh].tolist(), end[fresh].tolist())])
            out[missing] = numbers[np.searchsorted(new, hashes[missing])]
            if len(self.size) < self.known.mask // 2:  # else the table starts anew with the next step
                self.known.put(new, numbers)
        return out

    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [[*e.ids, self.end_id] for e in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        return np.array([i for f in found for i in f], np.uint32), np.cumsum([0, *map(len, found)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of the texts in them.  A null text is an empty one."""
        if not self.cuts:
            return self._encode_whole(texts)
        rows = common.Texts(texts)
        data = rows.data
        if b"<|" not in data.tobytes():  # else a special token could come about
            data = common._LOWER[data]
        start, end, _ = common.word_bounds(data, rows.bounds)
        kind = _CLASS[data]
        cut = np.flatnonzero(kind[:-1] * kind[1:] == 2) + 1  # a letter or digit next to a mark
        texts_end = np.zeros(len(data) + 1, bool)
        texts_end[rows.bounds] = True
        cut = cut[~texts_end[cut]]
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
        number = self._numbers(data, start, end)
        bounds = np.searchsorted(start, rows.bounds)
        number = np.insert(number, bounds[1:], 0)  # an end id after each text
        size = self.size[number]
        done = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=done[1:])
        ids = self.flat[common.ranges(self.first[number].astype(np.int64), size.astype(np.int64))]
        return ids, done[np.concatenate([[0], bounds[1:] + np.arange(1, rows.n + 1)])]


#: Bytes of text that are encoded together.
ENCODE_BYTES = 1 << 20


def encoded(batches, path: str, end_id: int):
    """(rows, ids, offsets) for steps of a stream of Arrow batches that have a ``text`` column."""
    encoder = Encoder(path, end_id)
    for rows in common.steps(batches, size=ENCODE_BYTES):
        yield rows, *encoder.encode(rows.column("text"))
