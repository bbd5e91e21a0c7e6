"""Ids of many texts: pieces that recur are encoded once for each worker."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from tokenizers import normalizers

from regiolume.llm.bytes_view import as_bytes, slices

#: Bytes of text that are cut into pieces at once, and bounds of what a worker remembers.
SLICE_BYTES = 4 << 20
KNOWN_PIECES, KNOWN_BYTES = 500_000, 64 << 20

# Kinds of bytes: 1 blank, 2 letter or digit, 3 mark, 4 beyond ASCII, 5 bar, 0 others. A bar may stand inside a special
# token, but no blank does.
_BLANK, _WORD, _MARK, _HIGH, _BAR = 1, 2, 3, 4, 5


def _kind(b: int) -> int:
    if b == 32 or 9 <= b <= 13:
        return _BLANK
    if b >= 128:
        return _HIGH
    if b == ord("|"):
        return _BAR
    return _WORD if chr(b).isalnum() else _MARK if 33 <= b <= 126 else 0


_KIND = np.array([_kind(b) for b in range(256)], np.uint8)
_CUT = np.zeros((8, 8), bool)
for _pair in ((_WORD, _BLANK), (_MARK, _BLANK), (_BAR, _BLANK), (_WORD, _MARK)):
    _CUT[_pair] = True
_CUT = _CUT.ravel()


def cut_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a piece begins: every row, a blank behind something visible, a mark behind a letter or digit.

    No token of the supported tokenizers reaches over such a place, and none depends on what stands beyond it. Behind bytes
    beyond ASCII only those are cut that end a letter of the Latin-1 block; others may be white space.
    """
    kind = _KIND[data]
    pair = kind.copy()
    pair[1:] |= kind[:-1] << 3
    cut = _CUT[pair]
    high = np.flatnonzero((pair == (_HIGH << 3 | _BLANK)) | (pair == (_HIGH << 3 | _MARK)))
    high = high[high > 1]
    last, lead = data[high - 1], data[high - 2]
    cut[high[(lead == 0xC3) & (last != 0x97) & (last != 0xB7)]] = True
    first = offsets[:-1]
    cut[first[offsets[1:] > first]] = True
    return np.flatnonzero(cut)


def _mark(tokenizer: tokenizers.Tokenizer) -> tuple[str, int] | None:
    """A special token that parts texts wherever it stands, and its id."""
    if tokenizer.truncation or tokenizer.padding:
        return None
    added = tokenizer.get_added_tokens_decoder().items()
    plain = lambda t: t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)
    return next(((t.content, i) for i, t in added if plain(t)), None)


def _short_normalizer(tokenizer: tokenizers.Tokenizer) -> normalizers.Normalizer | None:
    """The normalizer without the steps that change nothing in ASCII text without capitals. None if there is no such step, or
    one that might make other text."""
    if tokenizer.normalizer is None:
        return None
    steps = json.loads(tokenizer.normalizer.__getstate__())
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    kept = [s for s in steps if s["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase")]
    if len(kept) == len(steps) or any(s["type"] != "Replace" or not s["content"].isascii() for s in kept):
        return None
    if any(s["content"] != s["content"].lower() for s in kept):
        return None
    pattern = lambda p: tokenizers.Regex(p["Regex"]) if "Regex" in p else p["String"]
    return normalizers.Sequence([normalizers.Replace(pattern(s["pattern"]), s["content"]) for s in kept])


def _taken(at: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of the places' ids begin, with the end of all, and these ids; ``at`` is where those of all places do."""
    found = pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids)).take(pa.array(places))
    return found.offsets.to_numpy(), found.values.to_numpy()


class PieceCoder:
    """Encodes texts piece by piece with a tokenizer of the ``tokenizers`` library; equal pieces, compared byte by byte,
    are encoded once.

    For tokenizers whose tokens never reach from something visible into white space, nor from a letter or digit into a
    mark: byte-level and word-end BPE with the usual patterns. When too much is known, pieces that no later slice has had
    are forgotten, and all if half of the room is not free then.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.mark = _mark(self.tokenizer)
        self.normalizer, self.short = self.tokenizer.normalizer, _short_normalizer(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.at, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)
        self.again = np.empty(0, bool)

    def _forget_rare(self) -> None:
        """Keep the pieces that came again."""
        kept = self.again
        if kept.sum() > KNOWN_PIECES // 2:
            self.forget()
            return
        sizes = np.diff(self.at)
        self.known, self.ids = self.known.filter(pa.array(kept)), self.ids[np.repeat(kept, sizes)]
        self.at = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes[kept])])
        self.again = np.zeros(len(self.known), bool)
        if self.known.nbytes > KNOWN_BYTES // 2:
            self.forget()

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of different pieces stand."""
        found = pc.index_in(pieces, value_set=self.known)
        self.again[found.drop_null().to_numpy()] = True
        if found.null_count and len(self.known) + found.null_count > KNOWN_PIECES or self.known.nbytes > KNOWN_BYTES:
            self._forget_rare()
            found = pc.index_in(pieces, value_set=self.known)
        if found.null_count:
            new = pieces.filter(found.is_null())
            sizes, ids = self._encoded(new.cast(pa.string()))
            places = pa.array(np.arange(len(self.known), len(self.known) + len(new)), pa.int32())
            found = pc.replace_with_mask(found, found.is_null(), places)
            self.known = pa.concat_arrays([self.known, new])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        return found.to_numpy()

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids. Pieces that most steps of the normalizer leave as they are go without these, which cost a third
        of the tokenizer's time."""
        if self.short is None:
            return self._in_parts(pieces)
        short = pc.and_(pc.string_is_ascii(pieces), pc.equal(pc.ascii_lower(pieces), pieces))
        other, other_ids = self._in_parts(pieces.filter(pc.invert(short)))
        self.tokenizer.normalizer = self.short
        try:
            sizes, ids = self._in_parts(pieces.filter(short))
        finally:
            self.tokenizer.normalizer = self.normalizer
        order = np.argsort(~short.to_numpy(zero_copy_only=False), kind="stable")  # as they were encoded, short ones first
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate([sizes, other]))])
        return np.concatenate([sizes, other])[back], _taken(ends, np.concatenate([ids, other_ids]), back)[1]

    def _in_parts(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Some pieces at a time: what the tokenizer gives back for one is large."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int32))]
        for at in range(0, len(pieces), 16_384):
            part = pieces.slice(at, 16_384)
            found.append(self._joined(part) or self._apart(part))
        sizes, ids = zip(*found, strict=True)
        return np.concatenate(sizes), np.concatenate(ids)

    def _joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Many pieces in one text, parted by a special token that the tokenizer never looks across: one result for each
        text costs less than one for each piece. None where that token does not come back once for each piece."""
        if self.mark is None or pc.any(pc.match_substring(pieces, self.mark[0])).as_py():
            return None
        text, mark = self.mark
        ends = np.append(np.arange(0, len(pieces), 256), len(pieces)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pieces), text).to_pylist()
        codes = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array([*e.ids, mark], np.int32) for e in codes])
        at = np.flatnonzero(ids == mark)
        return (np.diff(at, prepend=-1) - 1, ids[ids != mark]) if len(at) == len(pieces) else None

    def _apart(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        codes = [e.ids for e in self.tokenizer.encode_batch_fast(pieces.to_pylist(), add_special_tokens=False)]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        return sizes, np.fromiter(chain.from_iterable(codes), np.int32, int(sizes.sum()))

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of every piece's ids, and how many pieces each row has."""
        cuts = cut_points(data, offsets)
        ends = np.append(cuts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        return self._places(coded.dictionary)[coded.indices.to_numpy()], np.diff(np.searchsorted(cuts, offsets))

    def lengths(self, column: pa.Array) -> np.ndarray:
        """How many ids each row has; NULL has none."""
        out = [np.empty(0, np.int64)]
        for _, data, offsets in slices(*as_bytes(column), SLICE_BYTES):
            piece, per_row = self._pieces(data, offsets)
            upto = np.concatenate([[0], np.cumsum((self.at[1:] - self.at[:-1])[piece])])
            out.append(np.diff(upto[np.concatenate([[0], np.cumsum(per_row)])]))
        pa.default_memory_pool().release_unused()  # else a worker keeps some hundred MB that it no longer needs
        return np.concatenate(out)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For slices of rows: first row, all ids one after another, and how many each row has."""
        for first, data, offsets in slices(*as_bytes(column), SLICE_BYTES):
            piece, per_row = self._pieces(data, offsets)
            total, ids = _taken(self.at, self.ids, piece)
            yield first, ids, np.diff(total[np.concatenate([[0], np.cumsum(per_row)])])
        pa.default_memory_pool().release_unused()


_CODERS: dict[str, PieceCoder] = {}


def piece_coder(path: str) -> PieceCoder:
    """The coder of a vocabulary file, read once for each worker."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]
