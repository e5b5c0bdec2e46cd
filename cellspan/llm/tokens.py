"""Whole-text token ids through the tokenizers library.

A byte-level vocabulary with its usual splitting rule never joins certain neighbours: a visible character and the
single space or line end after it, or a Latin letter and the mark after it. So texts are cut there, by numpy over
their UTF-8 bytes, and the pieces encode to the same ids as the whole. Arrow numbers the distinct pieces of a slice of
texts, only those are looked up, and the library is asked only for pieces that the worker has not met lately. A
vocabulary with any other splitting rule is given whole texts.
"""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa

# Pieces that a worker remembers, about 150 bytes each, in two generations of half as many: when the younger is full
# it becomes the older, whose pieces stay only if they are met again.
CACHE_PIECES = 700_000
# Longer pieces are encoded each time.
CACHE_CHARS = 48

# Fixed value: how byte-level vocabularies write a space.
_SPACE = "Ġ"
# Marks that never join the letter before them (an apostrophe may), and white space beyond ASCII.
_MARKS = b"!#$%&)*,.:;?|"
_WIDE_SPACES = "\u0085                 　"
_ASCII_SPACES = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
# Stands between texts: white space, so that no cut is made at a text's own end.
_GAP = b"   "
_BLANK = re.compile(r"\s")
_ENCODERS: dict[str, "TextEncoder"] = {}


def _byte_set(octets: bytes) -> np.ndarray:
    """A truth value per byte."""
    flags = np.zeros(256, dtype=bool)
    flags[list(octets)] = True
    return flags


_IS_SPACE = _byte_set(_ASCII_SPACES)
_IS_MARK = _byte_set(_MARKS)
_IS_LETTER = _byte_set(bytes(x for x in range(128) if chr(x).isalpha()))
_WIDE_CODES = np.array([int.from_bytes(c.encode(), "big") for c in _WIDE_SPACES])


def byte_bpe_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _wide_space(b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether white space of two or three bytes begins at these places; three bytes follow each."""
    pair = b[first].astype(np.int64) << 8 | b[first + 1]
    return np.isin(pair, _WIDE_CODES) | np.isin(pair << 8 | b[first + 2], _WIDE_CODES)


def _after_letter(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before these places is an ASCII letter or one of U+00C0 to U+024F, all letters but two."""
    last, lead = b[at - 1], b[at - 2]
    latin = (lead >= 0xC3) & (lead <= 0xC9) & (last >= 0x80) & ~((lead == 0xC9) & (last >= 0x90))
    return _IS_LETTER[last] | latin & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))


def piece_bounds(b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Ascending byte places of all cuts, with ``edges`` (the texts' own ends) and both ends of ``b``.

    ``b`` begins and ends with white space of three bytes, as any two texts have between them.
    """
    cut = np.zeros(len(b) + 1, dtype=bool)
    cut[edges] = True
    cut[[0, len(b)]] = True
    at = np.flatnonzero((b == 0x20) | (b == 0x0A))
    at = at[(at > 2) & (at < len(b) - 3)]
    at = at[~(_IS_SPACE[b[at - 1]] | _IS_SPACE[b[at + 1]])]
    before, after = b[at - 1] >= 0x80, b[at + 1] >= 0x80
    wide = np.zeros(len(at), dtype=bool)
    wide[after] = _wide_space(b, at[after] + 1)
    # white space of three bytes begins three places back, of two bytes two: its third byte is then the place itself
    wide[before] |= _wide_space(b, at[before] - 3) | np.isin(b[at[before] - 2].astype(np.int64) << 8 | b[at[before] - 1], _WIDE_CODES)
    at = at[~wide]
    cut[at] = True
    cut[at[b[at] == 0x0A] + 1] = True
    at = np.flatnonzero(_IS_MARK[b])
    cut[at[_after_letter(b, at)]] = True
    return np.flatnonzero(cut)


def _splits_as_known(path: str) -> bool:
    """Whether a vocabulary file splits texts by the byte-level rule that the cuts rely on."""
    known = json.loads(Path(path).read_text(encoding="utf-8"))
    rule = known.get("pre_tokenizer") or {}
    return (
        rule.get("type") == "ByteLevel"
        and rule.get("use_regex", True)
        and not rule.get("add_prefix_space")
        and known.get("normalizer") is None
        and all(t.get("special") for t in known.get("added_tokens") or [])
    )


class TextEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; strings of special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        self._cuts = _splits_as_known(path)
        vocabulary = self._library.get_vocab()
        self._opens = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self._opens[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True
        line_end = self._library.encode("\n", add_special_tokens=False).ids
        self._line_end = line_end[0] if len(line_end) == 1 else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Each text on its own."""
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def _joined_ids(self, pieces: list[str], *, spaced: bool) -> list[bytes]:
        """Ids of pieces without white space, but for one space before each if ``spaced``, encoded together and parted
        again: a space opens the first token of its piece, a line end put between the others is a token of its own.
        """
        out: list[bytes] = []
        for at in range(0, len(pieces), 4096):
            block = pieces[at : at + 4096]
            text = ("" if spaced else "\n").join(block)
            ids = np.array(self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self._opens[ids] if spaced else ids == self._line_end)
            if len(starts) != len(block) - (not spaced):
                raise ValueError("this vocabulary joins white space to the word before it")
            octets = ids.tobytes()
            ends = [*(4 * starts[spaced:]).tolist(), len(octets)]
            firsts = (4 * starts).tolist() if spaced else [0, *(4 * starts + 4).tolist()]
            out += [octets[i:j] for i, j in zip(firsts, ends, strict=True)]
        return out

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self._young) > CACHE_PIECES // 2:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        missing = [p for p in pieces if p not in young]
        spaced, bare, alone = [], [], []
        for p in missing:
            if p in old:
                young[p] = old[p]
            elif p[0] == " " and len(p) > 1 and not _BLANK.search(p, 1):
                spaced.append(p)
            elif self._line_end is not None and not _BLANK.search(p):
                bare.append(p)
            else:
                alone.append(p)
        young.update(zip(spaced, self._joined_ids(spaced, spaced=True), strict=True))
        young.update(zip(bare, self._joined_ids(bare, spaced=False), strict=True))
        young.update(zip(alone, self._ids(alone), strict=True))
        found = [young[p] for p in pieces]
        for p in missing:
            if len(p) > CACHE_CHARS:
                del young[p]
        return found

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; all texts together are below 2 GB, as one slice of a batch is."""
        if not self._cuts:
            return self._ids(texts)
        octets = [t.encode() for t in texts]
        data = b"".join([_GAP, _GAP.join(octets), _GAP])
        sizes = np.fromiter(map(len, octets), np.int64, len(octets))
        ends = np.cumsum(sizes + len(_GAP))
        firsts = ends - sizes
        bounds = piece_bounds(np.frombuffer(data, dtype=np.uint8), np.concatenate([firsts, ends]))
        pieces = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        which = pieces.indices.to_numpy()
        known = self._look_up(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        counts = np.fromiter(map(len, known), np.int64, len(known)) // 4
        opened = np.cumsum(counts) - counts
        per_piece = counts[which]
        place = np.concatenate([[0], np.cumsum(per_piece)])
        ids = flat[np.repeat(opened[which] - place[:-1], per_piece) + np.arange(place[-1])].tobytes()
        lows = 4 * place[np.searchsorted(bounds, firsts)]
        highs = 4 * place[np.searchsorted(bounds, ends)]
        return [ids[i:j] for i, j in zip(lows.tolist(), highs.tolist(), strict=True)]


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for one vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
