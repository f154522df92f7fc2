"""Hashes of all words of many texts at once."""

from __future__ import annotations

import numpy as np

# ASCII letters and digits, and every byte of other scripts; letters A-Z count as a-z
_IS_WORD = np.array(
    [c >= 128 or chr(c).isalnum() for c in range(256)], np.bool_
)
# anything but ASCII white space
_IS_WHOLE = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)], np.bool_)
_EXACT = np.random.default_rng(17).integers(1, 1 << 64, 256, np.uint64)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        made.append(np.cumprod(powers))
    return made[0], made[1]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


# Scripts written without blanks, by code point: Thai and Lao, Burmese, Khmer,
# Chinese and Japanese with their marks, compatibility and full-width forms, rarer Chinese.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF),
    (0xFF00, 0xFFEF), (0x20000, 0x3FFFF),
)


def _unspaced(data: np.ndarray) -> np.ndarray:
    """Where characters of such scripts begin, and where they end, in UTF-8."""
    found = []
    for width, lead, top in ((3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
        at = np.flatnonzero((data >= lead) & (data < top))
        at = at[at + width <= len(data)]
        point = data[at].astype(np.int64) & (0x0F if width == 3 else 0x07)
        for k in range(1, width):
            point = point << 6 | data[at + k].astype(np.int64) & 0x3F
        own = np.zeros(len(at), np.bool_)
        for low, high in UNSPACED:
            own |= (point >= low) & (point <= high)
        found += [at[own], at[own] + width]
    return np.concatenate(found)


class WordHasher:
    """Hashes words; keeps the tables for it, so make one for many texts.

    Words are runs of letters and digits in any ASCII case, or with ``whole`` runs of anything
    but white space, as they are written. With ``characters`` every character of a script that is
    written without blanks is a word of its own.
    """

    def __init__(self, whole: bool = False, characters: bool = False) -> None:
        self.characters = characters
        self.powers = _powers(2 * _SEGMENT)
        self.is_word = _IS_WHOLE if whole else _IS_WORD
        self.code = _EXACT if whole else _FOLDED

    def _segment(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first bytes of the words of a piece that begins and ends between words."""
        flags = np.zeros(len(data) + 2, np.int8)
        flags[1:-1] = self.is_word[data]
        if self.characters and (data >= 0xE0).any():
            # a word begins, or the one before it ends, at each of these bytes too
            cut = np.zeros(len(data) + 1, np.bool_)
            cut[_unspaced(data)] = True
            inside, before = flags[1:] == 1, flags[:-1] == 1
            starts = np.flatnonzero(inside & (~before | cut))
            ends = np.flatnonzero(before & (~inside | cut))
        else:
            edges = np.flatnonzero(flags[1:] != flags[:-1])
            starts, ends = edges[::2], edges[1::2]
        power, inverse = self.powers
        if len(power) < len(data):
            power, inverse = _powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.code[data] * power[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * inverse[starts]), starts

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of the words of the texts, and where each text's words begin in them.

        The second array has one entry more than there are texts. Memory beyond the hashes is
        that of a megabyte of text at a time, or of the longest word.
        """
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        hashes, places, at = [], [], 0
        while at < len(data):
            end = min(at + _SEGMENT, len(data))
            if end < len(data):
                gaps = np.flatnonzero(~self.is_word[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    end += int(np.argmin(self.is_word[data[end:]])) + 1
            found, starts = self._segment(data[at:end])
            hashes.append(found)
            places.append(starts + at)
            at = end
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        return np.concatenate(hashes), np.searchsorted(np.concatenate(places), begins)
