"""Anchors of byte windows: content-chosen places that equal windows share (for operator 5)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tradeweir.llm.words import mix

GRAM = 24
_VALUE = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@dataclass
class Anchors:
    """A run of window starts (``first`` to ``last``) of one document that have the same anchor."""

    document: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray  # of the anchor
    gram: np.ndarray  # hash of the k-gram at the anchor
    context: np.ndarray  # hash of all bytes of the windows


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each place."""
    one = _VALUE[data]
    two = (one[:-1] * _M1) ^ (one[1:] >> np.uint64(7)) * _M2 + one[1:]
    four = (two[:-2] * _M1) ^ (two[2:] >> np.uint64(9)) * _M2 + two[2:]
    eight = (four[:-4] * _M1) ^ (four[4:] >> np.uint64(11)) * _M2 + four[4:]
    sixteen = (eight[:-8] * _M1) ^ (eight[8:] >> np.uint64(13)) * _M2 + eight[8:]
    return mix((sixteen[:-8] * _M1) ^ (eight[16:] >> np.uint64(17)) * _M2 + eight[16:])


def anchors(data: np.ndarray, bounds: np.ndarray, window: int) -> Anchors:
    """Every window of the texts in ``data``, in runs of one anchor: the smallest k-gram hash, the first if equal."""
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return Anchors(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    grams = gram_hashes(data)
    low = np.uint64((1 << 24) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span = window - GRAM + 1
    step = 1
    while step * 2 <= span:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    key = np.minimum(key[: len(key) - (span - step)], key[span - step :])
    place = (key & low).astype(np.int64)
    size = np.diff(bounds)
    windows = np.maximum(size - window + 1, 0)
    begin = np.repeat(bounds[:-1] - (np.cumsum(windows) - windows), windows)
    start = np.arange(int(windows.sum())) + begin
    document = np.repeat(np.arange(len(size)), windows)
    place = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1
    first, last = start[head], start[tail]
    # Hash of any stretch from sums of byte values times powers.
    power = np.full(len(data) + 1, _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(_VALUE)[data] * power[:-1], dtype=np.uint64)))
    back = np.full(len(data) + 1, _INVERSE)
    back[0] = 1
    back = np.multiply.accumulate(back)
    context = mix((total[last + window] - total[first]) * back[first] + (last - first).astype(np.uint64))
    return Anchors(document[head], first, last, place[head], grams[place[head]], context)
