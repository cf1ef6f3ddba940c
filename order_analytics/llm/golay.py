"""The binary Golay code of length 23: every word of 23 bits is within 3 bits of exactly one codeword.

All codewords within 4 bits of a word are its keys: one key if the nearest codeword is within 2 bits, six
if it is 3 bits away. Two words that differ in at most 2 bits share a key: the word halfway between them
has a codeword within 3 bits, and that is within 4 bits of both.
"""

from __future__ import annotations

import functools

import numpy as np

LENGTH, DATA_BITS, MOST_KEYS = 23, 12, 6
#: Fixed value: the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


@functools.lru_cache(maxsize=1)
def codewords() -> np.ndarray:
    """Multiples of the generator, by their index: the twelve bits they are the multiple of."""
    words = np.zeros(1 << DATA_BITS, np.uint32)
    index = np.arange(1 << DATA_BITS, dtype=np.uint32)
    for bit in range(DATA_BITS):
        words ^= np.where(index >> np.uint32(bit) & 1, np.uint32(GENERATOR << bit), np.uint32(0)).astype(np.uint32)
    return words


@functools.lru_cache(maxsize=1)
def _spheres() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error of least weight, and the further errors of weight 4 (0 where none).

    Words of one coset have the same errors, so the keys of a word follow from its syndrome.
    """
    bits = np.uint32(1) << np.arange(LENGTH, dtype=np.uint32)
    weight = {0: np.zeros(1, np.uint32), 1: bits}
    for size in (2, 3, 4):
        made = np.unique((weight[size - 1][:, None] | bits[None, :]).ravel())
        weight[size] = made[np.bitwise_count(made) == size]
    near = np.zeros(1 << (LENGTH - DATA_BITS), np.uint32)
    for size in (1, 2, 3):
        near[syndrome(weight[size])] = weight[size]
    further = np.zeros((len(near), MOST_KEYS - 1), np.uint32)
    far = weight[4]
    places = syndrome(far)
    order = np.argsort(places, kind="stable")
    places, far = places[order], far[order]
    rank = np.arange(len(far)) - np.searchsorted(places, places)
    further[places, rank] = far
    return near, further


def syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of each word by the generator: 0 for codewords."""
    rest = words.astype(np.uint32)
    for bit in range(LENGTH - 1, LENGTH - DATA_BITS - 1, -1):
        high = (rest >> np.uint32(bit) & np.uint32(1)).astype(bool)
        rest = np.where(high, rest ^ np.uint32(GENERATOR << (bit - (LENGTH - DATA_BITS))), rest)
    return rest


def keys(words: np.ndarray) -> np.ndarray:
    """A row of six codewords for each word; the nearest one is repeated where there are fewer."""
    near, further = _spheres()
    rest = syndrome(words)
    words = words.astype(np.uint32)
    nearest = words ^ near[rest]
    others = further[rest]
    return np.concatenate([nearest[:, None], np.where(others > 0, words[:, None] ^ others, nearest[:, None])], axis=1)
