"""Sorted arrays of 64-bit hashes in the shared folder, which workers map into memory.

A table is cut into ``2 ** bits`` shards by the top bits of the hash, so that the shards in
a row are one sorted array. Each shard is a file of keys and a file per field. Files are
written by tasks under another name first and then put in place, so a repeated task
replaces its own file. Where the folder can't be mapped (an object store), a worker reads
the shards it needs instead.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs

from brooklog.llm.blocks import mix

_BACK = tuple(np.uint64(pow(c, -1, 1 << 64)) for c in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD))


def unmix(h: np.ndarray) -> np.ndarray:
    """The value that ``mix`` made ``h`` of."""
    for factor in _BACK:
        h = (h ^ (h >> np.uint64(33))) * factor
    return h ^ (h >> np.uint64(33))


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash for two 32-bit numbers; ``unmix`` gives them back."""
    both = a.astype(np.uint64)
    both <<= np.uint64(32)
    both |= b
    return mix(both)


def _local(path: str) -> str | None:
    at = urlparse(path)
    if at.scheme == "file":
        return unquote(at.path)
    return None if at.scheme else path


def put(folder: str, name: str, values: np.ndarray) -> None:
    """Write one array."""
    path, own = f"{folder}/{name}", f"{folder}/_{uuid.uuid4().hex}"
    place = _local(folder)
    if place is not None:
        os.makedirs(place, exist_ok=True)
        values.tofile(_local(own))
        os.replace(_local(own), _local(path))
        return
    store, target = fs.FileSystem.from_uri(path)
    _, draft = fs.FileSystem.from_uri(own)
    store.create_dir(os.path.dirname(target), recursive=True)
    with store.open_output_stream(draft) as out:
        out.write(values.tobytes())
    store.move(draft, target)


def mapped(folder: str, name: str, kind) -> np.ndarray:
    """The array that ``put`` wrote; empty if there is none."""
    place = _local(f"{folder}/{name}")
    if place is not None:
        if not os.path.exists(place) or os.path.getsize(place) == 0:
            return np.zeros(0, kind)
        return np.memmap(place, kind, "r")
    store, target = fs.FileSystem.from_uri(f"{folder}/{name}")
    if store.get_file_info(target).type != fs.FileType.File:
        return np.zeros(0, kind)
    with store.open_input_file(target) as source:
        return np.frombuffer(source.read(), kind)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def by_shard(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(shard, slice) of sorted keys."""
    shards = shard_of(keys, bits)
    heads = np.flatnonzero(np.diff(shards, prepend=-1))
    for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), len(keys)]):
        yield int(shards[begin]), slice(begin, end)


def heads_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if len(sorted_keys) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def order_of(keys: np.ndarray) -> np.ndarray:
    """An order that sorts 64-bit keys.

    Their upper bits are sorted with the places in the lower ones, which takes half the time of
    ``argsort``; keys that only differ in the bits left out are put in order after that.
    """
    low = np.uint64(max(len(keys) - 1, 1).bit_length())
    places = np.arange(len(keys), dtype=np.uint64)
    whole = int(keys.max(initial=0)).bit_length() + int(low) <= 64
    packed = ((keys if whole else keys >> low) << low) | places
    packed.sort()
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    found = keys[order]
    if not whole and (found[1:] < found[:-1]).any():
        order = order[np.argsort(found, kind="stable")]
    return order


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place where each stands, and for all keys which it is."""
    order = order_of(keys)
    heads = heads_of(keys[order])
    back = np.empty(len(keys), np.int64)
    back[order] = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(keys)))
    return keys[order[heads]], order[heads], back


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, and the sums of each of ``values`` over equal keys."""
    order = order_of(keys)
    keys = keys[order]
    heads = heads_of(keys)
    return keys[heads], *[
        np.add.reduceat(v[order], heads) if len(heads) else v for v in values
    ]


#: Counts from here on are listed by key instead of standing in their byte.
_LARGE = 255


def put_counts(folder: str, shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
    """A shard of a table of counts, of a byte each but for the few large ones."""
    large = counts >= _LARGE
    put(folder, f"key-{shard}", keys)
    put(folder, f"count-{shard}", np.minimum(counts, _LARGE).astype(np.uint8))
    put(folder, f"large-key-{shard}", keys[large])
    put(folder, f"large-count-{shard}", counts[large].astype(np.uint64))


class Maps:
    """The arrays of one folder, each mapped once while this object lives."""

    def __init__(self, folder: str):
        self.folder = folder
        self._open: dict[str, np.ndarray] = {}

    def array(self, name: str, kind) -> np.ndarray:
        if name not in self._open:
            self._open[name] = mapped(self.folder, name, kind)
        return self._open[name]

    def places(self, shard: int, keys: np.ndarray, prefix: str = "key"):
        """Where each sorted key stands in the shard, and whether it is there."""
        own = self.array(f"{prefix}-{shard}", np.uint64)
        if len(own) == 0:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        return at, own[at] == keys

    def counts(self, keys: np.ndarray, bits: int) -> np.ndarray:
        """Counts of sorted keys, 0 for those the table lacks."""
        out = np.zeros(len(keys))
        for shard, part in by_shard(keys, bits):
            at, there = self.places(shard, keys[part])
            small = self.array(f"count-{shard}", np.uint8)
            found = np.where(there, small[at], 0).astype(np.float64) if len(small) else out[part]
            if (big := found == _LARGE).any():
                at, _ = self.places(shard, keys[part][big], "large-key")
                found[big] = self.array(f"large-count-{shard}", np.uint64)[at]
            out[part] = found
        return out

    def fields(self, keys: np.ndarray, ranks: np.ndarray, bits: int, *names: str):
        """Float fields of sorted keys, 0 for those the table lacks; ``ranks`` tell the shards."""
        out = [np.zeros(len(keys)) for _ in names]
        for shard, part in by_shard(ranks, bits):
            at, there = self.places(shard, keys[part])
            for values, name in zip(out, names):
                own = self.array(f"{name}-{shard}", np.float64)
                if len(own):
                    values[part] = np.where(there, own[at], 0.0)
        return out
