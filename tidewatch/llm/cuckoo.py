"""A cuckoo filter over 128-bit digests, kept as bytes so that it fits into a table."""

import numpy as np

SLOTS = 4
KICKS = 500
# Keys per slot at which a filter is built anew with twice the room.
FULL = 0.85


class Full(Exception):
    """No room was found for a key."""


def room_for(keys: int) -> int:
    """Buckets, a power of two, that hold ``keys`` at half the allowed load or a little more."""
    wanted = max(1, int(keys / FULL / SLOTS) + 1)
    return 1 << (wanted - 1).bit_length()


class CuckooFilter:
    """Two buckets of four 16-bit tags per key. No false negatives among keys that were added;
    about one in 8,000 other keys is said to be there. Tags can be removed again, and keys with
    the same tag and buckets are held as often as they were added."""

    def __init__(self, buckets: int, data: bytes | None = None):
        if data is None:
            self.slots = np.zeros((buckets, SLOTS), dtype=np.uint16)
        else:
            self.slots = np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy()
        self.mask = len(self.slots) - 1

    @classmethod
    def of(cls, digests: np.ndarray) -> "CuckooFilter":
        buckets = room_for(len(digests))
        while True:
            try:
                found = cls(buckets)
                found.add(digests)
                return found
            except Full:
                buckets *= 2

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.slots))

    def has_room(self, more: int) -> bool:
        return len(self) + more <= FULL * self.slots.size

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tag, first and second bucket; ``digests`` is an array of n x 2 unsigned longs."""
        tags = ((digests[:, 0] >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.int64)
        first = (digests[:, 1] & np.uint64(self.mask)).astype(np.int64)
        return tags, first, self._other(first, tags)

    def _other(self, bucket, tag):
        return bucket ^ (tag * 0x5BD1E995 >> 7 & self.mask)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        tags, first, second = self._places(digests)
        tags = tags[:, None].astype(np.uint16)
        return (self.slots[first] == tags).any(1) | (self.slots[second] == tags).any(1)

    def add(self, digests: np.ndarray) -> None:
        """Keys find a free slot of either bucket all at once; what is left pushes others out."""
        tags, first, second = self._places(digests)
        left = np.arange(len(tags))
        for places in (first, second):
            order = left[np.argsort(places[left], kind="stable")]
            bucket = places[order]
            start = np.r_[True, bucket[1:] != bucket[:-1]] if len(order) else np.zeros(0, bool)
            turn = np.arange(len(order)) - np.maximum.accumulate(
                np.where(start, np.arange(len(order)), 0)
            )
            free = self.slots[bucket] == 0
            fits = turn < free.sum(axis=1)
            at = np.argsort(~free[fits], axis=1, kind="stable")[np.arange(fits.sum()), turn[fits]]
            self.slots[bucket[fits], at] = tags[order[fits]]
            left = order[~fits]
        for n in left.tolist():
            self._push(int(tags[n]), int(second[n]))

    def _push(self, tag: int, bucket: int) -> None:
        for kick in range(KICKS):
            row = self.slots[bucket]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = tag
                return
            out = kick % SLOTS
            tag, row[out] = int(row[out]), tag
            bucket = self._other(bucket, tag)
        raise Full

    def remove(self, digests: np.ndarray) -> None:
        """Take out one tag per key; the keys must have been added."""
        for tag, *buckets in zip(*(side.tolist() for side in self._places(digests))):
            for bucket in buckets:
                held = np.flatnonzero(self.slots[bucket] == tag)
                if len(held):
                    self.slots[bucket, held[0]] = 0
                    break
