"""Token ids of texts by way of a bounded table of their space-separated parts."""

from array import array

import numpy as np


class PartTable:
    """Maps parts to the bytes of their ids (32-bit, native order).

    Parts of a batch that are in neither generation of the table are encoded together, to
    id lists or their bytes. When the new generation would outgrow ``most`` parts it becomes
    the old one, and parts that come again are taken over from there. So a task holds at
    most twice that many and those of one batch.
    """

    def __init__(self, encode, most=300_000):
        self.encode, self.most, self.known, self.old = encode, most, {}, {}

    def bytes(self, wanted):
        """The table, which then has at least the wanted parts."""
        new = [part for part in wanted if part not in self.known]
        if len(self.known) + len(new) > self.most:
            self.old = self.known
            self.known = {part: self.old[part] for part in wanted if part in self.old}
        self.known.update((part, self.old[part]) for part in new if part in self.old)
        new = [part for part in new if part not in self.known]
        if new:
            for part, ids in zip(new, self.encode(new), strict=True):
                self.known[part] = ids if isinstance(ids, bytes) else array("i", ids).tobytes()
        return self.known

    def rows(self, split_texts):
        """An id array for each list of parts."""
        get = self.bytes(set().union(*split_texts)).__getitem__
        return [np.frombuffer(b"".join(map(get, parts)), np.int32) for parts in split_texts]


def portions(texts, characters=1 << 21):
    """Consecutive index ranges of about so many characters, one text at least."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= characters:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def list_array(arrays):
    """Arrow lists of 32-bit integers, without a Python object for each."""
    import pyarrow as pa

    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
