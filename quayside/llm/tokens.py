"""Byte-level BPE ids for whole texts, by the tokenizers library, with repeated word forms looked up.

A text is cut before each space that follows a visible character: there the library's own pattern
always starts a new piece, so the ids of the parts are the ids of the text.  Parts seen before come
from a fixed-size table (96 bits of two independent hashes must agree); all new parts of a group are
encoded in one call and told apart by the byte lengths of their tokens.  As the library has it, a special string in a
text is its special id; such a string has no blank, so no cut goes through it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .arrays import CODES_2, Rolling, groups, texts_of

SLOTS = 1 << 21
WIDTH = 8  # ids a slot can hold; longer parts are encoded each time

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts under one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        # one character of a byte-level token stands for one byte
        self.n_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.key = np.zeros(SLOTS, np.uint64)
        self.check = np.zeros(SLOTS, np.uint32)
        self.count = np.zeros(SLOTS, np.uint8)
        self.used = np.zeros(SLOTS, bool)
        self.ids = np.zeros((SLOTS, WIDTH), np.uint16 if size <= 1 << 16 else np.uint32)

    def one_by_one(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # no offsets
        return [np.array(e.ids, np.uint32) for e in found]

    def _encode_parts(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, apart: np.ndarray):
        """Ids of parts of a text: all ids, and for each part where they begin and how many.

        Parts marked ``apart`` must not touch another part.
        """
        flat, length, begin, at = [], np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), 0
        rest = np.flatnonzero(~apart)
        if len(rest):
            joined = b"".join([raw[s:e] for s, e in zip(starts[rest].tolist(), ends[rest].tolist())])
            ids = self.one_by_one([joined.decode("utf-8", "replace")])[0]
            stops = np.cumsum(ends[rest] - starts[rest])
            reached = np.cumsum(self.n_bytes[ids])
            cuts = np.searchsorted(reached, stops) + 1
            if cuts[-1] == len(ids) and (reached[cuts - 1] == stops).all():
                length[rest] = np.diff(cuts, prepend=0)
                begin[rest] = cuts - length[rest]
                flat.append(ids)
                at = len(ids)
            else:  # not valid UTF-8
                apart = np.ones(len(starts), bool)
        alone = np.flatnonzero(apart)
        if len(alone):
            found = self.one_by_one(
                [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[alone].tolist(), ends[alone].tolist())]
            )
            length[alone] = np.fromiter(map(len, found), np.int64, len(found))
            begin[alone] = at + np.cumsum(length[alone]) - length[alone]
            flat += found
        return np.concatenate(flat), begin, length

    def _keep(self, slot, key, check, flat, begin, length) -> None:
        """Store new parts; a slot used since it was last asked for keeps its part once more."""
        fits = np.flatnonzero((length > 0) & (length <= WIDTH))
        used = self.used[slot[fits]]
        self.used[slot[fits]] = False
        fits = fits[~used]
        if len(fits):
            at = slot[fits]
            column = np.arange(WIDTH)
            rows = flat[np.minimum(begin[fits][:, None] + column, len(flat) - 1)]
            self.key[at], self.check[at], self.count[at], self.ids[at] = key[fits], check[fits], length[fits], rows

    def group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts one after another, and the number of ids up to each text's start."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(n + 1, bool)
        cut[1:n] = (data[1:] == 0x20) & _VISIBLE[data[:-1]]
        cut[2:n] |= (data[2:] == 0x20) & (data[1:-1] >= 0x80) & (data[:-2] == 0xC3)
        # first and last parts of a text have other neighbours in the library's eyes
        at_edge = np.zeros(n + 1, bool)
        at_edge[offsets] = True
        cut |= at_edge
        bounds = np.flatnonzero(cut)
        starts, ends = bounds[:-1], bounds[1:]
        apart = at_edge[starts] | at_edge[ends]
        key = Rolling(data).spans(starts, ends)
        check = (Rolling(data, CODES_2).spans(starts, ends) >> np.uint64(32)).astype(np.uint32)
        slot = (key & np.uint64(SLOTS - 1)).astype(np.int64)
        known = (self.key[slot] == key) & (self.check[slot] == check)
        counts = np.where(known, self.count[slot], 0).astype(np.int64)
        self.used[slot[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            order = new[np.lexsort((apart[new], check[new], key[new]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (
                (key[order[1:]] != key[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
                | (apart[order[1:]] != apart[order[:-1]])
            )
            first, which = order[fresh], np.cumsum(fresh) - 1
            flat, begin, length = self._encode_parts(data.tobytes(), starts[first], ends[first], apart[first])
            counts[order] = length[which]
            self._keep(slot[first], key[first], check[first], flat, begin, length)
        before = np.cumsum(counts) - counts
        total = int(counts.sum())
        out = np.zeros(total, np.uint32)
        if len(new):
            many = counts[order]
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            out[np.repeat(before[order], many) + step] = flat[np.repeat(begin[which], many) + step]
            # what was known is read as it was, before new parts were stored: their slots were in use
        hit = np.flatnonzero(known)
        if len(hit):
            many = counts[hit]
            earlier = np.cumsum(many) - many
            step = np.arange(many.sum())
            kept = self.ids.reshape(-1)[np.repeat(slot[hit] * WIDTH - earlier, many) + step]
            out[np.repeat(before[hit] - earlier, many) + step] = kept
        return out, np.append(before, total)[np.searchsorted(starts, offsets)]

    def column(self, column):
        """For runs of rows of a string column: first row, ids, and where each row's ids begin."""
        data, offsets = texts_of(column)
        for i, j in groups(offsets):
            base = offsets[i]
            ids, begin = self.group(data[base : offsets[j]], offsets[i : j + 1] - base)
            yield i, ids, begin

    def decode(self, ids) -> str:
        return self.tokenizer.decode(list(map(int, ids)), skip_special_tokens=False)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path)
