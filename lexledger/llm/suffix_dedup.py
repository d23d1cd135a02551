"""Suffix-array dedup of bytes by external induced sorting.

Shards. Every window of ``window`` bytes has one *anchor*, the least of its 192-byte hashes (the leftmost, if equal), so
equal windows have equal anchors at equal places. Neighbouring windows of one anchor form a segment. Segments whose
anchor occurs once only can't repeat and stay home; the others go to the shard of their anchor, each distinct segment
once from each chunk, with a mark if the chunk has it twice. Equal windows therefore meet in one shard, and a passage
that a third of the corpus shares arrives once from each chunk. An anchor whose segments have more than PART bytes
together is *hot* (a shared passage amid ever different surroundings): its segments are not sorted, but the 62-bit hash
of each of their windows goes, once from each chunk, to one of all buckets, so a hot anchor spreads over all of them.

Passages, only if asked for. A repeat shorter than ``window`` isn't removed, but can be reported: n_shared counts a text's bytes inside strings of
PASSAGE_GRAM bytes that occur elsewhere too, out of a sample that has one of every PASSAGE - PASSAGE_GRAM + 1 neighbouring
ones, the least by hash. A passage of PASSAGE bytes that repeats is therefore always seen, whatever surrounds it.

In a shard the suffixes of all segments are sorted by induction. S*-substrings are named by sorting, the reduced string
of names is sorted to the depth that ``window`` bytes need, and bucket queues carry (suffix, common prefix with the
suffix before) tuples: left to right for L-suffixes, then right to left for S-suffixes. The prefix of an induced suffix
is one more than the least prefix passed since the last suffix induced into that bucket. Prefixes of S*-suffixes come
from binary search on 64-bit hashes, not from recursion. A shard is sorted in parts of at most PART suffixes, each
in memory; the queues would go on to a file in the shared folder beyond QUEUE_BYTES, which such parts never reach. Window starts whose common prefix with a neighbouring window start
reaches ``window`` repeat; each chunk learns which windows of its segments do.

Defined results: null text is empty; texts shorter than the window lose nothing; repeated rows are separate texts; a
kept text may end in the middle of a character where a repeat did, so it is binary; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import CHAR_POWERS, U64, _BYTE, cover, flat, mix, pieces, runs

GRAM = 192
#: Bytes of a shared passage that is always seen, and of the sampled strings in it. Over 50 words have 300 bytes or more.
PASSAGE, PASSAGE_GRAM = 300, 240
PIECE = 1 << 18
PART = 1 << 20
#: Text bytes of input for each shard.
SHARD_BYTES = 4 << 20
#: Queue memory of one shard before blocks go to disk.
QUEUE_BYTES = 96 << 20


# ---- anchors and segments -------------------------------------------------------------------------------------------


def _slide_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` consecutive values, from prefix and suffix minima of blocks."""
    n = len(x) - size + 1
    pad = -len(x) % size
    y = np.concatenate((x, np.full(pad, np.iinfo(U64).max, U64))).reshape(-1, size)
    head = np.minimum.accumulate(y, 1).ravel()
    tail = np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[size - 1 : size - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, window: int, gram_bytes: int = GRAM):
    """Over pieces: (anchor keys, segment keys, starts, ends, places of the anchors) of all segments, as places in ``data``.

    A segment [start, end) holds the windows that start in [start, end - window]."""
    bounds = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        while b - a >= window:
            e = min(b, a + PIECE + window - 1)
            if bounds and e - bounds[-1][0][0] <= PIECE + window:  # skipped short texts between count too
                bounds[-1].append((a, e))
            else:
                bounds.append([(a, e)])
            if e == b:
                break
            a = e - window + 1
    for group in bounds:
        lo, hi = group[0][0], group[-1][1]
        part = data[lo:hi]
        n = len(part)
        assert n < 1 << 20, "places have 20 bits"
        up, down = CHAR_POWERS.get(n + 1)
        total = np.zeros(n + 1, U64)
        np.cumsum(_BYTE[part] * up[:n], out=total[1:])
        gram = mix((total[gram_bytes:] - total[:-gram_bytes]) * down[: n - gram_bytes + 1])
        mask = U64((1 << 20) - 1)
        least = _slide_min((gram & ~mask) | np.arange(len(gram), dtype=U64), window - gram_bytes + 1)
        valid = np.zeros(n - window + 2, bool)
        for a, e in group:
            valid[a - lo : e - lo - window + 1] = True
        at = np.flatnonzero(valid[:-1])
        anchor = (least[at] & mask).astype(np.int64)
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))
        for a, _ in group:
            new[np.searchsorted(at, a - lo)] = True
        head = np.flatnonzero(new)
        start, end = at[head], at[np.append(head[1:], len(at)) - 1] + window
        key = mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))
        # Anchors are least hashes, so they crowd at the low end; mixed again, they spread over all shards.
        yield mix(gram[anchor[head]] + U64(1)) >> U64(2), key >> U64(2), start + lo, end + lo, anchor[head] + lo


def _of_chunk(table: pa.Table, window: int, gram_bytes: int = GRAM):
    data, offsets = flat(table["body"])
    got = list(segments(data, offsets, window, gram_bytes))
    cols = [np.concatenate([g[i] for g in got]) if got else np.zeros(0, U64 if i < 2 else np.int64) for i in range(5)]
    return data, offsets, *cols


def _passages(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of the sampled strings of PASSAGE_GRAM bytes."""
    _, _, key, _, _, _, place = _of_chunk(table, PASSAGE, PASSAGE_GRAM)
    return key, place


def _anchors(buckets: int, window: int, passages: bool = False):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        _, _, anchor, key, start, end, _ = _of_chunk(table, window)
        keys, flags = X.distinct(anchor << U64(1) | U64(1))
        first = np.unique(key, return_index=True)[1]
        size = np.bincount(np.searchsorted(keys, anchor[first]), (end - start)[first], len(keys)).astype(U64)
        own = X.send(chunk, buckets, 62, keys, flags, size)
        if not passages:
            return own
        sampled = X.send(chunk, buckets, 62, *X.distinct(_passages(table)[0] << U64(1) | U64(1)))
        sampled = sampled.set_column(0, "bucket", pc.add(sampled["bucket"], pa.scalar(buckets, pa.int32())))
        return pa.concat_tables([own, sampled])

    return run


def _shared_anchors(buckets: int):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        """A bucket's reply: the anchors that occur twice at least, each with whether it is hot; or sampled strings."""
        if table["bucket"][0].as_py() >= buckets:
            return X.repeated(table)
        got = [X.unpack(p, np.uint8, U64) for p in table["payload"].to_pylist()]
        keys, at, times = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True, return_counts=True)
        flags, size = (np.concatenate([g[i] for g in got]) for i in (1, 2))
        shared = (times > 1) | (np.bincount(at, flags & 2) > 0)
        hot = np.bincount(at, size.astype(np.float64)) > PART
        out = []
        for b, c, k in zip(table["bucket"].to_pylist(), table["chunk"].to_pylist(), (g[0] for g in got)):
            place = np.searchsorted(keys, k)
            own = shared[place]
            if own.any():
                out.append((b, c, X.pack(k[own], hot[place[own]].astype(np.uint8))))
        return X.messages(*zip(*out)) if out else X.messages([], [], [])

    return run


def _windows(data: np.ndarray, start: np.ndarray, end: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(62-bit keys of all windows of the segments, their places in ``data``)."""
    keys, places = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for a, b in pieces(np.concatenate(([0], np.cumsum(end - start)))):
        size = (end - start)[a:b]
        off = np.concatenate(([0], np.cumsum(size)))
        place = np.arange(off[-1]) + np.repeat(start[a:b] - off[:-1], size)
        up, down = CHAR_POWERS.get(len(place) + 1)
        total = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTE[data[place]] * up[: len(place)])))
        at = np.flatnonzero(np.arange(len(place)) + window <= np.repeat(off[1:], size))
        keys.append(mix((total[at + window] - total[at]) * down[at] + U64(window)) >> U64(2))
        places.append(place[at])
    return np.concatenate(keys), np.concatenate(places)


def _send_segments(buckets: int, window: int):
    @X.tidy
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows or not table.num_rows:
            return X.messages([], [], [])
        passages = X.keys_of(answers.filter(pc.greater_equal(answers["bucket"], buckets)))
        got = [(np.zeros(0, U64), np.zeros(0, np.uint8))] + [X.unpack(p, np.uint8) for p in answers.filter(pc.less(answers["bucket"], buckets))["payload"].to_pylist()]
        shared, hot = (np.sort(np.concatenate([k[h == i] for k, h in got])) for i in (0, 1))
        data, _, anchor, key, start, end, _ = _of_chunk(table, window)
        keep = np.flatnonzero(X.member(anchor, shared))
        _, first, count = np.unique(key[keep], return_index=True, return_counts=True)
        own = keep[first]
        order = np.argsort(anchor[own], kind="stable")
        own, many = own[order], (count[order] > 1).astype(np.uint8)
        cut = np.searchsorted(X.bucket_of(anchor[own], 62, buckets), np.arange(buckets + 1)).tolist()
        chunk, out = answers["chunk"][0].as_py(), []
        if len(hot):
            i = np.flatnonzero(X.member(anchor, hot))
            keys, flags = X.distinct(_windows(data, start[i], end[i], window)[0] << U64(1) | U64(1))
            asked = X.send(chunk, buckets, 62, keys, flags)
            out += [(-1 - b, p) for b, p in zip(asked["bucket"].to_pylist(), asked["payload"].to_pylist())]
        if len(hot) or len(passages):  # the chunk's note to itself
            note = X.pack(hot)
            out.append((-1 - buckets - chunk, len(note).to_bytes(8, "little") + note + X.pack(passages)))
        for b, (x, y) in enumerate(zip(cut, cut[1:])):
            if y > x:
                i = own[x:y]
                raw = b"".join(data[s:e].tobytes() for s, e in zip(start[i].tolist(), end[i].tolist()))
                out.append((b, b"".join([np.array([y - x], np.int64).tobytes(), anchor[i].tobytes(), key[i].tobytes(), (end[i] - start[i]).tobytes(), many[x:y].tobytes(), raw])))
        return X.messages([b for b, _ in out], [chunk] * len(out), [p for _, p in out])

    return run


# ---- induced sorting ------------------------------------------------------------------------------------------------


class Queues:
    """A queue of (suffix, common prefix) blocks for each first character; blocks beyond the memory limit go to disk."""

    def __init__(self, size: int, folder: str | None, limit: int = QUEUE_BYTES):
        self.blocks: list[list] = [[] for _ in range(size)]
        self.held, self.limit, self.folder, self.file = 0, limit, folder, None

    def push(self, c: int, place: np.ndarray, lcp: np.ndarray) -> None:
        size = place.nbytes + lcp.nbytes
        if self.folder is not None and self.held + size > self.limit:
            self.file = self.file or tempfile.TemporaryFile(dir=self.folder)
            at = self.file.seek(0, os.SEEK_END)
            self.file.write(place.tobytes())
            self.file.write(lcp.tobytes())
            self.blocks[c].append((at, len(place)))
        else:
            self.held += size
            self.blocks[c].append((place, lcp))

    def pop(self, c: int):
        """The oldest block of c, or None."""
        if not self.blocks[c]:
            return None
        a, b = self.blocks[c].pop(0)
        if isinstance(a, int):
            self.file.seek(a)
            return np.frombuffer(self.file.read(4 * b), np.int32), np.frombuffer(self.file.read(2 * b), np.int16)
        self.held -= a.nbytes + b.nbytes
        return a, b

    def close(self) -> None:
        if self.file:
            self.file.close()


def split_ties(rank: np.ndarray, sa: np.ndarray, tied: np.ndarray, after: np.ndarray):
    """One refinement: places tied in rank are ordered by ``after``; returns those still tied.

    A rank is one more than the place of the group's first member in ``sa``."""
    o = np.lexsort((after, rank[tied]))
    tied, after = tied[o], after[o]
    old = rank[tied]
    head = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
    slot = old + np.arange(len(tied)) - np.repeat(head, np.diff(np.append(head, len(tied))))
    sa[slot - 1] = tied
    new = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (after[1:] != after[:-1])))
    size = np.diff(np.append(new, len(tied)))
    rank[tied] = np.repeat(slot[new], size)
    return tied[np.repeat(size > 1, size)]


def _kinds(t: np.ndarray) -> np.ndarray:
    """True for S-suffixes: the next other character is greater. The last place, the sentinel, is S."""
    head = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    up = np.append(t[head[1:]] > t[head[:-1]], True)
    return np.repeat(up, np.diff(np.append(head, len(t))))


def _sorted_stars(t: np.ndarray, s: np.ndarray, star: np.ndarray, depth: int) -> np.ndarray:
    """S*-suffixes in order, to ``depth`` characters: naming, then the reduced string of names."""
    m = len(star)
    stop = np.append(star[1:], len(t) - 1)
    symbol = (t.astype(np.int64) << 1) | s
    rank, sa = np.ones(m, np.int64), np.arange(m)
    tied, at = np.arange(m), 0
    while len(tied):
        key = np.zeros(len(tied), np.int64)
        for j in range(at, at + 6):
            place = star[tied] + j
            key = key << 10 | np.where(place <= stop[tied], symbol[np.minimum(place, len(t) - 1)], 0)
        longer = stop[tied] - star[tied] >= at + 6
        still = split_ties(rank, sa, tied, key)
        flag = np.zeros(m, bool)
        flag[tied[longer]] = True
        tied = still[flag[still]]
        at += 6
    # Ties of whole substrings are equal names; order by the names that follow, doubling.
    size = np.bincount(rank, minlength=m + 2)
    tied, k = np.flatnonzero(size[rank] > 1), 1
    while len(tied) and k * 2 < 2 * depth:
        after = np.where(tied + k < m, rank[np.minimum(tied + k, m - 1)], 0)
        tied = split_ties(rank, sa, tied, after)
        k *= 2
    return star[sa]


class Common:
    """Common prefixes of pairs of suffixes, up to ``cap``: binary search on 64-bit hashes of substrings."""

    def __init__(self, t: np.ndarray, cap: int):
        self.n, self.cap = len(t), cap
        up, self.down = CHAR_POWERS.get(self.n + 1)
        self.total = np.zeros(self.n + 1, U64)
        np.cumsum(mix(t.astype(U64) + U64(1)) * up[: self.n], out=self.total[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.cap, self.n - np.maximum(a, b).astype(np.int64))
        da, db, ta, tb = self.down[a], self.down[b], self.total[a], self.total[b]
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = (self.total[a + mid] - ta) * da == (self.total[b + mid] - tb) * db
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low.astype(np.int16)


def sort_suffixes(t: np.ndarray, cap: int, folder: str | None = None, limit: int = QUEUE_BYTES):
    """(suffixes in order, common prefix of each with the one before, both to ``cap`` characters).

    ``t``: small whole numbers, the last one 0 and the only 0."""
    n, top = len(t), int(t.max()) + 1
    s = _kinds(t)
    star = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    order = _sorted_stars(t, s, star, cap).astype(np.int32)
    common = Common(t, cap)
    prefix = np.append(np.zeros(1, np.int16), common(order[:-1], order[1:]))[: len(order)]
    begin = np.searchsorted(t[order], np.arange(top + 1))

    def induce(queues: Queues, low: np.ndarray, place: np.ndarray, lcp: np.ndarray, want_s: bool) -> None:
        """Send on the suffixes that start one place before; ``low``: least prefix since each bucket's last one."""
        before = place - 1
        good = np.flatnonzero((before >= 0) & (s[before] == want_s))
        c = t[before[good]]
        o = np.argsort(c, kind="stable")
        good, c = good[o], c[o]
        heads = np.flatnonzero(np.append(True, c[1:] != c[:-1])) if len(c) else np.zeros(0, np.int64)
        least = np.minimum.accumulate(lcp)
        touched = np.zeros(top, bool)
        old = low.copy()
        for x, y in zip(heads.tolist(), [*heads[1:].tolist(), len(c)]):
            d, i = int(c[x]), good[x:y]
            own = np.empty(y - x, np.int16)
            own[0] = min(int(old[d]), int(least[i[0]]))
            if y - x > 1:
                # Between neighbours i[k-1] < i[k] the least of lcp over (i[k-1], i[k]].
                edges = np.stack([i[:-1] + 1, i[1:] + 1], 1).ravel()
                own[1:] = np.minimum.reduceat(np.append(lcp, np.int16(cap)), edges)[::2]
            first = old[d] < 0
            own = np.minimum(own + 1, cap).astype(np.int16)
            if first:
                own[0] = 0
            queues.push(d, before[i], own)
            rest = lcp[i[-1] + 1 :]
            low[d] = rest.min() if len(rest) else cap
            touched[d] = True
        idle = ~touched & (low >= 0)
        low[idle] = np.minimum(low[idle], least[-1])

    queues, low = Queues(top, folder, limit), np.full(top, -1, np.int16)
    left: list = []
    for c in range(top):
        got = []
        while (block := queues.pop(c)) is not None:
            got.append(block)
            induce(queues, low, *block, False)
        left.append(tuple(np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int32), np.zeros(0, np.int16)))
        if begin[c + 1] > begin[c]:
            place, lcp = order[begin[c] : begin[c + 1]], prefix[begin[c] : begin[c + 1]].copy()
            lcp[0] = common(left[c][0][-1:], place[:1])[0] if len(left[c][0]) else 0
            induce(queues, low, place, lcp, False)
    queues.close()
    queues, low = Queues(top, folder, limit), np.full(top, -1, np.int16)
    places, prefixes = [], []
    end = n - 1
    for c in range(top - 1, -1, -1):
        got = []
        while (block := queues.pop(c)) is not None:
            got.append(block)
            induce(queues, low, *block, True)
        place, lcp = left[c]
        seam = 0
        if got:
            sp, sl = (np.concatenate(x) for x in zip(*got))
            if len(place):
                seam = int(common(place[-1:], sp[-1:])[0])
        else:
            sp, sl = np.zeros(0, np.int32), np.zeros(0, np.int16)
        if len(place):
            induce(queues, low, place[::-1], np.append(np.int16(seam), lcp[:0:-1]).astype(np.int16), True)
        if c == 0:
            sp, sl = np.array([end], np.int32), np.zeros(1, np.int16)
        # Ascending: L-suffixes, then S-suffixes; an S-suffix's stored prefix is with the next greater one.
        places.append(np.concatenate((place, sp[::-1])))
        up = np.append(np.int16(seam), sl[:0:-1]).astype(np.int16) if len(sp) else sl
        prefixes.append(np.concatenate((lcp, up)))
        if len(prefixes[-1]):
            prefixes[-1][0] = 0
    queues.close()
    return np.concatenate(places[::-1]), np.concatenate(prefixes[::-1])


# ---- shards ---------------------------------------------------------------------------------------------------------


def _repeated_windows(texts: list[bytes], window: int, folder: str | None) -> list[np.ndarray]:
    """For each distinct segment, whether each of its windows starts elsewhere too."""
    size = np.array([len(x) for x in texts])
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    t = np.zeros(begin[-1] + 1, np.uint16)
    raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    t[:-1] = raw
    t[:-1] += 2
    t[begin[1:] - 1] = 1
    place, lcp = sort_suffixes(t, window, folder)
    starts = np.zeros(len(t), bool)
    for b, n in zip(begin.tolist(), size.tolist()):
        starts[b : b + n - window + 1] = True
    at = np.flatnonzero(starts[place])
    again = np.zeros(len(t), bool)
    if len(at) > 1:
        between = np.minimum.reduceat(lcp, at[:-1] + 1)
        # reduceat's last group runs to the end of the array, past the last window start.
        between[-1] = lcp[at[-2] + 1 : at[-1] + 1].min()
        same = between >= window
        again[place[at[:-1][same]]] = True
        again[place[at[1:][same]]] = True
    return [again[b : b + n - window + 1] for b, n in zip(begin.tolist(), size.tolist())]


def _shard(buckets: int, window: int, folder: str | None):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        if (bucket := table["bucket"][0].as_py()) < 0:  # windows of hot anchors, or a chunk's note to itself
            return X.repeated(table) if bucket >= -buckets else table.select(["bucket", "chunk", "payload"])
        anchor, key, size, many, text, who = [], [], [], [], [], []
        for j, p in enumerate(table["payload"].to_pylist()):
            n = int(np.frombuffer(p, np.int64, 1)[0])
            anchor.append(np.frombuffer(p, U64, n, 8))
            key.append(np.frombuffer(p, U64, n, 8 + 8 * n))
            size.append(np.frombuffer(p, np.int64, n, 8 + 16 * n))
            many.append(np.frombuffer(p, np.uint8, n, 8 + 24 * n))
            at = 8 + 25 * n
            for m in size[-1].tolist():
                text.append((p, at, m))
                at += m
            who.append(np.full(n, j))
        anchor, key, size, many, who = map(np.concatenate, (anchor, key, size, many, who))
        distinct, first, at = np.unique(key, return_index=True, return_inverse=True)
        twice = (np.bincount(at) > 1) | (np.bincount(at, many) > 0)
        order = np.argsort(anchor[first], kind="stable")
        a, n = anchor[first][order], size[first][order]
        # Parts: whole anchors up to PART suffixes (hot ones don't come here); anchors of one segment can't repeat inside the shard.
        head = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        alone = np.diff(np.append(head, len(a))) == 1
        windows: dict[int, np.ndarray] = {}
        for i in order[head[alone]].tolist():
            windows[i] = np.full(int(size[first[i]]) - window + 1, bool(twice[i]))
        part, total = [], 0

        def close():
            texts = [(lambda p, s, m: p[s : s + m])(*text[first[i]]) for i in part]
            for i, again in zip(part, _repeated_windows(texts, window, folder)):
                windows[i] = np.ones(len(again), bool) if twice[i] else again

        for x, y in zip(head[~alone].tolist(), np.append(head[1:], len(a))[~alone].tolist()):
            m = int(n[x:y].sum())
            if part and total + m > PART:
                close()
                part, total = [], 0
            part += order[x:y].tolist()
            total += m
        if part:
            close()
        own, chunks, out = table["bucket"].to_pylist(), table["chunk"].to_pylist(), []
        for j in range(table.num_rows):
            rows = np.flatnonzero(who == j)
            hit = [(int(key[r]), runs(windows[int(at[r])])) for r in rows.tolist()]
            hit = sorted((k, s, e) for k, (s, e) in hit if len(s))
            if hit:
                counts = np.array([len(s) for _, s, _ in hit], np.int64)
                out.append((own[j], chunks[j], b"".join([np.array([len(hit)], np.int64).tobytes(), np.array([k for k, _, _ in hit], U64).tobytes(), counts.tobytes(), np.concatenate([s for _, s, _ in hit]).astype(np.int64).tobytes(), np.concatenate([e for _, _, e in hit]).astype(np.int64).tobytes()])))
        return X.messages(*zip(*out)) if out else X.messages([], [], [])

    return run


def _cut(buckets: int, window: int, kept: int):
    @X.tidy
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets, anchor, key, start, end, _ = _of_chunk(table, window)
        edge = np.zeros(len(data) + 1, np.int32)
        bucket = answers["bucket"].to_numpy()
        shared, hot = np.zeros(len(data), bool), np.zeros(0, U64)
        for raw in answers.filter(pa.array(bucket < -buckets))["payload"].to_pylist():  # one note at most
            cut = 8 + int.from_bytes(raw[:8], "little")
            hot = X.unpack(raw[8:cut])[0]
            some = X.unpack(raw[cut:])[0]
            if len(some):
                sampled, places = _passages(table)
                shared = cover(places[X.member(sampled, some)], PASSAGE_GRAM, len(data))
        before = np.concatenate((np.zeros(1, np.int64), np.cumsum(shared)))
        if len(hot):
            i = np.flatnonzero(X.member(anchor, hot))
            keys, places = _windows(data, start[i], end[i], window)
            again = places[X.member(keys, X.keys_of(answers.filter(pa.array((bucket < 0) & (bucket >= -buckets)))))]
            np.add.at(edge, again, 1)
            np.add.at(edge, again + window, -1)
        for p in answers.filter(pa.array(bucket >= 0))["payload"].to_pylist():
            n = int(np.frombuffer(p, np.int64, 1)[0])
            keys, count = np.frombuffer(p, U64, n, 8), np.frombuffer(p, np.int64, n, 8 + 8 * n)
            m = int(count.sum())
            s, e = np.frombuffer(p, np.int64, m, 8 + 16 * n), np.frombuffer(p, np.int64, m, 8 + 16 * n + 8 * m)
            begin = np.concatenate(([0], np.cumsum(count)))
            seg = np.flatnonzero(X.member(key, keys))
            which = np.searchsorted(keys, key[seg])
            c = count[which]
            r = np.arange(int(c.sum())) + np.repeat(begin[which] - np.concatenate(([0], np.cumsum(c)[:-1])) if len(c) else c, c)
            base = np.repeat(start[seg], c)
            np.add.at(edge, base + s[r], 1)
            np.add.at(edge, base + e[r] + window - 1, -1)
        gone = np.cumsum(edge)[:-1] > 0
        removed, texts = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            mask = gone[a:b]
            s, e = runs(mask)
            removed.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
            texts.append(data[a:b][~mask].tobytes() if len(s) else data[a:b].tobytes())
        return pa.table({f"k{i}": table[f"k{i}"] for i in range(kept)} | {"n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_shared": pa.array(np.diff(before[offsets]), pa.int64()), "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(texts, pa.binary())})

    return run


def suffix_dedup(docs: DataFrame, window: int = 400, text: str = "text", keep: list[str] | None = None, passages: bool = False) -> DataFrame:
    """The kept columns with n_bytes, removed (byte spans, end exclusive), and kept (binary). Every byte covered by a
    string of ``window`` bytes that also starts elsewhere goes, first copy too. ``passages``: another column, n_shared,
    has the bytes in shorter passages that repeat, by sampled strings and not by the sort."""
    if window <= GRAM:
        raise ValueError(f"a window has more than {GRAM} bytes")
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    folder = X.checkpoint_dir(docs.sparkSession)
    # Queues spill to the shared folder where Python can open it; elsewhere shards stay in memory, cut to PART.
    folder = folder.removeprefix("file:").replace("///", "/") if folder.startswith(("file:", "/")) else None
    folder = "/" + folder.lstrip("/") if folder else None
    chunks, buckets = X.counts(X.measure(docs, text), bucket_bytes=SHARD_BYTES)
    base = X.chunked(docs, keep, text, chunks)
    chunk = lambda df: df.groupBy("chunk")
    shared = chunk(base).applyInArrow(_anchors(buckets, window, passages), X.MESSAGE)
    shared = X.spread(shared, 2 * buckets, "bucket").applyInArrow(_shared_anchors(buckets), X.MESSAGE)
    sent = chunk(base).cogroup(chunk(shared)).applyInArrow(_send_segments(buckets, window), X.MESSAGE)
    # Sorting is heavy for its bytes: one partition for each shard, which the adaptive planner does not merge.
    found = X.spread(sent, buckets, "bucket").applyInArrow(_shard(buckets, window, folder), X.MESSAGE)
    out = chunk(base).cogroup(chunk(found)).applyInArrow(_cut(buckets, window, len(keep)), f"{X.kept_schema(docs, keep)}, n_bytes bigint, n_shared bigint, removed array<struct<start: bigint, end: bigint>>, kept binary".lstrip(", "))
    return X.renamed(out, keep, ["n_bytes", *(["n_shared"] if passages else []), "removed", "kept"])


def op5(spark, sf_dir: str) -> DataFrame:
    out = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 400, keep=["doc_id"])
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
