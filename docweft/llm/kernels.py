"""Array kernels over Arrow string buffers: token hashes, shingle sets, signatures, windows.

All hashes are functions of the bytes alone, so every executor and every run agrees. Texts are taken
in slices of bounded size: a text of any length needs memory for one slice, not for the whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE = 1 << 20  # bytes or code points worked on at a time
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n + 1, U64)
    out[0] = 1
    if n:
        out[1:] = base & 0xFFFFFFFFFFFFFFFF
        np.multiply.accumulate(out, out=out)
    return out


_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _POW.get(base)
    if have is None or len(have) <= n:
        have = _POW[base] = _powers(base, max(n, SLICE + 4096))
    return have[: n + 1]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finalizer)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column without nulls (nulls are to be made empty before)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(data) else np.empty(0, np.uint8)
    return at - at[0], raw


WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), ord("_")]] = True
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[ord(" ")] = False


def token_hashes(offsets: np.ndarray, raw: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, row of each token): the longest runs of ``member`` bytes within each row."""
    n = len(raw)
    hashes: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    power, back = powers(_BASE, SLICE), powers(inverse(_BASE), SLICE)
    start = 0
    while start < n:
        stop = min(n, start + SLICE)
        if stop < n:  # not inside a token, unless one is longer than a slice
            gap = np.flatnonzero(~member[raw[start:stop]])
            if len(gap):
                stop = start + int(gap[-1]) + 1
            else:
                more = np.flatnonzero(~member[raw[stop:]])
                stop = stop + int(more[0]) + 1 if len(more) else n
        piece = raw[start:stop]
        inside = member[piece]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        lo, hi = np.searchsorted(offsets, [start, stop])
        cuts = offsets[lo:hi] - start
        cuts = cuts[(cuts >= 0) & (cuts < len(piece))]
        begins[cuts] = inside[cuts]
        first = np.flatnonzero(begins)
        if len(first):
            ends = ~inside
            ends[cuts] = True
            marks = np.append(np.flatnonzero(ends), len(piece))
            last = marks[np.searchsorted(marks, first, "right")]
            if len(piece) > SLICE:
                power, back = powers(_BASE, len(piece)), powers(inverse(_BASE), len(piece))
            sums = np.zeros(len(piece) + 1, U64)
            np.cumsum((piece.astype(U64) + U64(1)) * power[: len(piece)], out=sums[1:])
            hashes.append(mix((sums[last] - sums[first]) * back[first] + (last - first).astype(U64)))
            rows.append(np.searchsorted(offsets, first + start, "right") - 1)
        start = stop
    if not hashes:
        return np.empty(0, U64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(rows)


def shingles(tokens: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of ``width`` tokens of one row."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    out = np.zeros(n, U64)
    for k in range(width):
        out = mix(out * U64(3) + tokens[k : k + n])
    whole = rows[:n] == rows[width - 1 :]
    return out[whole], rows[:n][whole]


def row_sets(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (row, hash), sorted, and how often each stood there."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return h[at], r[at], np.diff(np.append(at, len(h)))


def bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` rows begins and ends among sorted ``rows``."""
    return np.searchsorted(rows, np.arange(n + 1))


def list_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def small_batches(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; one longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = buffers(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            stop = min(batch.num_rows, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop


def shingle_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(id, text, others) to (id, fp, fp2, n, grams, tf, others): each row's set of shingles and two hashes of the set."""
    for batch in small_batches(batches, "text"):
        offsets, raw = buffers(batch.column("text"))
        h, r, tf = row_sets(*shingles(*token_hashes(offsets, raw, WORD_BYTES), width))
        at = bounds(r, batch.num_rows)
        yield pa.record_batch(
            {
                "id": batch.column("id"),
                "fp": pa.array(segment_sum(mix(h + U64(0x51ED27)), at).view(np.int64)),
                "fp2": pa.array(segment_sum(mix(h ^ U64(0xA5A5A5A5A5A5A5A5)), at).view(np.int64)),
                "n": pa.array(np.diff(at).astype(np.int32)),
                "grams": list_column(h.view(np.int64), at),
                "tf": list_column(tf.astype(np.int32), at),
                **{c: batch.column(c) for c in batch.schema.names if c not in ("id", "text")},
            }
        )


def segment_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _pieces(at: np.ndarray, most: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, begin, end) of row groups with about ``most`` values; a longer row comes in parts."""
    n, row = len(at) - 1, 0
    while row < n:
        stop = max(row + 1, min(n, int(np.searchsorted(at, at[row] + most, "right")) - 1))
        if stop == row + 1:
            for begin in range(int(at[row]), int(at[stop]), most):
                yield row, stop, begin, min(begin + most, int(at[stop]))
        else:
            yield row, stop, int(at[row]), int(at[stop])
        row = stop


def _segment_min(values: np.ndarray, at: np.ndarray, row: int, stop: int, begin: int, end: int, out: np.ndarray) -> None:
    starts = np.clip(at[row:stop], begin, end) - begin
    sizes = np.clip(at[row + 1 : stop + 1], begin, end) - begin - starts
    full = np.flatnonzero(sizes)
    if len(full):
        low = np.minimum.reduceat(values, starts[full], axis=0)
        out[row + full] = np.minimum(out[row + full], low)


def minhash(h: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    """(rows, k) smallest 32-bit hashes of each row's set; rows without members keep the largest number."""
    rng = np.random.default_rng(seed)
    odd = rng.integers(0, 1 << 63, k, dtype=U64) * U64(2) + U64(1)
    add = rng.integers(0, 1 << 63, k, dtype=U64)
    out = np.full((len(at) - 1, k), 0xFFFFFFFF, np.uint32)
    for row, stop, begin, end in _pieces(at, 2048):
        v = ((h[begin:end, None] * odd + add) >> U64(32)).astype(np.uint32)
        _segment_min(v, at, row, stop, begin, end, out)
    return out


def _log_gamma_quantiles(cells: int) -> np.ndarray:
    """ln of the quantiles of Gamma(2, 1) at k / ``cells``; the two ends are finite stand-ins."""
    x = np.concatenate([np.geomspace(1e-6, 0.1, 4000), np.linspace(0.1, 40, 200_000)[1:]])
    at = np.interp(np.arange(1, cells) / cells, 1 - (1 + x) * np.exp(-x), np.log(x))
    return np.concatenate([[at[0] - 1], at, [at[-1] + 0.7]]).astype(np.float32)


class ConsistentSampler:
    """Improved consistent weighted sampling.

    For each sample j and feature x with weight w: r, c ~ Gamma(2, 1) and b ~ U(0, 1) by the hash of
    (x, j); t = floor(ln w / r + b); ln a = ln c - r (t - b + 1). The feature with the least a is the
    sample. ln a is a function of (x, j, t) alone, and two rows agree in a sample with the probability of
    their weighted Jaccard. ln c is read from a table of quantiles and set within its cell by 32 more bits
    of the hash; r and b come from a pool. A sample's name is ln a with 32 bits of the feature's own hash, which
    also break ties: sets without a common feature share no name, however large they are.
    """

    CELLS = 1 << 16

    def __init__(self, k: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.odd = rng.integers(0, 1 << 63, k, dtype=U64) * U64(2) + U64(1)
        self.r = np.maximum(rng.gamma(2.0, 1.0, self.CELLS).astype(np.float32), np.float32(1e-3))
        self.b = rng.random(self.CELLS).astype(np.float32)
        self.over_r = (np.float32(1) / self.r).astype(np.float32)
        self.c = _log_gamma_quantiles(self.CELLS)
        self.step = np.diff(self.c)
        self.k = k

    def sample(self, h: np.ndarray, weights: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(rows, k) of 64-bit sample names; rows without members keep the largest number."""
        out = np.full((len(at) - 1, self.k), np.iinfo(U64).max, U64)
        log_w = np.log(weights).astype(np.float32)
        own = mix(h ^ U64(0xC3A5C85C97CB3127)) & U64(0xFFFFFFFF)
        for row, stop, begin, end in _pieces(at, 2048):
            bits = h[begin:end, None] * self.odd
            cell = (bits >> U64(48)).astype(np.int32)
            pool = ((bits >> U64(32)) & U64(0xFFFF)).astype(np.int32)
            inside = (((bits >> U64(16)) & U64(0xFFFFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-32)
            value = self.c[cell] + inside * self.step[cell]
            lowest = cell == 0  # where the density is that of x, ln c is half the ln of twice the probability
            if lowest.any():
                value[lowest] = 0.5 * np.log(inside[lowest] * np.float32(2 / self.CELLS))
            b = self.b[pool]
            t = np.floor(log_w[begin:end, None] * self.over_r[pool] + b)
            t -= b
            t += np.float32(1)
            value -= self.r[pool] * t
            order = value.view(np.uint32)
            order = np.where(order >> 31, ~order, order | np.uint32(1 << 31)).astype(U64)
            _segment_min((order << U64(32)) | own[begin:end, None], at, row, stop, begin, end, out)
        return out


def band_keys(signature: np.ndarray, rows_per_band: int) -> np.ndarray:
    """(rows, bands): one 64-bit key for each run of ``rows_per_band`` values, different for each band."""
    n, k = signature.shape
    bands = k // rows_per_band
    parts = signature[:, : bands * rows_per_band].reshape(n, bands, rows_per_band).astype(U64)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), (n, bands)).copy()
    for i in range(rows_per_band):
        out = mix(out * U64(5) + parts[:, :, i])
    return out


def prefixes(h: np.ndarray, rank: np.ndarray, at: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``h``, row, place) of the first members of each row's set, the lowest rank first, ties by hash.

    A set of n keeps n - ceil(threshold * n) + 1 members. ``rank`` is a function of the member alone, so two sets whose
    likeness reaches the threshold have a member in common among these.
    """
    sizes = np.diff(at)
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((mix(h), rank, row))
    pos = np.arange(len(h)) - np.repeat(at[:-1], sizes)
    kept = pos < (sizes - np.ceil(threshold * sizes - 1e-6) + 1)[row]
    return order[kept], row[kept], pos[kept]


def weighted_prefixes(h: np.ndarray, rank: np.ndarray, weights: np.ndarray, at: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``h``, row, weight before) of the first members of each row's set, in the order of ``prefixes``; weights are whole numbers.

    A member is kept while it and those after it weigh ``threshold`` of the set or more. Two sets whose weighted Jaccard
    reaches the threshold have that much in common from their first common member on, which is therefore kept in both.
    """
    sizes = np.diff(at)
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((mix(h), rank, row))
    sums = np.concatenate([[0], np.cumsum(weights[order])])
    before = sums[:-1] - np.repeat(sums[at[:-1]], sizes)
    total = np.repeat(sums[at[1:]] - sums[at[:-1]], sizes)
    kept = total - before >= total * threshold
    return order[kept], row[kept], before[kept]


def list_values(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column without nulls."""
    at = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False)
    return values.astype(dtype, copy=False), at - at[0]


def set_likeness(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Size of the intersection over that of the union of the sets in each row of two list columns; 0 if either is empty."""
    (x, xa), (y, ya) = list_values(a, np.int64), list_values(b, np.int64)
    nx, ny = np.diff(xa), np.diff(ya)
    row = np.concatenate([np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)])
    value = np.concatenate([x, y])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    same = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    both = np.bincount(row[1:][same], minlength=len(nx))
    return np.where((nx > 0) & (ny > 0), both / np.maximum(nx + ny - both, 1), 0.0)


def fixed_binary(values: np.ndarray) -> pa.Array:
    """The rows of a matrix of bytes as binary values of one width."""
    n, width = values.shape
    offsets = np.arange(n + 1, dtype=np.int64) * width
    if n * width < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values).reshape(-1))])
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).reshape(-1))])


def byte_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of one width as a matrix of bytes."""
    column = column.cast(pa.binary(width))
    if not len(column):
        return np.empty((0, width), np.uint8)
    return np.frombuffer(column.buffers()[1], np.uint8, len(column) * width, column.offset * width).reshape(-1, width)


def signature_column(signature: np.ndarray) -> pa.Array:
    """Each row's sample values as one binary value, the most significant byte first."""
    return fixed_binary(np.ascontiguousarray(signature.astype(">u4")).view(np.uint8).reshape(len(signature), -1))


def weighted_likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> np.ndarray:
    """Sum of the lesser over that of the greater weights of the sets in each row of (members, weights, bounds); 0 if one is empty."""
    na, nb = np.diff(a[2]), np.diff(b[2])
    row = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
    value, weight = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((value, row))
    row, value, weight = row[order], value[order], weight[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (value[1:] == value[:-1]))
    least = np.bincount(row[same], np.minimum(weight[same], weight[same + 1]), len(na))
    total = np.bincount(row, weight, len(na)) - least
    return np.divide(least, total, out=np.zeros(len(na)), where=total > 0)


def tree_labels(signatures: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """(rows, ``trees``, 1 + 4 * ``depth``) bytes: the tree's number, then its values out of signatures as bytes."""
    n = len(signatures)
    label = np.empty((n, trees, 1 + 4 * depth), np.uint8)
    label[:, :, 0] = np.arange(trees, dtype=np.uint8)
    label[:, :, 1:] = signatures[:, : trees * depth * 4].reshape(n, trees, 4 * depth)
    return label
