"""The first pairs of a tile's probes, in numpy.

A search within a reach, which grows until enough is found, chooses pairs by a distance that need not be exact: a little more is kept than the bound.
What is kept is measured by the operations of ``geometry.segment_distance``, which give the same bits, and ranked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .. import config

#: Pairs that are measured at a time.
PAIRS = 1 << 20
#: Cells of a tile's grid; their numbers are sorted as 16 bits.
CELLS = 1 << 15
#: A search that found too few looks so much further.
FURTHER = 1.7


def kinds() -> list[tuple[float, int, list[tuple[list[int], int]]]]:
    """For each kind of probe (2 * position of its layer + whether it is an end): radius, limit, and (positions, own layer among them) by priority."""
    names, out = list(config.LAYERS), []
    for name in names:
        met = config.mutual(name)
        tiers = [[x for x in met if config.LAYERS[x].priority == p] for p in sorted({config.LAYERS[x].priority for x in met})]
        for end in (False, True):
            out.append((config.LAYERS[name].radius, config.limit_of(name, end), [([names.index(x) for x in t], int(name in t)) for t in tiers]))
    return out


def _grid(px, py, r: float):
    """(x, y, cell size, columns, rows) of a grid over the probes."""
    x, y = px.min(), py.min()
    w, h = px.max() - x, py.max() - y
    size = max(r, w / 150, h / 150, 1e-9)
    return x, y, size, int(w / size) + 1, int(h / size) + 1


def _apart(px, py, s, k):
    """Squared distances of points to the segments ``k`` of ``s``."""
    ex, ey = px - s["ax"][k], py - s["ay"][k]
    if not s["long"]:
        return ex * ex + ey * ey
    dx, dy = s["dx"][k], s["dy"][k]
    t = np.clip((ex * dx + ey * dy) * s["inverse"][k], 0.0, 1.0)
    ex -= t * dx
    ey -= t * dy
    return ex * ex + ey * ey


def _segments(ax, ay, bx, by, of) -> dict:
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    inverse = np.divide(1.0, square, out=np.zeros_like(square), where=square > 0)
    return {"ax": ax, "ay": ay, "dx": dx, "dy": dy, "inverse": inverse, "of": of, "long": bool((square > 0).any()), "length": float(np.sqrt(square).mean()) if len(square) else 0.0}


def _near(px, py, r: float, s: dict):
    """Chunks (first probe, last probe + 1, probe, segment, distance) of the pairs within ``r``, by probe; a probe's pairs are in one chunk."""
    r = r * (1 + 1e-9) + 1e-6
    gx, gy, size, nx, ny = _grid(px, py, r)
    assert nx * ny <= CELLS
    bx, by = s["ax"] + s["dx"], s["ay"] + s["dy"]
    at = lambda v, o, n: np.clip(np.floor((v - o) / size), -1, n)
    x0, x1 = at(np.minimum(s["ax"], bx) - r, gx, nx), at(np.maximum(s["ax"], bx) + r, gx, nx)
    y0, y1 = at(np.minimum(s["ay"], by) - r, gy, ny), at(np.maximum(s["ay"], by) + r, gy, ny)
    some = np.flatnonzero((x1 >= 0) & (x0 < nx) & (y1 >= 0) & (y0 < ny))
    low = lambda v: np.maximum(v[some], 0).astype(np.int64)
    high = lambda v, n: np.minimum(v[some], n - 1).astype(np.int64)
    x0, x1, y0, y1 = low(x0), high(x1, nx), low(y0), high(y1, ny)
    wide = x1 - x0 + 1
    n = wide * (y1 - y0 + 1)
    which = np.repeat(np.arange(len(some)), n)
    k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    cy, cx = y0[which] + k // wide[which], x0[which] + k % wide[which]
    which = some[which]
    if s["long"]:  # a box is more than its diagonal
        met = _apart(gx + (cx + 0.5) * size, gy + (cy + 0.5) * size, s, which) <= (r + size * 0.70711) ** 2 * (1 + 1e-9)
        which, cx, cy = which[met], cx[met], cy[met]
    cell = (cy * nx + cx).astype(np.int16)
    which = which[np.argsort(cell, kind="stable")].astype(np.int32)
    held = np.bincount(cell, minlength=nx * ny)
    start = np.cumsum(held) - held
    mine = np.minimum(((py - gy) / size).astype(np.int64), ny - 1) * nx + np.minimum(((px - gx) / size).astype(np.int64), nx - 1)
    n = held[mine]
    upto = np.cumsum(n)
    a = 0
    while a < len(px):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
        c = n[a:b]
        i = np.repeat(np.arange(a, b, dtype=np.int32), c)
        j = which[np.arange(len(i)) + np.repeat(start[mine[a:b]] - (np.cumsum(c) - c), c)]
        d = _apart(px[i], py[i], s, j)
        met = np.flatnonzero(d <= r * r)
        yield a, b, i[met], j[met], np.sqrt(d[met])
        a = b


def _least(i, f, d):
    """(probe, distance) of each pair of a probe and a feature once, at its least distance."""
    order = np.lexsort((d, f, i))
    i, f, d = i[order], f[order], d[order]
    first = np.ones(len(i), bool)
    first[1:] = (i[1:] != i[:-1]) | (f[1:] != f[:-1])
    return i[first], d[first]


def _kth(n, d, need):
    """For groups of ``n`` consecutive distances the ``need``-th smallest of each; infinite where there are not so many."""
    out = np.full(len(n), np.inf)
    full = np.flatnonzero((n >= need) & (n > 0))
    if not len(full):
        return out
    start, m = (np.cumsum(n) - n), n[full]
    if m.max() * len(full) <= 4 * len(d) + PAIRS:
        k = np.arange(m.max())
        rows = np.where(k < m[:, None], d[np.minimum(start[full][:, None] + k, len(d) - 1)], np.inf)
        rows.sort(axis=1)
        out[full] = rows[np.arange(len(full)), need[full] - 1]
    else:
        order = np.lexsort((d, np.repeat(np.arange(len(n)), n)))
        out[full] = d[order[start[full] + need[full] - 1]]
    return out


def choose(px, py, kind, s_pos, of, ax, ay, bx, by):
    """(probes, segments): among them are each probe's first by (priority, distance), as many as its limit, within its radius. ``of``: the segments' features."""
    found_i, found_s, cut = [], [], {}
    single = len(of) == 0 or len(np.unique(of)) == len(of)

    def segments(positions: list[int]) -> dict:
        key = tuple(positions)
        if key not in cut:
            take = np.flatnonzero(np.isin(s_pos, positions))
            cut[key] = _segments(ax[take], ay[take], bx[take], by[take], take)
        return cut[key]

    for code, (radius, limit, tiers) in enumerate(kinds()):
        left = np.flatnonzero(kind == code)
        need = np.full(len(left), limit)
        for positions, own in tiers:
            if not len(left):
                break
            s = segments(positions)
            if not len(s["of"]):
                continue
            # From how far as many are to be expected as are wanted, and some more.
            wide = (np.ptp(px) + 2 * radius) * (np.ptp(py) + 2 * radius)
            want, density, length = 1.4 * (limit + own) + 2 * (limit + own) ** 0.5, len(s["of"]) / wide, s["length"]
            r = (-2 * length + (4 * length**2 + 4 * np.pi * want / density) ** 0.5) / (2 * np.pi)
            going, wanted, after = left, need, []
            while len(going):
                last = r * 1.2 >= radius
                r = radius if last else max(r, radius / 64)
                again = []
                for a, b, i, j, d in _near(px[going], py[going], r, s):
                    j = s["of"][j]
                    ni, nd = (i, d) if single else _least(i, of[j], d)
                    n = np.bincount(ni - a, minlength=b - a)
                    bound = _kth(n, nd, wanted[a:b] + own)
                    short = np.flatnonzero(~np.isfinite(bound))
                    if last:
                        after.append((going[a:b][short], wanted[a:b][short] - np.maximum(n[short] - own, 0)))
                    else:
                        again.append(short + a)
                        bound[short] = -1.0
                    keep = d <= bound[i - a] * (1 + 1e-9) + 1e-6
                    found_i.append(going[i[keep]])
                    found_s.append(j[keep])
                if last:
                    break
                again = np.concatenate(again)
                going, wanted = going[again], wanted[again]
                r *= FURTHER
            left = np.concatenate([x for x, _ in after]) if after else left[:0]
            need = np.concatenate([x for _, x in after]) if after else need[:0]
    whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return whole(found_i), whole(found_s)


def exact(px, py, ax, ay, bx, by):
    """As ``geometry.segment_distance``, operation by operation."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    to = lambda x, y: np.sqrt((px - x) * (px - x) + (py - y) * (py - y))
    with np.errstate(divide="ignore", invalid="ignore"):
        along = ((px - ax) * dx + (py - ay) * dy) / square
        across = np.abs((px - ax) * dy - (py - ay) * dx) / np.sqrt(square)
    return np.where((square == 0) | (along <= 0), to(ax, ay), np.where(along >= 1, to(bx, by), across))


def first_pairs(probes: pa.Table, found: pa.Table):
    """(probe, row of ``found``, distance, rank) by probe and rank. Rows of ``found`` are segments, and ranked pairs with areas, which have a ``distance``."""
    column = lambda t, k: t.column(k).to_numpy()
    px, py, pos, ordinal = (column(probes, k) for k in ("px", "py", "src_pos", "src_ordinal"))
    ends = pc.not_equal(probes.column("end"), "P").to_numpy()
    kind = pos.astype(np.int64) * 2 + ends
    f_pos, f_ordinal = column(found, "dst_pos"), column(found, "dst_ordinal")
    known = pc.is_valid(found.column("distance")).to_numpy()
    take = np.flatnonzero(~known)
    s_pos = f_pos[take]
    _, of = np.unique(f_ordinal[take].astype(np.int64) * len(config.LAYERS) + s_pos, return_inverse=True)
    s = [column(found, k)[take] for k in ("ax", "ay", "bx", "by")]
    i, j = choose(px, py, kind, s_pos, of, *s)
    d = exact(px[i], py[i], *(v[j] for v in s))
    j = take[j]
    if known.any():
        at = {k: n for n, k in enumerate(zip(probes.column("src_id").to_pylist(), probes.column("end").to_pylist(), strict=True))}
        areas = np.flatnonzero(known)
        of_probe = [at[k] for k in zip(found.column("src_id").take(areas).to_pylist(), found.column("end").take(areas).to_pylist(), strict=True)]
        i, j, d = np.concatenate([i, np.array(of_probe, np.int64)]), np.concatenate([j, areas]), np.concatenate([d, column(found, "distance")[areas]])
    radius, limit = (np.array([k[n] for k in kinds()]) for n in (0, 1))
    good = np.flatnonzero((d <= radius[kind[i]]) & ((pos[i] != f_pos[j]) | (ordinal[i] != f_ordinal[j])))
    i, j, d = i[good], j[good], d[good]
    priority = np.array([x.priority for x in config.LAYERS.values()])
    order = np.lexsort((f_ordinal[j], f_pos[j], d, priority[f_pos[j]], i))
    i, j, d = i[order], j[order], d[order]
    if len(take) != len(np.unique(of)):  # features of more segments: each pair at its least distance
        pair = np.lexsort((np.arange(len(i)), f_ordinal[j], f_pos[j], i))
        a, b = pair[1:], pair[:-1]
        first = np.ones(len(i), bool)
        first[a[(i[a] == i[b]) & (f_pos[j[a]] == f_pos[j[b]]) & (f_ordinal[j[a]] == f_ordinal[j[b]])]] = False
        i, j, d = i[first], j[first], d[first]
    n = np.bincount(i, minlength=len(px))
    rank = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + 1
    keep = np.flatnonzero(rank <= limit[kind[i]])
    return i[keep], j[keep], d[keep], rank[keep]


PAIRS_SCHEMA = "cell long, src_id string, src_pos int, src_ordinal long, end string, dst_id string, dst_pos int, dst_ordinal long, distance double, rank int"
LISTS_SCHEMA = "src_id string, src_pos int, src_ordinal long, end string, dst_ids array<string>, dst_codes array<long>"


def _taken(t: pa.Table, rows, names: tuple[str, ...]) -> dict:
    rows = pa.array(rows)
    return {k: t.column(k).take(rows) for k in names}


def pairs(key, probes: pa.Table, found: pa.Table) -> pa.Table:
    """Ranked pairs of a tile."""
    probes, found = probes.combine_chunks(), found.combine_chunks()
    i, j, d, rank = first_pairs(probes, found)
    left, right = _taken(probes, i, ("src_id", "src_pos", "src_ordinal", "end")), _taken(found, j, ("dst_id", "dst_pos", "dst_ordinal"))
    return pa.table({"cell": pa.array(np.full(len(i), key[0].as_py(), np.int64)), **left, **right, "distance": pa.array(d), "rank": pa.array(rank.astype(np.int32))})


def lists(key, probes: pa.Table, found: pa.Table) -> pa.Table:
    return _lists(probes, found, True)


def codes(key, probes: pa.Table, found: pa.Table) -> pa.Table:
    """As :func:`lists`, without ids."""
    return _lists(probes, found, False)


def _lists(probes: pa.Table, found: pa.Table, ids: bool) -> pa.Table:
    """One row for each probe with connections: their ids and codes (ordinal * layers + position) in rank order."""
    probes, found = probes.combine_chunks(), found.combine_chunks()
    i, j, _, _ = first_pairs(probes, found)
    some, start = np.unique(i, return_index=True)
    ends = pa.array(np.append(start, len(i)).astype(np.int32))
    codes = found.column("dst_ordinal").to_numpy().astype(np.int64) * len(config.LAYERS) + found.column("dst_pos").to_numpy()
    taken = found.column("dst_id").take(pa.array(j)) if ids else pa.chunked_array([pa.nulls(len(j), pa.string())])
    whole = pa.concat_arrays(taken.chunks) if taken.num_chunks else pa.array([], pa.string())
    left = _taken(probes, some, ("src_id", "src_pos", "src_ordinal", "end"))
    return pa.table({**left, "dst_ids": pa.ListArray.from_arrays(ends, whole), "dst_codes": pa.ListArray.from_arrays(ends, pa.array(codes[j]))})
