"""Registration of two cell tables: triangle hashes of Delaunay triangulations, RANSAC, alignment that spreads from seeds.

Tiles are bounded groups of points; each is triangulated where it is (applyInPandas), pairs of tiles meet in a co-group.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.session import materialize, ship


def _curve(points: np.ndarray) -> np.ndarray:
    """The order of points along a Hilbert curve, then by their places: neighbours follow each other."""
    x, y = ((points - points.min(0)) / max(np.ptp(points, axis=0).max(), 1e-300) * 65535).astype(np.int64).T
    code = np.zeros(len(points), np.int64)
    for bit in 1 << np.arange(15, -1, -1):
        right, up = (x & bit) > 0, (y & bit) > 0
        code = code * 4 + (3 * right ^ up)
        x, y = np.where(~up & right, bit - 1 - (x & (bit - 1)), x & (bit - 1)), np.where(~up & right, bit - 1 - (y & (bit - 1)), y & (bit - 1))
        x, y = np.where(~up, y, x), np.where(~up, x, y)
    return np.lexsort((points[:, 1], points[:, 0], code))


def _side(a: tuple, b: tuple, c: tuple) -> Fraction:
    """Above 0 where c is left of the line from a to b, without rounding."""
    (ax, ay), (bx, by), (cx, cy) = (tuple(map(Fraction, p)) for p in (a, b, c))
    return (ax - cx) * (by - cy) - (ay - cy) * (bx - cx)


def _inside(a: tuple, b: tuple, c: tuple, d: tuple) -> Fraction:
    """Above 0 where d is inside the circle of a, b and c (counter-clockwise), without rounding."""
    dx, dy = Fraction(d[0]), Fraction(d[1])
    (ax, ay), (bx, by), (cx, cy) = ((Fraction(x) - dx, Fraction(y) - dy) for x, y in (a, b, c))
    return (ax * ax + ay * ay) * (bx * cy - cx * by) + (bx * bx + by * by) * (cx * ay - ax * cy) + (cx * cx + cy * cy) * (ax * by - bx * ay)


def delaunay(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangles (indices, counter-clockwise) and, for each, the triangle across each of its edges (-1: none), by incremental insertion.

    neighbours[t, k] shares the edge opposite to corner k. Points are inserted along a curve, each found by walking from the
    last one; where rounding could change a sign it is computed exactly. Of equal points only the first is a corner.
    """
    n = len(points)
    if n < 3:
        return np.zeros((0, 3), int), np.zeros((0, 3), int)
    middle, span = points.mean(0), max(np.ptp(points, axis=0).max(), 1e-9)
    big = middle + span * 50 * np.array([[-1.0, -0.8], [1.1, -0.9], [0.05, 1.2]])
    p = np.vstack([points, big])
    px, py = p[:, 0].tolist(), p[:, 1].tolist()
    at = lambda k: (px[k], py[k])
    corner, beside = [n, n + 1, n + 2], [-1, -1, -1]
    t = 0
    for k in _curve(points).tolist():
        x, y = px[k], py[k]
        moving = True
        while moving:
            moving = False
            for e, (u, v) in enumerate(((3 * t + 1, 3 * t + 2), (3 * t + 2, 3 * t), (3 * t, 3 * t + 1))):
                u, v = corner[u], corner[v]
                left, right = (px[u] - x) * (py[v] - y), (py[u] - y) * (px[v] - x)
                side = left - right
                if side < 4e-16 * (abs(left) + abs(right)) and (side < -4e-16 * (abs(left) + abs(right)) or _side(at(u), at(v), (x, y)) < 0):
                    t, moving = beside[3 * t + e], True
                    break
        if any(px[c] == x and py[c] == y for c in corner[3 * t : 3 * t + 3]):
            continue
        bad, stack, rim = {t}, [t], []
        while stack:
            f = stack.pop()
            for e in range(3 * f, 3 * f + 3):
                g = beside[e]
                if g in bad:
                    continue
                u, v = (corner[e + 1], corner[e + 2]) if e == 3 * f else (corner[e + 1], corner[e - 1]) if e == 3 * f + 1 else (corner[e - 2], corner[e - 1])
                if g < 0:
                    rim.append((u, v, -1))
                    continue
                a, b, c = corner[3 * g : 3 * g + 3]
                ax, ay, bx, by, cx, cy = px[a] - x, py[a] - y, px[b] - x, py[b] - y, px[c] - x, py[c] - y
                a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
                bc, cb, ca, ac, ab, ba = bx * cy, cx * by, cx * ay, ax * cy, ax * by, bx * ay
                d = a2 * (bc - cb) + b2 * (ca - ac) + c2 * (ab - ba)
                most = 1.2e-15 * (a2 * (abs(bc) + abs(cb)) + b2 * (abs(ca) + abs(ac)) + c2 * (abs(ab) + abs(ba)))
                if d > most or (d >= -most and _inside(at(a), at(b), at(c), (x, y)) > 0):
                    bad.add(g)
                    stack.append(g)
                else:
                    rim.append((u, v, 3 * g + beside[3 * g : 3 * g + 3].index(f)))
        free, starts, ends = list(bad), {}, {}
        for u, v, back in rim:
            if free:
                t = free.pop()
                corner[3 * t : 3 * t + 3] = k, u, v
                beside[3 * t] = back // 3 if back >= 0 else -1
            else:
                t = len(corner) // 3
                corner += (k, u, v)
                beside += (back // 3 if back >= 0 else -1, -1, -1)
            if back >= 0:
                beside[back] = t
            starts[u], ends[v] = t, t
        for u, v, _ in rim:
            f = starts[u]
            beside[3 * f + 1], beside[3 * f + 2] = starts[v], ends[u]
    triangles, beside = np.array(corner).reshape(-1, 3), np.array(beside).reshape(-1, 3)
    mine = (triangles < n).all(1)
    number = np.append(np.where(mine, np.cumsum(mine) - 1, -1), -1)
    return triangles[mine], number[beside[mine]]


def inner_triangles(points: np.ndarray) -> np.ndarray:
    """Six points (indices) for each triangle with one beyond each edge: its corners, the one opposite to its longest edge first,
    to its shortest last, and, in that order, the far corners of the triangles beyond."""
    triangles, beside = delaunay(points)
    inner = (beside >= 0).all(1)
    corners, beside = triangles[inner], beside[inner]
    sides = np.column_stack([((points[corners[:, (k + 2) % 3]] - points[corners[:, (k + 1) % 3]]) ** 2).sum(1) for k in range(3)])
    order = np.argsort(-sides, axis=1, kind="stable")
    far = np.empty_like(corners)
    for k in range(3):
        other = triangles[beside[:, k]]
        new = (other != corners[:, [(k + 1) % 3]]) & (other != corners[:, [(k + 2) % 3]])
        far[:, k] = other[np.arange(len(other)), new.argmax(1)]
    return np.column_stack([np.take_along_axis(corners, order, 1), np.take_along_axis(far, order, 1)]).astype(np.int32)


def _hashes(points: np.ndarray, six: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """v, centres and lengths of the longest edges of inner triangles."""
    k0, k1, k2 = (points[six[:, k]] for k in range(3))
    # The longest edge starts at the corner that the second longest shares with it; the third follows the triangle's turn.
    turn = np.where((k1[:, 0] - k0[:, 0]) * (k2[:, 1] - k0[:, 1]) > (k1[:, 1] - k0[:, 1]) * (k2[:, 0] - k0[:, 0]), -1.0, 1.0)
    edges = [k1 - k2, k0 - k2, (k1 - k0) * turn[:, None]]
    for k, (a, b) in enumerate(((k1, k2), (k0, k2), (k0, k1))):
        other = points[six[:, 3 + k]]
        to_a, to_b = other - a, other - b
        first = ((to_a**2).sum(1) >= (to_b**2).sum(1))[:, None]
        edges += [np.where(first, to_a, to_b), np.where(first, to_b, to_a)]
    return np.hstack(edges), (k0 + k1 + k2) / 3, np.sqrt((edges[0] ** 2).sum(1))


def triangle_hashes(points: np.ndarray) -> pd.DataFrame:
    """For each inner triangle: v (nine edges, 18 numbers), the centre c_0, c_1 and the longest edge's length.

    The three own edges come first, longest first; then, in that order, the two other edges of the triangle beyond
    each. Edges point so that the result does not depend on how corners are numbered.
    """
    v, centres, magnitude = _hashes(points, inner_triangles(points))
    return pd.DataFrame({"v": list(v), "c_0": centres[:, 0], "c_1": centres[:, 1], "magnitude": magnitude})


def hash_cells(cells: DataFrame, by: list[str], packed: bool = False) -> DataFrame:
    """Triangle hashes of every tile with more than three located cells.

    packed: a row for each tile, its points and six of them for each triangle, from which pairs of tiles make the hashes again: a
    tenth of their bytes, where a tile goes to many pairs.
    """
    ship(cells.sparkSession)
    types = dict(cells.dtypes)
    columns = ["points", "packed"] if packed else ["v", "c_0", "c_1", "magnitude"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) <= 3:
            return pd.DataFrame(columns=[*by, *columns])
        points = pdf[["i", "j"]].drop_duplicates().to_numpy(float)
        if packed:
            six = inner_triangles(points)
            out = pd.DataFrame({"points": [points.tobytes()], "packed": [six.tobytes()]} if len(six) else {c: [] for c in columns})
        else:
            out = triangle_hashes(points)
        for c in by:
            out[c] = pdf[c].iloc[0]
        return out[[*by, *columns]]

    kinds = "points binary, packed binary" if packed else "v array<double>, c_0 double, c_1 double, magnitude double"
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in by], kinds])
    return cells.where(F.col("i").isNotNull() & F.col("j").isNotNull()).select(*by, "i", "j").groupBy(*by).applyInPandas(run, schema)


#: Rows that a random model is tried on at once.
RANSAC_ROWS = 4096


def ransac_affine(x: np.ndarray, y: np.ndarray, threshold: float = 2.0, trials: int = 1000, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(rotation, translation, inliers) of y = x R^T + t by random triples, refitted on the inliers; None without a model."""
    if len(x) < 3:
        return None
    rng = np.random.default_rng(seed)
    ones = np.column_stack([x, np.ones(len(x))])
    best, most = None, -1
    for _ in range(trials):
        pick = rng.choice(len(x), 3, replace=False)
        try:
            m = np.linalg.solve(ones[pick], y[pick])
        except np.linalg.LinAlgError:
            continue
        # A model that has missed too many of the first rows to have more inliers than the best is left there.
        missed, parts = 0, []
        for first in range(0, len(x), RANSAC_ROWS):
            part = slice(first, first + RANSAC_ROWS)
            parts.append(((ones[part] @ m - y[part]) ** 2).sum(1) < threshold**2)
            missed += len(parts[-1]) - np.count_nonzero(parts[-1])
            if len(x) - missed <= most:
                break
        else:
            best, most = np.concatenate(parts), len(x) - missed
            if not missed:
                break
    if best is None or most < 3:
        return None
    m = np.linalg.lstsq(ones[best], y[best], rcond=None)[0]
    return m[:2].T, m[2], best


#: Distances that are held at once; rows in a leaf of the search tree, at most.
DISTANCES, LEAF = 1 << 20, 128


def nearest_hashes(va: np.ndarray, vb: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of va the nearest of vb and its distance, exact where that is under the threshold, else infinite or
    larger. By a tree of median splits: first in the leaf where a row falls, then in those whose box is nearer than the best."""
    nearest, best = np.zeros(len(va), int), np.full(len(va), float(threshold) ** 2)
    if not len(va) or not len(vb):
        return nearest, np.full(len(va), np.inf)
    # Turned so that few directions hold most of the spread: distances stay, boxes get tight.
    turn = np.linalg.eigh(np.cov(vb.T) if len(vb) > 1 else np.eye(vb.shape[1]))[1][:, ::-1]
    a, b = va @ turn, vb @ turn
    square_a, square_b = (a**2).sum(1), (b**2).sum(1)

    def meet(who: np.ndarray, leaf: np.ndarray) -> None:
        step = max(1, DISTANCES // len(leaf))
        for first in range(0, len(who), step):
            at = who[first : first + step]
            d = a[at] @ b[leaf].T
            d *= -2
            d += square_b[leaf]
            d += square_a[at][:, None]
            j = d.argmin(1)
            low = np.maximum(d[np.arange(len(at)), j], 0)
            less = low < best[at]
            best[at[less]], nearest[at[less]] = low[less], leaf[j[less]]

    nodes = []  # box, children or leaf, and the rows of a that fall there
    todo = [(np.arange(len(b)), np.arange(len(a)), -1, 0)]
    while todo:
        mine, who, above, side = todo.pop()
        box = b[mine].min(0), b[mine].max(0)
        axis = int((box[1] - box[0]).argmax())
        middle = np.median(b[mine, axis])
        if (b[mine, axis] >= middle).all():  # more than half are the least
            middle = np.nextafter(middle, np.inf)
        left = b[mine, axis] < middle
        if (box[0] == box[1]).all():
            mine = mine[:1]  # copies
        k = len(nodes)
        if above >= 0:
            nodes[above][2 + side] = k
        if len(mine) <= LEAF:
            nodes.append([*box, -1, -1, mine, who])
            if len(who):
                meet(who, mine)
            continue
        nodes.append([*box, -1, -1, None, None])
        low = a[who, axis] < middle
        todo += [(mine[left], who[low], k, 0), (mine[~left], who[~low], k, 1)]
    todo = [(0, np.arange(len(a)))]
    while todo:
        k, who = todo.pop()
        low, high, left, right, leaf, home = nodes[k]
        x = a[who]
        out = np.maximum(np.maximum(low - x, x - high), 0)
        who = who[(out**2).sum(1) < best[who] + 1e-12]
        if leaf is not None:
            own = np.zeros(len(who), bool) if not len(home) else np.isin(who, home, kind="sort" if len(who) < 64 else None)
            who = who[~own]
        if not len(who):
            continue
        if leaf is not None:
            meet(who, leaf)
        else:
            todo += [(left, who), (right, who)]
    distance = np.sqrt(((va - vb[nearest]) ** 2).sum(1))
    return nearest, np.where(best < float(threshold) ** 2, distance, np.inf)


def nearest_distance(points: np.ndarray, at: np.ndarray, limit: float) -> np.ndarray:
    """The distance of each of `at` to its nearest point, infinite beyond the limit."""
    middle = points.mean(0)
    return nearest_hashes(at - middle, points - middle, limit)[1]


def _unit(d: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in units of their longest edge, and centres, of a hash table or a packed tile."""
    if "packed" in d:
        six = np.frombuffer(d["packed"].iloc[0], np.int32).reshape(-1, 6)
        v, centres, magnitude = _hashes(np.frombuffer(d["points"].iloc[0]).reshape(-1, 2), six)
    else:
        v, centres, magnitude = np.stack(d["v"].to_numpy()), d[["c_0", "c_1"]].to_numpy(float), d["magnitude"].to_numpy()
    return v / magnitude[:, None], centres


def evaluate_match(a: pd.DataFrame, b: pd.DataFrame, hash_threshold: float = 0.3, point_threshold: float = 2.0, near: float = 50.0, seed: int = 42) -> tuple[np.ndarray | None, np.ndarray | None, float]:
    """Rotation, translation and score of two hash tables; score -1 where fewer than five hashes meet.

    The score is the share of b's centres, among those that have one of a's moved centres within `near`, that have one within
    point_threshold. That distance bounds the model's residuals too: a triple of wrong matches can't win by being vague.
    """
    if not len(a) or not len(b):
        return None, None, -1.0
    (va, ca), (vb, cb) = _unit(a), _unit(b)
    if not len(va) or not len(vb):
        return None, None, -1.0
    nearest, distance = nearest_hashes(va, vb, hash_threshold)
    met = distance < hash_threshold
    if met.sum() < 5:
        return None, None, -1.0
    model = ransac_affine(ca[met], cb[nearest[met]], point_threshold, seed=seed)
    if model is None:
        return None, None, -1.0
    rotation, translation, _ = model
    moved = ca @ rotation.T + translation
    low = nearest_distance(moved, cb, near)
    close = low < near
    return rotation, translation, float((low[close] < point_threshold).mean()) if close.any() else 0.0


def align_pairs(hashes_0: DataFrame, hashes_1: DataFrame, pairs: DataFrame, keys: list[str], **options) -> DataFrame:
    """keys, tile, site, rotation, translation, score and determinant of each (tile, site) pair, all pairs at once. hashes_0 and
    hashes_1: as hash_cells gives them, packed or not."""
    ship(hashes_0.sparkSession)
    types = dict(hashes_0.dtypes)
    left = hashes_0.join(pairs, [*keys, "tile"])
    right = hashes_1.withColumnRenamed("tile", "site").join(pairs, [*keys, "site"])

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        r, t, s = evaluate_match(a, b, **options)
        row = {**dict(zip([*keys, "tile", "site"], key)), "rotation": None if r is None else r.tolist(), "translation": None if t is None else t.tolist(), "score": s, "determinant": None if r is None else float(np.linalg.det(r))}
        return pd.DataFrame([row])

    by = [*keys, "tile", "site"]
    t_site = dict(hashes_1.dtypes)["tile"]
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keys], f"tile {types['tile']}, site {t_site}, rotation array<array<double>>, translation array<double>, score double, determinant double"])
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, schema)


def multistep_alignment(hashes_0: DataFrame, hashes_1: DataFrame, where_0: DataFrame, where_1: DataFrame, seeds: DataFrame, keys: list[str], determinants: tuple[float, float] = (0.9, 1.1), score: float = 0.1, batch: int = 180, **options) -> DataFrame:
    """Alignment from seed pairs outwards: a stage-coordinate model from the good pairs picks the next closest untested ones.

    It ends when a batch brings no good pair, or no pair is left.
    where_0, where_1: keys, tile / site, x_pos, y_pos. Tables of tiles, hundreds a well, are what the driver sees.
    """
    # Every batch of pairs reads the hashes.
    hashes_0, hashes_1 = materialize(hashes_0, "hashes"), materialize(hashes_1, "hashes")
    good = lambda d: d[d["determinant"].between(*determinants) & (d["score"] > score)]
    done = align_pairs(hashes_0, hashes_1, seeds, keys, **options).toPandas()
    a, b = where_0.toPandas(), where_1.toPandas()
    while True:
        fine = good(done)
        todo = []
        for key, g in fine.groupby(keys) if keys else [((), fine)]:
            key = key if isinstance(key, tuple) else (key,)
            mine = lambda d: d[(d[keys] == list(key)).all(1)] if keys else d  # noqa: E731,B023
            ta, tb = mine(a), mine(b)
            xy = g.merge(ta, on=[*keys, "tile"]).merge(tb, on=[*keys, "site"], suffixes=("_0", "_1"))
            model = ransac_affine(xy[["x_pos_0", "y_pos_0"]].to_numpy(float), xy[["x_pos_1", "y_pos_1"]].to_numpy(float), threshold=1e3)
            if model is None:
                continue
            moved = ta[["x_pos", "y_pos"]].to_numpy(float) @ model[0].T + model[1]
            d = np.sqrt(((moved[:, None] - tb[["x_pos", "y_pos"]].to_numpy(float)[None]) ** 2).sum(-1))
            tested = set(zip(mine(done)["tile"], mine(done)["site"]))
            order = [(i, j) for i, j in zip(*np.unravel_index(np.argsort(d, axis=None, kind="stable"), d.shape)) if (ta["tile"].iloc[i], tb["site"].iloc[j]) not in tested][:batch]
            todo += [(*key, ta["tile"].iloc[i], tb["site"].iloc[j]) for i, j in order]
        if not todo:
            break
        more = align_pairs(hashes_0, hashes_1, hashes_0.sparkSession.createDataFrame(pd.DataFrame(todo, columns=[*keys, "tile", "site"])), keys, **options)
        more = materialize(more, "alignment").toPandas()
        before = len(good(done))
        done = pd.concat([done, more], ignore_index=True)
        if len(good(done)) == before:
            break
    schema = align_pairs(hashes_0, hashes_1, seeds, keys, **options).schema
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in good(done)[schema.names].itertuples(index=False)]
    return hashes_0.sparkSession.createDataFrame(rows, schema)


def thin_plate(x: np.ndarray, y: np.ndarray, at: np.ndarray, smoothing: float = 10.0) -> np.ndarray:
    """Values at `at` of the smoothing thin-plate spline through (x, y): kernel r^2 log r and a plane."""

    def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        r2 = ((a[:, None] - b[None]) ** 2).sum(-1)
        return 0.5 * r2 * np.log(np.where(r2 > 0, r2, 1))

    plane = lambda p: np.column_stack([np.ones(len(p)), p - x.mean(0)])
    n = len(x)
    left = np.zeros((n + 3, n + 3))
    left[:n, :n], left[:n, n:], left[n:, :n] = kernel(x, x) + smoothing * np.eye(n), plane(x), plane(x).T
    w = np.linalg.lstsq(left, np.vstack([y, np.zeros((3, y.shape[1]))]), rcond=None)[0]
    return kernel(at, x) @ w[:n] + plane(at) @ w[n:]


def refine_warp(x: np.ndarray, y: np.ndarray, predicted: np.ndarray, threshold: float, degree: int = 2, rounds: int = 2, least: int = 30, model: str = "polynomial", smoothing: float = 10.0, most: int = 700) -> np.ndarray:
    """Predictions of x refitted by a warp on those pairs where a point of y has its nearest prediction within the threshold;
    as they are where fewer than `least` have. polynomial: of x, of this degree; thin_plate: of the predictions, on at most
    `most` anchors, a seeded choice."""

    def terms(p: np.ndarray) -> np.ndarray:
        p = (p - x.mean(0)) / np.maximum(np.ptp(x, axis=0), 1e-9)
        return np.column_stack([p[:, 0] ** a * p[:, 1] ** b for a in range(degree + 1) for b in range(degree + 1 - a)])

    for _ in range(rounds):
        d = np.sqrt(((y[:, None] - predicted[None]) ** 2).sum(-1))
        nearest, sure = d.argmin(1), d.min(1) < threshold
        if sure.sum() < least:
            break
        if model == "thin_plate":
            pick = np.flatnonzero(sure)
            if len(pick) > most:
                pick = np.sort(np.random.default_rng(0).choice(pick, most, replace=False))
            predicted = thin_plate(predicted[nearest[pick]], y[pick], predicted, smoothing)
        else:
            predicted = terms(x) @ np.linalg.lstsq(terms(x[nearest[sure]]), y[sure], rcond=None)[0]
    return predicted


def warp_by_pair(moved: DataFrame, other: DataFrame, keys: list[str], threshold: float, **options) -> DataFrame:
    """moved (keys, id, x and y before, i and j after an alignment) with i and j refined on other (keys, i, j), pair by pair.

    A pair of tiles is a bounded group; the two tables meet in a co-group.
    """
    ship(moved.sparkSession)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) and len(b):
            a = a.copy()
            a[["i", "j"]] = refine_warp(a[["x", "y"]].to_numpy(float), b[["i", "j"]].to_numpy(float), a[["i", "j"]].to_numpy(float), threshold, **options)
        return a

    return moved.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInPandas(run, moved.schema)


def alignment_parameters(aligned: DataFrame, keys: list[str], scale: float = 1.0, approach: str = "triangle_hash", kind: str = "affine", reason: str = "no_match") -> DataFrame:
    """One flat row for each alignment: rotation_flat, translation, scale, score, determinant, kind and approach.

    An alignment without a model becomes the identity, of kind failed_{reason}.
    """
    failed = F.col("rotation").isNull()
    one = lambda *x: F.array(*map(F.lit, x))
    flat = F.when(failed, one(1.0, 0.0, 0.0, 1.0)).otherwise(F.flatten("rotation"))
    out = aligned.select(*keys, flat.alias("rotation_flat"), F.when(failed, one(0.0, 0.0)).otherwise(F.col("translation")).alias("translation"), F.lit(float(scale)).alias("scale"), F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(0.0)).alias("score"), failed.alias("f_"))
    r = lambda k: F.col("rotation_flat")[k]
    out = out.withColumns({"determinant": r(0) * r(3) - r(1) * r(2), "kind": F.when(F.col("f_"), F.lit(f"failed_{reason}")).otherwise(F.lit(kind)), "approach": F.when(F.col("f_"), F.lit("identity")).otherwise(F.lit(approach))})
    return out.drop("f_")


def alignment_summary(parameters: DataFrame, hashes_0: DataFrame, hashes_1: DataFrame, keys: list[str], threshold: float = 0.1, overlap: float | None = None) -> DataFrame:
    """A row for each alignment to report: status, rounded parameters, and the triangles on either side."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    out = parameters.join(count(hashes_0, "triangles_0"), keys, "left").join(count(hashes_1, "triangles_1"), keys, "left").na.fill(0, ["triangles_0", "triangles_1"])
    r = {f"r{i}{j}": F.round(F.col("rotation_flat")[2 * i + j], 6) for i in range(2) for j in range(2)}
    good = ~F.col("kind").startswith("failed") & (F.col("score") >= threshold)
    more = {"status": F.when(good, "success").otherwise("failed"), "t0": F.round(F.col("translation")[0], 3), "t1": F.round(F.col("translation")[1], 3), "overlap": F.lit(None if overlap is None else round(overlap, 3)).cast("double")}
    out = out.withColumns(r | more).withColumns({"score": F.round("score", 3), "determinant": F.round("determinant", 6), "scale": F.round("scale", 6)})
    return out.drop("rotation_flat", "translation")


def align_regionally(cells_0: DataFrame, cells_1: DataFrame, keys: list[str], size: float, score: float = 0.1, least: int = 100, attempts: int = 3, growth: float = 1.5, **options) -> DataFrame:
    """keys, rotation, translation, score, determinant, region and attempts: each well aligned by the triangles of a square in
    the middle of what both tables cover. A well that fails gets a larger square, up to 0.8 of the common extent.

    cells_0 and cells_1: keys, i, j, in one scale. All wells of an attempt are aligned at once; the driver sees a row for each.
    """
    box = lambda df, k: df.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}_{k}") for c in "ij" for n, f in (("low", F.min), ("high", F.max))])
    both = box(cells_0, 0).join(box(cells_1, 1), keys)
    low = {c: F.greatest(f"low_{c}_0", f"low_{c}_1") for c in "ij"}
    high = {c: F.least(f"high_{c}_0", f"high_{c}_1") for c in "ij"}
    extent = F.least(*[F.col(f"high_{c}_{k}") - F.col(f"low_{c}_{k}") for c in "ij" for k in (0, 1)])
    wells = materialize(both.select(*keys, *[((low[c] + high[c]) / 2).alias(f"m_{c}") for c in "ij"], (0.8 * extent).alias("most")), "wells")
    done: DataFrame | None = None
    for k in range(1, attempts + 1):
        region = size * growth ** (k - 1)
        todo = wells.where(F.col("most") >= region)
        if done is not None:
            todo = todo.join(done.select(*keys), keys, "left_anti")
        todo = materialize(todo, "wells_left")
        if todo.isEmpty():
            break

        def inside(df: DataFrame) -> DataFrame:
            near = df.join(todo, keys).where((F.abs(F.col("i") - F.col("m_i")) <= region / 2) & (F.abs(F.col("j") - F.col("m_j")) <= region / 2))  # noqa: B023
            return hash_cells(near.withColumn("tile", F.lit(0)), [*keys, "tile"])

        a, b = materialize(inside(cells_0), "hashes"), materialize(inside(cells_1), "hashes")
        count = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
        enough = count(a, "n_0").join(count(b, "n_1"), keys).where((F.col("n_0") >= least) & (F.col("n_1") >= least))
        pairs = enough.select(*keys, F.lit(0).alias("tile"), F.lit(0).alias("site"))
        found = align_pairs(a, b, pairs, keys, **options).where(F.col("score") >= score)
        found = materialize(found.drop("tile", "site").withColumns({"region": F.lit(float(region)), "attempts": F.lit(k)}), "aligned")
        done = found if done is None else done.unionByName(found)
    if done is None:
        types = dict(cells_0.dtypes)
        return wells.sparkSession.createDataFrame([], ", ".join([*[f"`{c}` {types[c]}" for c in keys], "rotation array<array<double>>, translation array<double>, score double, determinant double, region double, attempts int"]))
    return done


def solve_positions(edges: pd.DataFrame, tiles: list[int]) -> pd.DataFrame:
    """Tile positions by least squares of pairwise shifts (a, b, di, dj), the first tile at the origin.

    By the normal equations, tiles by tiles whatever the number of edges; where edges leave tiles apart from the first,
    theirs is the solution of least norm.
    """
    at = {t: k for k, t in enumerate(tiles)}
    a, b = (edges[c].map(at).to_numpy(int) for c in "ab")
    shift = edges[["di", "dj"]].to_numpy(float)
    n = len(tiles)
    m, rhs = np.zeros((n, n)), np.zeros((n, 2))
    for x, y, sign in ((a, a, 1), (b, b, 1), (a, b, -1), (b, a, -1)):
        np.add.at(m, (x, y), sign)
    np.add.at(rhs, b, shift)
    np.add.at(rhs, a, -shift)
    m[0, 0] += 1
    reached, new = np.zeros(n, bool), np.arange(n) == 0
    while new.any():
        reached |= new
        new = (m[new] != 0).any(0) & ~reached
    p = np.linalg.solve(m, rhs) if reached.all() else np.linalg.lstsq(m, rhs, rcond=None)[0]
    return pd.DataFrame({"tile": tiles, "i": p[:, 0], "j": p[:, 1]})
