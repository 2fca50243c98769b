"""Array kernels for images, used by the Arrow functions of `stencil`, `regions`, `mask` and `sun`.

Every function takes and returns NumPy arrays of a single image, or of a stack of images of one
size (stack, H, W), so that small pictures share the cost of a call; Spark decides which images a
task holds. Each kernel is linear in the pixels of its images.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

# fixed values: 2 * sigma^2 of the bilateral filter (sigma 50), its disc radius,
# and tan(22.5 deg), tan(67.5 deg) times 100000 for the gradient sectors
SPREAD = 5000.0
DISC_RADIUS = 2
SECTOR_LOW, SECTOR_HIGH = 41421, 241421

# for a pair of pixels that differ by d = -1023 .. 1023, at d + _MOST: its weight, 0 where one of them is outside the image, and the weight times d
_MOST = 1023
_APART = np.arange(-_MOST, _MOST + 1.0)
_CLOSENESS = np.where(np.abs(_APART) < 256, np.exp(-_APART**2 / SPREAD), 0.0)
_OUTSIDE = 512
_BLOCK = 1 << 14  # pixels whose arrays stay in a core's cache together


def grey(bgr: np.ndarray) -> np.ndarray:
    """Rounded luma of (..., H, W, 3) images."""
    b, g, r = (bgr[..., k].astype(np.int32) for k in range(3))
    return (299 * r + 587 * g + 114 * b + 500) // 1000


def smooth(image: np.ndarray) -> np.ndarray:
    """Bilateral filter (Tomasi & Manduchi 1998); taps outside the image are left out. Values are 0..255.

    Two pixels weigh the same for each other, so a weight is looked up once for both, with its product with their
    difference as the imaginary part; the other pixel takes the conjugate. The images lie in one flat array with cells
    of no weight between them, so that a tap is a shift of the whole array, and no index is negative.
    """
    high, wide = image.shape[-2:]
    reach = range(-DISC_RADIUS, DISC_RADIUS + 1)
    near = ((dy, dx) for dy in reach for dx in reach if dy * dy + dx * dx <= DISC_RADIUS**2 and (dy, dx) > (0, 0))
    taps = [(dy * (wide + DISC_RADIUS) + dx, _CLOSENESS * np.exp(-(dy * dy + dx * dx) / SPREAD)) for dy, dx in near]
    taps = [(shift, weight + 1j * (weight * _APART)) for shift, weight in taps]
    stack = image.reshape(-1, high, wide)
    out = np.empty(stack.shape, np.int32)
    step = max(1, _BLOCK // max(1, high * wide))
    for i in range(0, len(stack), step):
        some = stack[i : i + step]
        cells = np.full((len(some), high + DISC_RADIUS, wide + DISC_RADIUS), _OUTSIDE, np.intp)
        cells[:, :high, :wide] = some
        flat = cells.ravel()
        raised = flat + _MOST
        total, apart, found = np.ones(flat.size, complex), np.empty(flat.size, np.intp), np.empty(flat.size, complex)
        for shift, both in taps:
            d = np.subtract(raised[shift:], flat[:-shift], out=apart[: flat.size - shift])
            w = both.take(d, out=found[: d.size], mode="clip")
            total[:-shift] += w
            total[shift:] += np.conjugate(w, out=w)
        lead = total.imag / total.real
        out[i : i + step] = np.floor(np.round(some + lead.reshape(cells.shape)[:, :high, :wide], 6) + 0.5)
    return out.reshape(image.shape)


def derivatives(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sobel gx, gy; the border pixel repeats outwards."""
    ring = np.pad(image, _ring(image), mode="edge")
    rows = ring[..., :-2, :] + 2 * ring[..., 1:-1, :] + ring[..., 2:, :]
    cols = ring[..., :-2] + 2 * ring[..., 1:-1] + ring[..., 2:]
    return rows[..., 2:] - rows[..., :-2], cols[..., 2:, :] - cols[..., :-2, :]


def _ring(image: np.ndarray) -> list[tuple[int, int]]:
    return [(0, 0)] * (image.ndim - 2) + [(1, 1)] * 2


def ridges(gx: np.ndarray, gy: np.ndarray, low: int = 0) -> np.ndarray:
    """Gradient magnitude where it is above `low` and peaks across the gradient direction, else 0 (Canny 1986).

    Only pixels above `low` look at their neighbours.
    """
    mag = np.abs(gx) + np.abs(gy)
    ring = np.pad(mag, _ring(mag))
    flat, span = ring.ravel(), ring.shape[-1]
    above, here = mag > low, np.flatnonzero(ring > low)
    gx, gy = gx[above].astype(np.int32), gy[above].astype(np.int32)
    ax, ay = np.abs(gx), np.abs(gy)
    sectors = [ay * 100000 < ax * SECTOR_LOW, ay * 100000 > ax * SECTOR_HIGH, gx * gy >= 0]
    across = np.select(sectors, [1, span, span + 1], span - 1)
    own = flat[here]
    peak = (own > flat[here - across]) & (own >= flat[here + across])
    out = np.zeros(mag.shape, mag.dtype)
    out[above] = np.where(peak, own, 0)
    return out


def sweep(image: np.ndarray, size: int, pick) -> np.ndarray:
    """Separable size x size minimum or maximum, clipped at the border."""
    for rest in ((slice(None),), ()):
        best = image.copy()
        for d in range(1, min(size // 2, image.shape[-1 - len(rest)] - 1) + 1):
            after, before = (..., slice(d, None), *rest), (..., slice(None, -d), *rest)
            best[after] = pick(best[after], image[before])
            best[before] = pick(best[before], image[after])
        image = best
    return image


def linked_runs(flat: np.ndarray, span: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True in a flat image with rows of `span` pixels: start, length, and component (index of its first run).

    A row's end goes on into the next row: the caller has a ring around the image that is either
    background or of one component. Runs of neighbouring rows touch when they overlap after growing by
    `reach` pixels: 1 joins diagonal neighbours, 0 does not. Smallest labels hook onto each other and
    paths are compressed until nothing changes.
    """
    edge = np.flatnonzero(flat[1:] != flat[:-1]) + 1
    if flat.size and flat[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, flat.size)
    left, right = edge[::2], edge[1::2] - 1
    first = np.searchsorted(right, left + span - reach)
    last = np.searchsorted(left, right + span + reach, side="right")
    count = np.maximum(last - first, 0)
    upper = np.repeat(np.arange(len(left)), count)
    lower = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)
    label = np.arange(len(left))
    while not np.array_equal(label[upper], label[lower]):
        low = np.minimum(label[upper], label[lower])
        for side in (upper, lower):
            np.minimum.at(label, label[side], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
    return left, right - left + 1, label


def components(image: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Connected runs of a binary image: flat start, length, and component (index of its first run); see `linked_runs`."""
    wide = image.shape[1]
    start, length, label = linked_runs(np.pad(image.astype(bool), ((0, 0), (1, 1))).ravel(), wide + 2, reach)
    y, x = np.divmod(start, wide + 2)
    return y * wide + x - 1, length, label


def spread_runs(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat pixel positions of runs, and the run of each."""
    run = np.repeat(np.arange(len(start)), length)
    ahead = np.cumsum(length) - length
    return np.arange(length.sum()) - ahead[run] + start[run], run


def fill(image: np.ndarray) -> np.ndarray:
    """Binary image with background that no 4-connected path links to the border set to 1."""
    high, wide = image.shape
    start, length, label = components(image == 0, 0)
    y, x = np.divmod(start, wide)
    outside = np.zeros(len(start), bool)
    outside[label[(y == 0) | (y == high - 1) | (x == 0) | (x + length == wide)]] = True
    filled = np.ones(high * wide, bool)
    filled[spread_runs(start, length)[0][np.repeat(outside[label], length)]] = False
    return filled.reshape(high, wide)


def largest(image: np.ndarray) -> np.ndarray:
    """The 8-connected component with most pixels, of equals the one that starts first."""
    start, length, label = components(image, 1)
    kept = np.zeros(image.size, bool)
    if len(start):
        best = np.bincount(label, length).argmax()
        kept[spread_runs(start, length)[0][np.repeat(label == best, length)]] = True
    return kept.reshape(image.shape)


def flat_ring(stack: np.ndarray) -> np.ndarray:
    """The images of a stack below each other as one image, each in a ring of background: no component spans two."""
    ring = np.zeros((len(stack), stack.shape[1] + 2, stack.shape[2] + 2), stack.dtype)
    ring[:, 1:-1, 1:-1] = stack
    return ring.reshape(-1, ring.shape[-1])


def _unringed(flat: np.ndarray, shape: tuple[int, int, int]) -> np.ndarray:
    return flat.reshape(shape[0], shape[1] + 2, shape[2] + 2)[:, 1:-1, 1:-1]


def fill_each(stack: np.ndarray) -> np.ndarray:
    """`fill` for each image of a stack."""
    if not stack.size:
        return stack
    ring = flat_ring(stack)
    flat = ring.ravel()
    start, length, label = linked_runs(~flat, ring.shape[1], 0)
    inside = label != label[0]  # the rings are one component, and it comes first
    flat[spread_runs(start[inside], length[inside])[0]] = True
    return _unringed(ring, stack.shape)


def parts_of(stack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-connected components of each image: for each run its image, start (y * W + x) and length, and its
    component (index of the component's first run); the pixels of the component that each run names, else 0."""
    wide = stack.shape[2] + 2
    start, length, label = linked_runs(flat_ring(stack).ravel(), wide, 1)
    y, x = np.divmod(start, wide)
    image, y = np.divmod(y, stack.shape[1] + 2)
    area = np.bincount(label, length, minlength=len(start)).astype(np.int64)
    return image, (y - 1) * stack.shape[2] + x - 1, length, label, area


def ranks(image: np.ndarray, label: np.ndarray, area: np.ndarray) -> np.ndarray:
    """For each run the rank of its component in its image, from 0: largest first, of equals the one that starts first."""
    roots = np.flatnonzero(label == np.arange(len(label)))
    order = roots[np.lexsort((roots, -area[roots], image[roots]))]
    first = np.searchsorted(image[order], image[order])
    rank = np.zeros(len(label), np.int64)
    rank[order] = np.arange(len(order)) - first
    return rank[label]


def drawn(shape: tuple[int, int, int], image: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A stack with the given runs as foreground."""
    out = np.zeros(shape, bool)
    out.ravel()[spread_runs(image * (shape[1] * shape[2]) + start, length)[0]] = True
    return out


def largest_each(stack: np.ndarray) -> np.ndarray:
    """`largest` for each image of a stack."""
    image, start, length, label, area = parts_of(stack)
    best = ranks(image, label, area) == 0
    return drawn(stack.shape, image[best], start[best], length[best])


def flat_runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Image, start and length of the runs of True in each flattened image of a stack; a run may go on into the next row."""
    # a cell of background before the first image and after each
    wide = (flags[0].size if len(flags) else 0) + 1
    flat = np.zeros(len(flags) * wide + 1, bool)
    flat[1:].reshape(len(flags), wide)[:, :-1] = flags.reshape(len(flags), wide - 1)
    edge = np.flatnonzero(flat[1:] != flat[:-1])
    image, start = np.divmod(edge[::2], wide)
    return image, start, edge[1::2] - edge[::2]


def linked_edges(magnitude: np.ndarray, low: int, high: int) -> np.ndarray:
    """Hysteresis for each image of a stack: 8-connected ridges above `low` that somewhere exceed `high`."""
    top = np.flatnonzero(magnitude > high)
    if not len(top):
        return np.zeros(magnitude.shape, bool)
    image, start, length, label, _ = parts_of(magnitude > low)
    start = image * magnitude[0].size + start
    strong = np.zeros(len(label), bool)
    strong[label[np.searchsorted(start, top, side="right") - 1]] = True
    chosen = strong[label]
    out = np.zeros(magnitude.size, bool)
    out[spread_runs(start[chosen], length[chosen])[0]] = True
    return out.reshape(magnitude.shape)


def sunny(bgr: np.ndarray, limit: int) -> np.ndarray:
    """Pixels of (..., H, W, 3) images whose hue in half degrees is at most `limit`; see `functions.color.is_sun_hue`."""
    b, g, r = (bgr[..., k].astype(np.int32) for k in range(3))
    top = np.maximum(np.maximum(b, g), r)
    span, lead = top - np.minimum(np.minimum(b, g), r), (g - b) * 60
    return (span == 0) | ((top == r) & (lead >= -span) & (lead < span * (2 * limit + 1)))


def row_ends(start: np.ndarray, length: np.ndarray, wide: int) -> np.ndarray:
    """(2, n): x and y of the first and last pixels of the runs of an image. They hold every corner of the convex hull."""
    y, x = np.divmod(start, wide)
    return np.stack([np.concatenate([x, x + length - 1]), np.concatenate([y, y])]).astype(float)


def _circumcircle(p: np.ndarray) -> tuple[float, float, float] | None:
    """x, y and squared radius of the smallest circle with all of one, two or three points (rows) on its rim."""
    x, y = p[0]
    if len(p) == 1:
        return x, y, 0.0
    ax, ay = p[1] - p[0]
    if len(p) == 2:
        return x + ax / 2, y + ay / 2, (ax * ax + ay * ay) / 4
    bx, by = p[2] - p[0]
    area, a2, b2 = 2 * (ax * by - ay * bx), ax * ax + ay * ay, bx * bx + by * by
    if area == 0:
        return None
    ux, uy = (by * a2 - ay * b2) / area, (ax * b2 - bx * a2) / area
    return x + ux, y + uy, ux * ux + uy * uy


def enclosing_circle(points: np.ndarray) -> tuple[float, float, float]:
    """x, y and radius of the smallest circle around (2, n) points.

    The circle of a few rim points grows by the farthest point outside of it, and the smallest
    circle of those few is found by trying; its radius grows each time, so that ends.
    """
    rim = points[:, :1].T
    x, y, r2 = _circumcircle(rim)
    while True:
        d = (points[0] - x) ** 2 + (points[1] - y) ** 2
        far = int(d.argmax())
        if d[far] <= r2 * (1 + 1e-12) + 1e-9:
            return x, y, float(np.sqrt(r2))
        some = np.vstack([rim, points[:, far]])
        best = None
        for k in (2, 3):
            for chosen in combinations(range(len(some) - 1), k - 1):
                rows = some[[*chosen, -1]]
                if (c := _circumcircle(rows)) is None or best is not None and c[2] >= best[0][2]:
                    continue
                if ((some[:, 0] - c[0]) ** 2 + (some[:, 1] - c[1]) ** 2 <= c[2] * (1 + 1e-12) + 1e-9).all():
                    best = c, rows
        (x, y, r2), rim = best


def disc(cx: int, cy: int, r: int, high: int, wide: int, top: int = 0, left: int = 0) -> np.ndarray:
    """Pixels within r of a centre, in the part of an image that starts at (top, left)."""
    y, x = np.ogrid[top : top + high, left : left + wide]
    return (x - cx) ** 2 + (y - cy) ** 2 <= r * r
