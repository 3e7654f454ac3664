"""Array kernels in numpy, used where a tile or a thumbnail is one value: they run inside Arrow batches on the executors."""

from __future__ import annotations

import numpy as np

# Reference stain vectors, reference maxima, and reference Lab statistics.
STAINS = np.array([[0.5626, 0.2159], [0.7201, 0.8012], [0.4062, 0.5581]])
STAIN_MAXIMA = np.array([1.9705, 1.0308])
LAB_MEANS, LAB_STDS = (65.22132, 28.934267, -14.142519), (15.800227, 9.263783, 6.0213304)


def otsu(values: np.ndarray, bins: int = 256) -> float:
    """The bin centre that parts values with the greatest variance between the two sides; the first of equals."""
    values = np.asarray(values, float).ravel()
    low, high = values.min(), values.max()
    if low == high:
        return float(low)
    counts = np.bincount(np.minimum(((values - low) / (high - low) * bins).astype(int), bins - 1), minlength=bins).astype(float)
    centres = low + (np.arange(bins) + 0.5) * (high - low) / bins
    w1, w2 = np.cumsum(counts), np.cumsum(counts[::-1])[::-1]
    m1 = np.cumsum(counts * centres) / np.maximum(w1, 1)
    m2 = np.cumsum((counts * centres)[::-1])[::-1] / np.maximum(w2, 1)
    return float(centres[np.argmax(w1[:-1] * w2[1:] * (m1[:-1] - m2[1:]) ** 2)])


def dilate(mask: np.ndarray, size: int) -> np.ndarray:
    """Maximum over a size x size window; even windows reach one further up and left than down and right."""
    before, after = size // 2, size - 1 - size // 2
    out = mask.astype(bool)
    for axis in (0, 1):
        grown = out.copy()
        for k in range(-before, after + 1):
            moved = np.roll(out, -k, axis)
            edge = [slice(None)] * 2
            edge[axis] = slice(-k, None) if k > 0 else slice(None, -k)
            if k:
                edge[axis] = slice(out.shape[axis] - k, None) if k > 0 else slice(0, -k)
                moved[tuple(edge)] = False
            grown |= moved
        out = grown
    return out


def _parts(masks: np.ndarray, diagonal: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs within the rows of masks (n, h, w), in order: the mask and the length of each, and the first run of its connected part.

    All runs are joined at once: in every round the ends of a pair that differ are hung from the lesser one, until none differs.
    """
    n, h, w = masks.shape
    padded = np.zeros((n, h, w + 2), np.int8)
    padded[:, :, 1:-1] = masks
    step = np.diff(padded, axis=2)
    image, row, start = np.nonzero(step == 1)
    end = np.nonzero(step == -1)[2]
    # places grow from row to row, and an empty row lies between two masks; a run meets those of the row above that end behind its start and start before its end
    reach, at = (1 if diagonal else 0), (image * (h + 1) + row) * (w + 4)
    above = at - (w + 4)
    low, high = np.searchsorted(at + end, above + start - reach, "right"), np.searchsorted(at + start, above + end + reach, "left")
    many = np.maximum(high - low, 0)
    i = np.repeat(np.arange(len(at)), many)
    j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    up = np.arange(len(at))
    while True:
        a, b = up[i], up[j]
        apart = a != b
        if not apart.any():
            return image, end - start, up
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up, top := up[up]):
            up = top


def components(mask: np.ndarray, diagonal: bool = True) -> tuple[np.ndarray, int]:
    """Labels from 1 of the connected parts of a mask, by runs within rows joined to those of the row above."""
    _, length, first = _parts(mask.astype(bool)[None], diagonal)
    known, number = np.unique(first, return_inverse=True)
    labels = np.zeros(mask.shape, np.int32)
    labels[mask.astype(bool)] = np.repeat(number + 1, length)
    return labels, len(known)


def component_numbers(masks: np.ndarray) -> np.ndarray:
    """How many connected parts each of masks (n, h, w) has, corners included."""
    image, _, first = _parts(masks, True)
    return np.bincount(image[first == np.arange(len(first))], minlength=len(masks))


def remove_small(mask: np.ndarray, min_size: float | None = None, compat: bool = False, size: int = 2) -> np.ndarray:
    """mask without parts under min_size (1 % of the largest part by default), then dilated. compat: nothing is ever removed."""
    labels, n = components(mask)
    if n == 0:
        return mask.astype(bool)
    areas = np.bincount(labels.ravel(), minlength=n + 1)[1:]
    least = areas.max() * 0.01 if min_size is None else min_size
    kept = mask.astype(bool) if compat else np.concatenate([[False], areas >= least])[labels]
    return dilate(kept, size) if size > 1 else kept


def fill_holes(mask: np.ndarray, share: float = 0.0001) -> np.ndarray:
    """mask with background parts of less than a share of the area filled; parts touch by their sides."""
    labels, n = components(~mask.astype(bool), diagonal=False)
    areas = np.bincount(labels.ravel(), minlength=n + 1)
    small = areas < mask.size * share
    small[0] = False
    return mask.astype(bool) | small[labels]


def folds(r: np.ndarray, g: np.ndarray, b: np.ndarray, otsu_mask: np.ndarray, alpha: float = 0.65, beta: float = 0.34, min_size: int = 64, compat: bool = False) -> np.ndarray:
    """True where tissue isn't folded. Folds are dark and saturated: thresholds on S - V come from how many parts each leaves."""
    if compat:
        return np.ones(r.shape, bool)
    high, low = np.maximum(np.maximum(r, g), b).astype(int), np.minimum(np.minimum(r, g), b).astype(int)
    s = np.where(high == 0, 0, np.floor((high - low) * 255.0 / np.maximum(high, 1) + 0.5)) / 255
    counts = np.cumsum(np.bincount(high.ravel(), minlength=256))
    base = counts[counts > 0][0]
    even = np.zeros(256) if base == high.size else np.floor((counts - base) * 255.0 / (high.size - base) + 0.5)
    d = s - even[high] / 255
    thresholds = np.round(np.arange(-1.0, 1.01, 0.05), 2)
    # thresholds between which no pixel lies leave the same parts; some million pixels are joined at a time
    _, own, same = np.unique(np.searchsorted(np.sort(d, axis=None), thresholds, "right"), return_index=True, return_inverse=True)
    most = max(1, (1 << 21) // d.size)
    parts = np.concatenate([component_numbers(d > thresholds[own[k : k + most], None, None]) for k in range(0, len(own), most)])[same]
    hard, soft = (thresholds[np.flatnonzero(parts >= q * parts.max())[-1]] for q in (alpha, beta))
    mask = remove_small((d > soft) & dilate(d > hard, 5), min_size)
    tissue = np.count_nonzero(otsu_mask)
    return np.ones(r.shape, bool) if tissue == 0 or np.count_nonzero(mask) / tissue > 0.7 else ~mask


def tissue(x: np.ndarray, y: np.ndarray, rgb: tuple[np.ndarray, np.ndarray, np.ndarray], marks: dict[str, np.ndarray], grown: dict[str, int], limits: dict[str, float], heat: np.ndarray, combined: tuple[str, ...], folded: bool = False, clean: bool = False, compat: bool = False) -> np.ndarray:
    """Whether each pixel of a thumbnail is tissue: mask.tissue_mask of one slide. marks: of each pixel, by name, before they are grown."""

    def image(values: np.ndarray, kind=bool) -> np.ndarray:
        out = np.zeros((y.max() + 1, x.max() + 1), kind)
        out[y, x] = values
        return out

    threshold = otsu_exact(heat)
    images = {n: dilate(image(m), grown[n]) for n, m in ({"otsu": heat > threshold} | marks).items()}
    count = {n: np.count_nonzero(m[y, x]) for n, m in images.items()}
    out = np.ones(images["otsu"].shape, bool)
    for name in combined:
        ignored = name in limits and name != "otsu" and (count["otsu"] == 0 or count[name] / count["otsu"] > limits[name])
        if not ignored:
            out &= images[name] if name in ("otsu", "gray") else ~images[name]
    out &= image(np.ones(len(x), bool))  # where there is no pixel there is no tissue
    if folded:
        out &= folds(*(image(c, np.int16) for c in rgb), images["otsu"] & image(np.ones(len(x), bool)), compat=compat)
    if clean:
        out = fill_holes(remove_small(out, compat=compat))
    return out[y, x]


def otsu_exact(values: np.ndarray, bins: int = 256) -> float:
    """otsu in the order of operations of mask.otsu, so that both take the same of bins that nearly tie."""
    low, high = values.min(), values.max()
    if low == high:
        return float(low)
    at = np.minimum(np.floor((values - low) / float(high - low) * bins), bins - 1).astype(int)
    counts = np.bincount(at, minlength=bins)
    centres = low + (np.arange(bins) + 0.5) * (high - low) / bins
    upto, mass = np.cumsum(counts), np.cumsum(counts * centres)
    w1, s1 = upto[:-1], mass[:-1]
    w2, s2 = upto[-1] - w1, mass[-1] - s1
    return float(centres[np.argmax(w1 * w2 * (s1 / np.maximum(w1, 1) - s2 / np.maximum(w2, 1)) ** 2)])


def gray(tile: np.ndarray, variant: str = "byte") -> np.ndarray:
    t = tile.astype(np.int64)
    if variant == "byte":
        return ((4899 * t[..., 0] + 9617 * t[..., 1] + 1868 * t[..., 2] + 8192) >> 14) / 255.0
    w = {"float": (0.299, 0.587, 0.114), "display": (0.2125, 0.7154, 0.0721)}[variant]
    return (t @ np.array(w)) / 255.0


def _convolved(image: np.ndarray, kernel, mode: str) -> np.ndarray:
    p = np.pad(image, 1, mode="reflect") if mode == "reflect" and min(image.shape) > 1 else np.pad(image, 1, mode="edge" if mode == "reflect" else "constant")
    h, w = image.shape
    return sum(k * p[i : i + h, j : j + w] for i, row in enumerate(kernel) for j, k in enumerate(row) if k)


def sharpness(tile: np.ndarray, variant: str = "laplacian") -> float:
    """Variance of edges: a 3 x 3 Laplacian (gray, or gray for displays), or summed Sobel gradients. The variants aren't comparable."""
    if variant == "sobel":
        g = gray(tile, "float")
        edges = _convolved(g, ((1, 0, -1), (2, 0, -2), (1, 0, -1)), "zero") + _convolved(g, ((1, 2, 1), (0, 0, 0), (-1, -2, -1)), "zero")
        return float((edges / 8).var() * 10)
    return float(_convolved(gray(tile, "display" if variant == "legacy" else "byte"), ((2, 0, 2), (0, -8, 0), (2, 0, 2)), "reflect").var())


def macenko(tile: np.ndarray, alpha: float = 1, beta: float = 0.15, light: float = 240, strict: bool = False) -> np.ndarray | None:
    """Stain normalisation; None where a tile has no two stains. strict adds guards on rank and eigenvalues and clamps at 255 instead of 254."""
    od = -np.log(np.maximum(tile.reshape(-1, 3).astype(float), 1) / light)
    dense = od[(od >= beta).all(axis=1)]
    if len(dense) < 2:
        return None
    values, vectors = np.linalg.eigh(np.cov(dense.T))
    if not np.isfinite(values).all() or (strict and (np.abs(values) < 1e-6).all()):
        return None
    plane = vectors[:, 1:3]
    angle = np.arctan2(*(dense @ plane).T[::-1])
    ends = [plane @ np.array([np.cos(a), np.sin(a)]) for a in np.percentile(angle, [alpha, 100 - alpha])]
    stains = np.stack(ends if ends[0][0] > ends[1][0] else ends[::-1], axis=1)
    if not np.isfinite(stains).all() or (strict and np.linalg.matrix_rank(stains) < 2):
        return None
    amount = np.linalg.pinv(stains) @ od.T
    most = np.percentile(amount, 99, axis=1)
    with np.errstate(all="ignore"):
        out = light * np.exp(-STAINS @ (amount / (most / STAIN_MAXIMA)[:, None]))
    if not np.isfinite(out).all():
        return None
    out = np.clip(out, 0, 255) if strict else np.where(out > 255, 254, out)
    return out.T.reshape(tile.shape).astype(np.uint8)


def resized(tile: np.ndarray, side: int, how: str = "bilinear") -> np.ndarray:
    """tile at side x side. area: means of the covered parts; bilinear: a triangle widened when shrinking; linear: four neighbours."""
    if tile.shape[:2] == (side, side):
        return tile
    out = tile.astype(float)
    for axis in (0, 1):
        out = np.moveaxis(np.tensordot(_weights(tile.shape[axis], side, how), out, (1, axis)), 0, axis)
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def _weights(n: int, side: int, how: str) -> np.ndarray:
    ratio = n / side
    if how == "area" and ratio >= 1:
        edges = np.arange(side + 1) * ratio
        w = np.clip(np.minimum(edges[1:, None], np.arange(1, n + 1)) - np.maximum(edges[:-1, None], np.arange(n)), 0, None)
    else:
        width = max(1.0, ratio) if how == "bilinear" else 1.0
        centre = (np.arange(side) + 0.5) * ratio - 0.5
        if how != "bilinear":
            centre = np.clip(centre, 0, n - 1)
        w = np.clip(1 - np.abs(np.arange(n) - centre[:, None]) / width, 0, None)
    return w / w.sum(axis=1, keepdims=True)


def augmented(tile: np.ndarray, seed: int) -> np.ndarray:
    """A copy flipped, turned, and changed in brightness and contrast, as the seed says."""
    rng = np.random.default_rng(seed & ((1 << 63) - 1))
    out = tile[::-1] if rng.random() < 0.5 else tile
    turn = np.deg2rad(rng.uniform(-180, 180))
    h, w = out.shape[:2]
    y, x = np.mgrid[:h, :w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sy = np.round(np.cos(turn) * (y - cy) + np.sin(turn) * (x - cx) + cy).astype(int)
    sx = np.round(-np.sin(turn) * (y - cy) + np.cos(turn) * (x - cx) + cx).astype(int)
    inside = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    out = np.where(inside[..., None], out[np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)], 0).astype(float)
    out *= rng.uniform(0.5, 1.5)
    mean = gray(np.clip(out, 0, 255).astype(np.uint8), "float").mean() * 255
    return np.clip(mean + (out - mean) * rng.uniform(0.2, 1.8), 0, 255).astype(np.uint8)
