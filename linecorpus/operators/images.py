"""Image operators on numpy arrays, for Arrow-batched functions.

Decoding needs an image library, which is optional; arrays of grey values
(0 to 255) work without one.
"""

from __future__ import annotations

import numpy as np


def grey(image: np.ndarray) -> np.ndarray:
    """Two-dimensional 8-bit grey values of a colour or grey image."""
    a = np.asarray(image)
    if a.ndim == 3:
        a = a[..., :3] @ np.array([0.299, 0.587, 0.114])
    return np.clip(np.rint(a), 0, 255).astype(np.uint8)


def otsu_threshold(image: np.ndarray) -> int:
    """Grey value that separates two classes with the greatest variance between them."""
    h = np.bincount(image.reshape(-1), minlength=256).astype(float)
    n, mean = np.cumsum(h), np.cumsum(h * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mean[-1] * n / n[-1] - mean) ** 2 / (n * (n[-1] - n))
    return int(np.nan_to_num(between).argmax())


def _sums(a: np.ndarray, window: int) -> np.ndarray:
    """Sums over a square window around each pixel, edges repeated."""
    r = window // 2
    p = np.pad(a.astype(float), r, mode="edge")
    s = np.pad(p.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return s[window:, window:] - s[:-window, window:] - s[window:, :-window] + s[:-window, :-window]


def local_moments(image: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    n = float(window * window)
    mean = _sums(image, window) / n
    var = np.maximum(0.0, _sums(image.astype(float) ** 2, window) / n - mean**2)
    return mean, np.sqrt(var)


def odd_window(window: int, shape: tuple[int, ...]) -> int:
    """An odd window of at least 3 that fits the image."""
    most = max(3, min(shape[:2]) // 2 * 2 + 1)
    w = min(window, most)
    return w if w % 2 else w - 1


def binarise(image: np.ndarray, algo: str, window: int = 15, k: float = 0.2) -> np.ndarray:
    """Black and white by a global or a local threshold; an unknown method passes the image through."""
    g = grey(image)
    name = algo.split("_")[0]
    if name == "otsu":
        return np.where(g > otsu_threshold(g), 255, 0).astype(np.uint8)
    if name not in ("sauvola", "wolf"):
        return g
    mean, dev = local_moments(g, odd_window(window, g.shape))
    if name == "sauvola":
        limit = mean * (1 + k * (dev / 128.0 - 1))
    else:
        top = dev.max() or 1.0
        limit = mean - k * (1 - dev / top) * (mean - float(g.min()))
    return np.where(g > limit, 255, 0).astype(np.uint8)


def rotate(image: np.ndarray, degrees: float, fill: int = 255) -> np.ndarray:
    """Rotation about the centre with nearest pixels, same size."""
    h, w = image.shape[:2]
    t = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.rint(np.cos(t) * (x - cx) + np.sin(t) * (y - cy) + cx).astype(int)
    sy = np.rint(-np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy).astype(int)
    ok = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.full_like(image, fill)
    out[ok] = image[sy[ok], sx[ok]]
    return out


def skew(image: np.ndarray, most: float = 10.0, steps: int = 81) -> float:
    """Angle whose row sums vary most."""
    ink = 255 - grey(image)
    angles = np.linspace(-most, most, steps)
    return float(max(angles, key=lambda a: (rotate(ink, a, 0).sum(1).astype(float).var(), -abs(a))))


def deskewed(image: np.ndarray, least: float = 0.2) -> np.ndarray:
    a = skew(image)
    return rotate(grey(image), a) if abs(a) > least else grey(image)


def crop(image: np.ndarray, box: tuple[int, int, int, int], pad: int = 0) -> np.ndarray:
    h, w = image.shape[:2]
    x1, y1, x2, y2 = box
    return image[max(0, y1 - pad) : min(h, y2 + pad), max(0, x1 - pad) : min(w, x2 + pad)]


def to_height(image: np.ndarray, height: int = 42) -> np.ndarray:
    """Scaled to a height with nearest pixels; the width is rounded."""
    h, w = image.shape[:2]
    nw = max(1, round(w * height / h))
    return image[(np.arange(height) * h // height)[:, None], (np.arange(nw) * w // nw)[None, :]]


def shrunk(image: np.ndarray, most: int = 2400) -> np.ndarray:
    """No side longer than ``most``; never enlarged."""
    h, w = image.shape[:2]
    if max(h, w) <= most:
        return image
    s = most / max(h, w)
    return to_height(image, max(1, round(h * s)))


def even_background(image: np.ndarray, window: int = 31) -> np.ndarray:
    """Division by a smoothed background, which evens out stains and shade."""
    g = grey(image).astype(float)
    back = _sums(g, window | 1) / float((window | 1) ** 2)
    return np.clip(255.0 * g / np.maximum(1.0, back), 0, 255).astype(np.uint8)


def bleed_through(image: np.ndarray, other: np.ndarray, opacity: float) -> np.ndarray:
    """Another crop shining through, mirrored."""
    o = to_height(grey(other), image.shape[0])[:, ::-1]
    w = image.shape[1]
    o = np.pad(o, ((0, 0), (0, max(0, w - o.shape[1]))), constant_values=255)[:, :w]
    return np.clip(grey(image) - opacity * (255.0 - o), 0, 255).astype(np.uint8)


# morphology and contrast ----------------------------------------------------------


def _extreme(image: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Least or greatest value in a square window around each pixel, edges repeated; rows and columns one after the other."""
    r, out = size // 2, image
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (r, size - 1 - r)
        w = np.lib.stride_tricks.sliding_window_view(np.pad(out, pad, mode="edge"), size, axis=axis)
        out = w.min(-1) if least else w.max(-1)
    return out


def eroded(image: np.ndarray, size: int = 3) -> np.ndarray:
    """Dark parts grow: each pixel takes the least grey value around it."""
    return _extreme(image, size, True)


def dilated(image: np.ndarray, size: int = 3) -> np.ndarray:
    """Dark parts shrink."""
    return _extreme(image, size, False)


def opened(image: np.ndarray, size: int = 3) -> np.ndarray:
    """Bright specks smaller than the window go."""
    return dilated(eroded(image, size), size)


def closed(image: np.ndarray, size: int = 3) -> np.ndarray:
    """Dark specks smaller than the window go."""
    return eroded(dilated(image, size), size)


def adaptive(image: np.ndarray, block: int = 31, offset: float = 10.0, opening: int = 0) -> np.ndarray:
    """Black and white by the mean of a window less an offset; an even block is made odd; then opened, if wanted."""
    g = grey(image)
    mean = _sums(g, odd_window(block | 1, g.shape)) / float(odd_window(block | 1, g.shape) ** 2)
    out = np.where(g > mean - offset, 255, 0).astype(np.uint8)
    return opened(out, opening) if opening else out


def equalised(image: np.ndarray, tiles: int = 8, limit: float = 2.0) -> np.ndarray:
    """Contrast-limited adaptive equalisation: each tile's clipped histogram makes a curve, and a pixel is mapped by the curves of its four nearest tiles, weighted by nearness."""
    g = grey(image)
    h, w = g.shape
    ty, tx = min(tiles, h), min(tiles, w)
    ys, xs = np.linspace(0, h, ty + 1).astype(int), np.linspace(0, w, tx + 1).astype(int)
    curves = np.empty((ty, tx, 256))
    for a in range(ty):
        for b in range(tx):
            part = g[ys[a] : ys[a + 1], xs[b] : xs[b + 1]]
            hist = np.bincount(part.reshape(-1), minlength=256).astype(float)
            top = max(1.0, limit * part.size / 256)
            over = np.maximum(0.0, hist - top).sum()
            curves[a, b] = np.cumsum(np.minimum(hist, top) + over / 256) * 255 / part.size
    fy = np.clip((np.arange(h) + 0.5) * ty / h - 0.5, 0, ty - 1)
    fx = np.clip((np.arange(w) + 0.5) * tx / w - 0.5, 0, tx - 1)
    y0, x0 = np.floor(fy).astype(int), np.floor(fx).astype(int)
    y1, x1 = np.minimum(y0 + 1, ty - 1), np.minimum(x0 + 1, tx - 1)
    wy, wx = (fy - y0)[:, None], (fx - x0)[None, :]
    at = lambda yy, xx: curves[yy[:, None], xx[None, :], g]
    out = (1 - wy) * ((1 - wx) * at(y0, x0) + wx * at(y0, x1)) + wy * ((1 - wx) * at(y1, x0) + wx * at(y1, x1))
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def normalised(image: np.ndarray, window: int = 31, tiles: int = 8, limit: float = 2.0) -> np.ndarray:
    """The background, which closing leaves, divided out, then contrast equalised."""
    g = grey(image)
    back = closed(g, odd_window(window | 1, g.shape)).astype(float)
    return equalised(np.clip(255.0 * g / np.maximum(1.0, back), 0, 255).astype(np.uint8), tiles, limit)


# variants -------------------------------------------------------------------------


def elastic(image: np.ndarray, seed: int, strength: float = 4.0, smooth: int = 9) -> np.ndarray:
    """Pixels moved by a smooth random field, seeded."""
    g = grey(image)
    rng = np.random.Generator(np.random.PCG64(seed))
    h, w = g.shape
    window = odd_window(smooth | 1, g.shape)
    dy, dx = (_sums(_sums(rng.uniform(-1, 1, (h, w)), window) / window**2, window) / window * strength for _ in range(2))
    y, x = np.mgrid[0:h, 0:w]
    return g[np.clip(np.rint(y + dy), 0, h - 1).astype(int), np.clip(np.rint(x + dx), 0, w - 1).astype(int)]


def inked(image: np.ndarray, kind: int, seed: int) -> np.ndarray:
    """Ink that is too thick (0), too thin (1) or broken by missing dots (2)."""
    g = grey(image)
    if kind == 0:
        return eroded(g, 2)
    if kind == 1:
        return dilated(g, 2)
    drop = np.random.Generator(np.random.PCG64(seed)).random(g.shape) < 0.05
    return np.where(drop, 255, g).astype(np.uint8)


def noisy(image: np.ndarray, kind: int, seed: int) -> np.ndarray:
    """Grain (0), salt and pepper (1), a blur (2) or uneven light (3)."""
    g = grey(image).astype(float)
    rng = np.random.Generator(np.random.PCG64(seed))
    if kind == 0:
        out = g + rng.normal(0, 12, g.shape)
    elif kind == 1:
        u = rng.random(g.shape)
        out = np.where(u < 0.01, 0.0, np.where(u > 0.99, 255.0, g))
    elif kind == 2:
        out = _sums(g, odd_window(3, g.shape)) / odd_window(3, g.shape) ** 2
    else:
        out = g * np.linspace(0.8, 1.0, g.shape[1])[None, :]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


#: degrees of the rotated variants
TURNS = (-1.5, 0.75, 1.5)


def variants(image: np.ndarray, seed: int) -> list[tuple[str, np.ndarray]]:
    """The twelve variants of one source image: elastic, ink (3), plain, rotation (3), noise (4); the same for the same seed."""
    g = grey(image)
    return [
        ("elastic", elastic(g, seed)),
        *((f"ink{k}", inked(g, k, seed + 1)) for k in range(3)),
        ("plain", g),
        *((f"rotation{k}", rotate(g, t)) for k, t in enumerate(TURNS)),
        *((f"noise{k}", noisy(g, k, seed + 2 + k)) for k in range(4)),
    ]
