"""Image kernels in numpy over uint8 arrays of height, width and channels, and PNG coding without other libraries."""

from __future__ import annotations

import math
import random
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd

from quern.functions import draws

# PNG's signature, and channels by its colour types.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
MODES = {1: "L", 2: "LA", 3: "RGB", 4: "RGBA"}

#: Images from which a task makes rows at once.
FEW = 64


def few(batches: Iterable[pd.DataFrame], rows: int | None = None) -> Iterator[pd.DataFrame]:
    """The rows of batches by a few, so what a task makes of them and holds does not grow with its batches."""
    for batch in batches:
        for at in range(0, len(batch), rows or FEW):
            yield batch.iloc[at : at + (rows or FEW)]


def reflected(at: np.ndarray, n: int) -> np.ndarray:
    """Indices folded back into 0..n-1 at the borders, which are not repeated."""
    if n == 1:
        return np.zeros_like(at)
    folded = np.mod(at, 2 * (n - 1))
    return np.where(folded >= n, 2 * (n - 1) - folded, folded)


def sampled(image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear values at fractional places, reflected at the borders."""
    h, w = image.shape[:2]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[..., None], (x - x0)[..., None]
    rows, columns = ((reflected(a, n), reflected(a + 1, n)) for a, n in ((y0, h), (x0, w)))
    pixel = lambda r, c: image[r, c].astype(float)
    top = pixel(rows[0], columns[0]) * (1 - fx) + pixel(rows[0], columns[1]) * fx
    low = pixel(rows[1], columns[0]) * (1 - fx) + pixel(rows[1], columns[1]) * fx
    return np.clip(np.rint(top * (1 - fy) + low * fy), 0, 255).astype(np.uint8)


def rotated(image: np.ndarray, degrees: float) -> np.ndarray:
    """Turned counter-clockwise about (width / 2, height / 2); the size stays."""
    h, w = image.shape[:2]
    turn = math.radians(degrees)
    y, x = np.mgrid[0:h, 0:w].astype(float)
    dy, dx = y - h / 2, x - w / 2
    return sampled(image, dx * math.sin(turn) + dy * math.cos(turn) + h / 2, dx * math.cos(turn) - dy * math.sin(turn) + w / 2)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, with pixel centres aligned and edges held."""
    h, w = image.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    return sampled(image, *np.meshgrid(y, x, indexing="ij"))


def scaled(image: np.ndarray, factor: float) -> np.ndarray:
    """Scaled about the middle: cut to the old size where it grew, filled by reflection where it shrank."""
    h, w = image.shape[:2]
    new = resized(image, max(1, round(h * factor)), max(1, round(w * factor)))
    rows, columns = (np.arange(n) + ((m - n) // 2 if m >= n else -((n - m) // 2)) for n, m in ((h, new.shape[0]), (w, new.shape[1])))
    return new[np.ix_(reflected(rows, new.shape[0]), reflected(columns, new.shape[1]))]


def noisy(image: np.ndarray, sigma: float, rng: draws.Stream | np.random.Generator) -> np.ndarray:
    """With normal noise on each channel, added in float32, clipped, cut to whole numbers."""
    noise = rng.normal(0.0, sigma, image.shape).astype(np.float32)
    return np.clip(image.astype(np.float32) + noise, 0.0, 255.0).astype(np.uint8)


def blurred(image: np.ndarray) -> np.ndarray:
    """With a 3 by 3 Gaussian of weights 1, 2, 1 each way, reflected at the borders."""
    out = image.astype(float)
    for axis in (0, 1):
        n = out.shape[axis]
        before, after = (np.take(out, reflected(np.arange(n) + d, n), axis) for d in (-1, 1))
        out = before / 4 + out / 2 + after / 4
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def swapped(image: np.ndarray) -> np.ndarray:
    """Blue and red exchanged, of three-channel images alone."""
    return image[..., ::-1] if image.ndim == 3 and image.shape[2] == 3 else image


# The demonstration chains, each a list of steps with their parameter; noise has its sigma and seed.
SEQUENCE = (("rotated", 12.0), ("scaled", 1.08), ("noisy", (10.0, 42)), ("blurred", None))
CHAINS = {
    "rotation": SEQUENCE[:1],
    "scaling": SEQUENCE[1:2],
    "noise": SEQUENCE[2:3],
    "blur": SEQUENCE[3:],
    "rotation+noise": (("rotated", -8.0), ("noisy", (10.0, 43))),
    "rotation+scaling+blur": (("rotated", 10.0), ("scaled", 0.93), ("blurred", None)),
    "scaling+blur+noise": (("scaled", 1.05), ("blurred", None), ("noisy", (10.0, 44))),
}


def stepped(image: np.ndarray, steps: tuple) -> list[np.ndarray]:
    """The image after each of a chain's steps."""
    made = []
    for kind, value in steps:
        before = made[-1] if made else image
        if kind == "noisy":
            made.append(noisy(before, value[0], draws.Stream(value[1])))
        elif kind == "blurred":
            made.append(blurred(before))
        else:
            made.append({"rotated": rotated, "scaled": scaled}[kind](before, value))
    return made


def demonstrated(image: np.ndarray) -> dict[str, np.ndarray]:
    """The image as it is, after every step of the sequence, and after every chain."""
    sequence = {f"step {i}": made for i, made in enumerate(stepped(image, SEQUENCE), 1)}
    return {"original": image, **sequence, **{name: stepped(image, steps)[-1] for name, steps in CHAINS.items()}}


def augmented(image: np.ndarray, seed: int, rotation: tuple[float, float], scaling: tuple[float, float], sigma: float, sequential: bool = False) -> np.ndarray:
    """Rotated, and scaled, noisy and blurred by the toss of a coin each, all from one seed.

    Draws are those of augment.with_parameters(), each by its own counter; sequential ones are Python's generator's, each
    made only where it is used.
    """
    if sequential:
        rng, noise = random.Random(seed), np.random.default_rng(seed)
        angle, has_scale = rng.uniform(*rotation), rng.random() > 0.5
        factor = rng.uniform(*scaling) if has_scale else 1.0
        has_noise, has_blur = (rng.random() > 0.5 for _ in range(2))
    else:
        one, noise = draws.Stream(seed), draws.Stream(seed, stream=1)
        angle, has_scale, factor = one.uniform(*rotation), one.random() > 0.5, one.uniform(*scaling)
        has_noise, has_blur = (one.random() > 0.5 for _ in range(2))
    out = rotated(image, angle)
    if has_scale:
        out = scaled(out, factor)
    if has_noise:
        out = noisy(out, sigma, noise)
    return blurred(out) if has_blur else out


def grey(image: np.ndarray) -> np.ndarray:
    """Luma of an RGB or RGBA image; the first channel of others."""
    return image[..., :3].astype(float) @ np.array([0.299, 0.587, 0.114]) if image.shape[2] >= 3 else image[..., 0].astype(float)


def _shrunk(values: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the areas that fall to each of height by width places."""

    def weights(n: int, m: int) -> np.ndarray:
        low, high = np.arange(m)[:, None] * n / m, (np.arange(m)[:, None] + 1) * n / m
        share = np.clip(np.minimum(high, np.arange(n) + 1) - np.maximum(low, np.arange(n)), 0, None)
        return share / share.sum(1, keepdims=True)

    return weights(values.shape[0], height) @ values @ weights(values.shape[1], width).T


def perceptual_coefficients(image: np.ndarray) -> np.ndarray:
    """The 64 lowest cosine coefficients of the image at 32 by 32, row by row."""
    n = 32
    basis = np.cos(np.pi * (2 * np.arange(n) + 1) * np.arange(8)[:, None] / (2 * n))
    return (basis @ _shrunk(grey(image), n, n) @ basis.T).ravel()


def gradient_bits(image: np.ndarray) -> int:
    """64 bits of whether a pixel of 8 rows of 9 is darker than the next one to its right; the first is the lowest."""
    small = _shrunk(grey(image), 8, 9)
    return int.from_bytes(np.packbits((small[:, 1:] > small[:, :-1]).ravel(), bitorder="little").tobytes(), "little", signed=True)


def perceptual_bits(image: np.ndarray) -> int:
    """64 bits of whether a coefficient is above the median; the first is the lowest."""
    found = perceptual_coefficients(image)
    return int.from_bytes(np.packbits(found > np.median(found), bitorder="little").tobytes(), "little", signed=True)


def encode_png(image: np.ndarray) -> bytes:
    """A PNG of 8 bits a channel, rows unfiltered; the same bytes for the same image."""
    h, w, channels = image.shape
    kind = {c: k for k, c in PNG_CHANNELS.items()}[channels]

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    rows = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1)], axis=1).tobytes()
    return PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """The image of a PNG of 8 bits a channel, not interlaced; ValueError for anything else, nothing at all, or damage."""
    if data is None:
        raise ValueError("no content")
    data = bytes(data)
    if data[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head, ended = 8, b"", None, False
    while at + 12 <= len(data) and not ended:
        size, name = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if len(part) < size or data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(name + part)):
            raise ValueError(f"damaged chunk {name!r}")
        at += 12 + size
        if name == b"IHDR":
            if size != 13:
                raise ValueError("header of a wrong length")
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"IDAT":
            body += part
        ended = name == b"IEND"
    if head is None or not ended:
        raise ValueError("cut off")
    w, h, depth, kind, _, _, interlaced = head
    if depth != 8 or kind not in PNG_CHANNELS or interlaced:
        raise ValueError(f"not covered: depth {depth}, colour type {kind}, interlace {interlaced}")
    step = PNG_CHANNELS[kind]
    try:
        raw = np.frombuffer(zlib.decompress(body), np.uint8)
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if len(raw) != h * (1 + w * step):
        raise ValueError("wrong amount of data")
    rows, out = raw.reshape(h, -1), np.zeros((h + 1, w * step), np.uint8)
    for y in range(h):
        out[y + 1] = _unfiltered(int(rows[y, 0]), rows[y, 1:], out[y], step)
    return out[1:].reshape(h, w, step)


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A row with its filter undone: none, left, above, mean of both, or the nearest of three."""
    if kind == 0:
        return row
    if kind == 2:
        return row + above
    if kind == 1:
        return np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind not in (3, 4):
        raise ValueError(f"unknown filter {kind}")
    # By pixel, over plain numbers: each depends on the one before.
    channels = []
    for line, up in zip(row.reshape(-1, step).T.tolist(), above.reshape(-1, step).T.tolist(), strict=True):
        left, corner, done = 0, 0, []
        for x, b in zip(line, up, strict=True):
            if kind == 3:
                left = (x + ((left + b) >> 1)) & 255
            else:
                from_left, from_up = abs(b - corner), abs(left - corner)
                from_corner = abs(left + b - 2 * corner)
                guess = left if from_left <= from_up and from_left <= from_corner else b if from_up <= from_corner else corner
                left = (x + guess) & 255
            corner = b
            done.append(left)
        channels.append(done)
    return np.array(channels, np.uint8).T.ravel()
