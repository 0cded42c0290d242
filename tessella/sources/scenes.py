"""Synthetic scenes with known truth."""

from __future__ import annotations

import numpy as np


def spread(n: int, size: int, margin: int, apart: float, rng: np.random.Generator) -> np.ndarray:
    """Up to ``n`` (x, y) places at least ``apart`` from each other."""
    found: list[np.ndarray] = []
    for _ in range(200 * n):
        p = rng.uniform(margin, size - margin, 2)
        if all(np.hypot(*(p - q)) >= apart for q in found):
            found.append(p)
            if len(found) == n:
                break
    return np.array(found)


def round_mask(size: int, x: float, y: float, radius: float) -> np.ndarray:
    yy, xx = np.mgrid[:size, :size]
    return (xx - x) ** 2 + (yy - y) ** 2 <= radius * radius


def fluorescence_scene(size: int = 256, cells: int = 25, nuclear: float = 0.15, cytoplasm: float = 0.85, seed: int = 42, nucleus_radius: float = 7.0, cell_radius: float = 15.0) -> dict[str, np.ndarray]:
    """Planes ``nuclear``, ``target`` and ``reference``, and the true labels."""
    rng = np.random.default_rng(seed)
    planes = {n: np.zeros((size, size)) for n in ("nuclear", "target", "reference")}
    truth = np.zeros((size, size), dtype=np.int32)
    for i, (x, y) in enumerate(spread(cells, size, 20, 2 * cell_radius + 8, rng)):
        cell, nucleus = round_mask(size, x, y, cell_radius), round_mask(size, x, y, nucleus_radius)
        planes["reference"][cell] = 0.6
        planes["target"][cell] = cytoplasm
        planes["target"][nucleus] = nuclear
        planes["nuclear"][nucleus] = 0.9
        truth[nucleus] = i + 1
    return {n: np.clip(p + rng.normal(0, 0.005, p.shape), 0, 1) for n, p in planes.items()} | {"truth": truth}


def coloc_scene(size: int = 256, cells: int = 20, exclusive: bool = False, seed: int = 101) -> tuple[np.ndarray, np.ndarray]:
    """Two channels in the same or in mutually exclusive halves of each cell."""
    rng = np.random.default_rng(seed)
    a, b = np.zeros((size, size)), np.zeros((size, size))
    xx = np.mgrid[:size, :size][1]
    for x, y in spread(cells, size, 20, 36, rng):
        cell = round_mask(size, x, y, 14)
        left = cell & (xx < x)
        a[left if exclusive else cell] = 0.8
        b[(cell & ~left) if exclusive else cell] = 0.8
    return np.clip(a + rng.normal(0, 0.01, a.shape), 0, 1), np.clip(b + rng.normal(0, 0.01, b.shape), 0, 1)


def puncta_scene(size: int = 192, each: int = 5, seed: int = 202) -> tuple[np.ndarray, int]:
    """A 3 x 3 grid of cells with ``each`` bright spots, and the number of spots."""
    rng = np.random.default_rng(seed)
    image, total = np.full((size, size), 0.05), 0
    bell = 0.85 * np.exp(-(np.add.outer(np.arange(-1, 2) ** 2, np.arange(-1, 2) ** 2)) / 1.5)
    for gy in range(3):
        for gx in range(3):
            centre = np.array([size * (2 * gx + 1) / 6, size * (2 * gy + 1) / 6])
            for x, y in np.round(centre + spread(each, 26, 0, 5, rng) - 13).astype(int):
                image[y - 1 : y + 2, x - 1 : x + 2] += bell
                total += 1
    return np.clip(image + rng.normal(0, 0.005, image.shape), 0, 1), total


def stained_scene(size: int = 128, cells: int = 12, positive: int = 6, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """A brightfield RGB image (0 to 1) of haematoxylin nuclei, some with DAB around them, and the true labels."""
    from tessella.operators.pixels import DAB, HAEMATOXYLIN

    rng = np.random.default_rng(seed)
    h, d, truth = np.full((size, size), 0.08), np.zeros((size, size)), np.zeros((size, size), dtype=np.int32)
    for i, (x, y) in enumerate(spread(cells, size, 12, 24, rng)):
        nucleus, cell = round_mask(size, x, y, 5), round_mask(size, x, y, 9)
        h[nucleus] = 0.9
        if i < positive:
            d[cell] = 0.7
        truth[nucleus] = i + 1
    od = h[..., None] * np.array(HAEMATOXYLIN) + d[..., None] * np.array(DAB)
    return np.clip(np.exp(-od) + rng.normal(0, 0.004, od.shape), 0, 1), truth
