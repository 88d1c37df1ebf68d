"""Audio and image features on arrays. Plain numpy; ``applied`` makes a column function of them. Decoding of compressed media is out of scope."""

from __future__ import annotations

import io
import math
import wave

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T


def applied(f, returns: T.DataType = T.ArrayType(T.DoubleType())):
    """A vectorised column function of ``f`` (array in, array out); null stays null."""

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        out = [None if v is None else f(np.asarray(v, dtype=float)) for v in values]
        return pd.Series([o.tolist() if isinstance(o, np.ndarray) else o for o in out], dtype=object)

    return run


def read_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(channels x samples in -1…1, sample rate) of an uncompressed WAV file of 8, 16 or 32 bits."""
    with wave.open(io.BytesIO(content)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(float) / 128 - 1
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(float) / 2.0 ** (8 * width - 1)
    return x.reshape(-1, channels).T, rate


def resample(x: np.ndarray, old: int, new: int) -> np.ndarray:
    """Band-limited resampling in the frequency domain."""
    if old == new or not len(x):
        return x
    n = max(1, round(len(x) * new / old))
    s = np.fft.rfft(x)
    bins = n // 2 + 1
    s = s[:bins] if bins <= len(s) else np.pad(s, (0, bins - len(s)))
    return np.fft.irfft(s, n) * (n / len(x))


def without_silence(x: np.ndarray, frame: int = 1024, below_db: float = 20.0) -> np.ndarray:
    """Frames whose level is within ``below_db`` of the loudest; the input if it is all silence."""
    n = -(-len(x) // frame)
    parts = [x[i * frame : (i + 1) * frame] for i in range(n)]
    level = np.array([math.sqrt(float(np.mean(p**2))) for p in parts])
    if not n or level.max() == 0:
        return x
    return np.concatenate([p for p, v in zip(parts, level) if 20 * np.log10(max(v, 1e-12) / level.max()) >= -below_db])


def spectrogram(x: np.ndarray, size: int = 512, hop: int = 256) -> np.ndarray:
    """Power spectrogram (frequencies x frames) with a Hann window; the end is padded with zeros."""
    n = max(1, 1 + -(-max(0, len(x) - size) // hop))
    x = np.pad(x, (0, max(0, (n - 1) * hop + size - len(x))))
    frames = np.stack([x[i * hop : i * hop + size] for i in range(n)]) * np.hanning(size + 1)[:-1]
    return (np.abs(np.fft.rfft(frames, axis=1)) ** 2).T


def noise_gated(x: np.ndarray, size: int = 512, hop: int = 256, quantile: float = 0.2, factor: float = 1.5) -> np.ndarray:
    """Spectral gate: frequency bins below ``factor`` times their own quiet level are set to zero; rebuilt by overlap-add."""
    window = np.hanning(size + 1)[:-1]
    n = max(1, 1 + -(-max(0, len(x) - size) // hop))
    y = np.pad(x, (0, max(0, (n - 1) * hop + size - len(x))))
    s = np.fft.rfft(np.stack([y[i * hop : i * hop + size] for i in range(n)]) * window, axis=1)
    power = np.abs(s)
    s[power < factor * np.quantile(power, quantile, axis=0)] = 0
    out, weight = np.zeros(len(y)), np.zeros(len(y))
    for i, f in enumerate(np.fft.irfft(s, size, axis=1)):
        out[i * hop : i * hop + size] += f * window
        weight[i * hop : i * hop + size] += window**2
    return (out / np.maximum(weight, 1e-8))[: len(x)]


def mel_filters(rate: int, size: int, bands: int) -> np.ndarray:
    """Triangles, evenly spaced on the mel scale from 0 to half the sample rate: bands x frequencies."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(rate / 2), bands + 2) / 2595) - 1)
    freqs = np.linspace(0, rate / 2, size // 2 + 1)
    rise = (freqs - edges[:-2, None]) / np.diff(edges)[:-1, None]
    fall = (edges[2:, None] - freqs) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(rise, fall))


def log_mel(x: np.ndarray, rate: int, size: int = 512, hop: int = 256, bands: int = 40) -> np.ndarray:
    """Mel spectrogram in decibels (bands x frames)."""
    return 10 * np.log10(np.maximum(mel_filters(rate, size, bands) @ spectrogram(x, size, hop), 1e-10))


def mfcc(x: np.ndarray, rate: int, coefficients: int = 13, size: int = 512, hop: int = 256, bands: int = 40) -> np.ndarray:
    """Cepstral coefficients: the orthonormal cosine transform of the log-mel bands (coefficients x frames)."""
    k, n = np.arange(coefficients)[:, None], np.arange(bands)
    basis = np.cos(math.pi * k * (2 * n + 1) / (2 * bands)) * np.where(k == 0, math.sqrt(1 / bands), math.sqrt(2 / bands))
    return basis @ log_mel(x, rate, size, hop, bands)


def fit(x: np.ndarray, n: int) -> np.ndarray:
    """The last axis cut or padded with zeros to ``n``."""
    return x[..., :n] if x.shape[-1] >= n else np.pad(x, [(0, 0)] * (x.ndim - 1) + [(0, n - x.shape[-1])])


def convolved(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """2-d correlation with the edges repeated."""
    h, w = kernel.shape
    p = np.pad(image, ((h // 2, h // 2), (w // 2, w // 2)), mode="edge")
    return np.einsum("ijkl,kl->ij", np.lib.stride_tricks.sliding_window_view(p, (h, w)), kernel)


def blurred(image: np.ndarray, size: int = 5, sigma: float = 1.0) -> np.ndarray:
    g = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    g /= g.sum()
    return convolved(convolved(image, g[None, :]), g[:, None])


def edges(image: np.ndarray) -> np.ndarray:
    """Size of the Sobel gradient."""
    k = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], dtype=float)
    return np.hypot(convolved(image, k), convolved(image, k.T))


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned; a third axis is kept."""
    h, w = image.shape[:2]
    y, x = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1), np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    if image.ndim == 3:
        fy, fx = fy[..., None], fx[..., None]
    at = lambda a, b: image[a[:, None], b[None, :]]
    return (at(y0, x0) * (1 - fx) + at(y0, x1) * fx) * (1 - fy) + (at(y1, x0) * (1 - fx) + at(y1, x1) * fx) * fy


def centre_cropped(image: np.ndarray, height: int, width: int) -> np.ndarray:
    top, left = max(0, (image.shape[0] - height) // 2), max(0, (image.shape[1] - width) // 2)
    return image[top : top + height, left : left + width]


def hog(image: np.ndarray, cell: int = 8, bins: int = 9) -> np.ndarray:
    """Histograms of gradient directions (0-180 degrees) a cell, weighted by size, each to unit length."""
    gy, gx = np.gradient(image.astype(float))
    size, angle = np.hypot(gx, gy), np.rad2deg(np.arctan2(gy, gx)) % 180
    rows, cols = image.shape[0] // cell, image.shape[1] // cell
    b = np.minimum((angle / (180 / bins)).astype(int), bins - 1)[: rows * cell, : cols * cell]
    where = (np.arange(rows * cell)[:, None] // cell * cols + np.arange(cols * cell)[None, :] // cell) * bins + b
    h = np.bincount(where.ravel(), size[: rows * cell, : cols * cell].ravel(), rows * cols * bins).reshape(-1, bins)
    return (h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-9)).ravel()


def equalised(image: np.ndarray) -> np.ndarray:
    """Histogram equalisation of values 0…255."""
    v = np.clip(np.rint(image), 0, 255).astype(int)
    cdf = np.cumsum(np.bincount(v.ravel(), minlength=256))
    low = cdf[v.min()]
    return np.rint((cdf[v] - low) / max(1, cdf[-1] - low) * 255)


def grey(image: np.ndarray) -> np.ndarray:
    return image @ np.array([0.299, 0.587, 0.114])


def normalised(image: np.ndarray, mean: float = 0.5, std: float = 0.5) -> np.ndarray:
    return (image - mean) / std


def denormalised(image: np.ndarray, mean: float = 0.5, std: float = 0.5) -> np.ndarray:
    return image * std + mean

