"""Text in images: download, variants that read better, and a recogniser that the caller plugs in.

``get(url, seconds)`` returns (final_url, http_status, content_type, body) as for pages.  ``read(image,
mode)`` returns the text of a variant, an array of whole numbers (grey: 2 axes, colour: 3); ``tesseract``
is one where that program is there.  Both run on the executors.  All readings become rows, and the
best one of an image is chosen by score with ``scoring.best_ocr_text``.
"""

from __future__ import annotations

import io
import os
import re
import shutil
import subprocess
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..operators.scoring import best_ocr_text

#: Thresholds of black and white, page segmentation modes, languages and places of the program (fixed values).
THRESHOLDS, MODES, LANGUAGES = (160, 180, 200), (6, 11, 12), "kor+eng"
TESSERACT_PLACES = ("/usr/bin/tesseract", "/usr/local/bin/tesseract", "/opt/homebrew/bin/tesseract")


def decoded(raw: bytes) -> np.ndarray:
    """The pixels of an image: binary PNM always, all else where Pillow is installed."""
    head = re.match(rb"P([56])\s+(\d+)\s+(\d+)\s+255\s", raw)
    if head:
        depth, width, height = 3 if head[1] == b"6" else 1, int(head[2]), int(head[3])
        pixels = np.frombuffer(raw, np.uint8, width * height * depth, head.end())
        return pixels.reshape((height, width, 3) if depth == 3 else (height, width))
    try:
        from PIL import Image, ImageOps
    except ImportError as e:
        raise ValueError("only PNM images can be read without Pillow") from e
    return np.asarray(ImageOps.exif_transpose(Image.open(io.BytesIO(raw))).convert("RGB"))


def encoded(image: np.ndarray) -> bytes:
    """An array as binary PNM."""
    return b"P%d %d %d 255\n" % (6 if image.ndim == 3 else 5, image.shape[1], image.shape[0]) + image.astype(np.uint8).tobytes()


def whole(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


def grey(image: np.ndarray) -> np.ndarray:
    """Luma, stretched from its least to its largest value."""
    y = image.astype(np.float64) if image.ndim == 2 else np.rint(image @ np.array([0.299, 0.587, 0.114]))
    low, high = y.min(initial=255), y.max(initial=0)
    return whole((y - low) * (255 / (high - low))) if high > low else whole(y)


def lanczos(n: int, scale: int, lobes: int = 3) -> np.ndarray:
    """The (n * scale, n) matrix that resamples n values; rows sum to one at the edges too."""
    x = (np.arange(n * scale)[:, None] + 0.5) / scale - 0.5 - np.arange(n)[None, :]
    w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0)
    return w / w.sum(1, keepdims=True)


def filtered(image: np.ndarray, centre: float, around: float) -> np.ndarray:
    """A 3 x 3 filter of two weights; the outermost pixels stay."""
    out = image.astype(np.float64).copy()
    if min(image.shape) > 2:
        near = sum(out[1 + i : out.shape[0] - 1 + i, 1 + j : out.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)
        inner = centre * out[1:-1, 1:-1] + around * near
        out[1:-1, 1:-1] = inner
    return out


def variants(image: np.ndarray, scale: int = 2) -> list[np.ndarray]:
    """The image; its grey form at twice the size, sharpened; and that in black and white at each threshold."""
    y = grey(image).astype(np.float64)
    large = whole(lanczos(y.shape[0], scale) @ y @ lanczos(y.shape[1], scale).T)
    smooth = filtered(large, 5 / 13, 1 / 13)
    sharp = whole(filtered(whole(smooth + 1.4 * (large - smooth)), 2.0, -1 / 8))
    return [image, sharp, *[np.where(sharp > t, 255, 0).astype(np.uint8) for t in THRESHOLDS]]


def tesseract_command(environment: dict | None = None) -> str:
    """The program that TESSERACT_CMD names if it is there, else the one on the path or in a usual place; or empty."""
    named = " ".join(((os.environ if environment is None else environment).get("TESSERACT_CMD") or "").split())
    return next((c for c in (named, shutil.which("tesseract") or "", *TESSERACT_PLACES) if c and os.path.exists(c)), "")


def tesseract(image: np.ndarray, mode: int, seconds: float = 30.0) -> str:
    """What the program reads in an image; nothing where it isn't installed."""
    command = tesseract_command()
    if not command:
        return ""
    done = subprocess.run([command, "stdin", "stdout", "-l", LANGUAGES, "--oem", "3", "--psm", str(mode)], input=encoded(image), capture_output=True, timeout=seconds, check=True)
    return done.stdout.decode("utf-8", "replace")


def readings(url: str, get: Callable, read: Callable, decode: Callable, seconds: float) -> list[tuple]:
    """(url, pos, text, error) of every variant in every mode; a reading that fails is left out, an image
    that can't be had is one row that says why."""
    try:
        if not url or any(ord(c) < 32 for c in url):
            raise ValueError("no URL")
        found = variants(decode(get(url, seconds)[3]))
    except Exception as e:  # noqa: BLE001  an image that fails is a record, not a failed job
        return [(url, 0, "", f"{type(e).__name__}: {e}"[:240])]
    out = []
    for i, image in enumerate(found):
        for j, mode in enumerate(MODES):
            try:
                out.append((url, i * len(MODES) + j, " ".join((read(image, mode) or "").split()), ""))
            except Exception:  # noqa: BLE001
                continue
    return out


def read_images(urls: DataFrame, get: Callable, partitions: int, read: Callable = tesseract, decode: Callable = decoded, column: str = "url", seconds: float = 15.0) -> DataFrame:
    """url, pos, text, error: all readings of the distinct image URLs."""
    wanted = urls.select(F.col(column).alias("url")).filter("url <> ''").distinct().repartition(partitions, "url")

    def run(batches):
        for batch in batches:
            for url in batch.column(0).to_pylist():
                rows = readings(url, get, read, decode, seconds)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32() if k == 1 else pa.string()) for k in range(4)], ["url", "pos", "text", "error"])

    return wanted.mapInArrow(run, "url string, pos int, text string, error string")


def image_texts(found: DataFrame, rules: V.EventRules | None = None) -> DataFrame:
    """url, text, error: the best reading of each image (see ``read_images``); empty text where none says anything."""
    best = best_ocr_text(found, "url", rules=rules)
    said = found.groupBy("url").agg(F.max("error").alias("error"))
    return said.join(best, "url", "left").select("url", F.coalesce("text", F.lit("")).alias("text"), "error")
