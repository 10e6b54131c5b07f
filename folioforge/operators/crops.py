"""Crops of pages as PNG files, behind an interface: the renderer is an outside library.

render_crops() runs a renderer for rows of (file id, content, page, box) in Arrow
batches. Renderer is what a caller implements; BlankRenderer draws blank images
of the right size, for tests and dry runs. Steps of a library that may fail
without harm, such as making fonts smaller, are wrapped by harmless().
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..sources.shipping import ship

DPI = 144


class Renderer(Protocol):
    def crop(self, content: bytes, page: int, box: tuple[float, float, float, float], dpi: int) -> bytes:
        """The box of a page (points, 72 an inch) as a PNG file."""


def png(width: int, height: int) -> bytes:
    """A white grey-scale image."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = (b"\0" + b"\xff" * width) * height
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


class BlankRenderer:
    def crop(self, content, page, box, dpi):
        x0, y0, x1, y1 = box
        return png(max(1, round((x1 - x0) * dpi / 72)), max(1, round((y1 - y0) * dpi / 72)))


def harmless(step: Callable[[], None]) -> bool:
    """Run a step whose failure costs nothing but its effect; whether it worked."""
    try:
        step()
    except Exception:
        return False
    return True


def render_crops(df: DataFrame, make: Callable[[], Renderer], dpi: int = DPI, optional: Callable[[bytes], None] | None = None) -> DataFrame:
    """df (id, content, page, x0, y0, x1, y1) -> (id, page, png, whole): the crop of each row, null where the renderer fails; whole: the optional step on the content worked."""
    ship(df.sparkSession)

    def run(batches):
        renderer = make()
        for b in batches:
            out, whole = [], []
            for r in b.itertuples(index=False):
                content = bytes(r.content or b"")
                whole.append(optional is None or harmless(lambda c=content: optional(c)))
                image = []
                harmless(lambda r=r, c=content, image=image: image.append(renderer.crop(c, r.page, (r.x0, r.y0, r.x1, r.y1), dpi)))
                out.append(image[0] if image else None)
            yield pd.DataFrame({"id": b["id"], "page": b["page"], "png": out, "whole": whole})

    return df.select("id", "content", "page", "x0", "y0", "x1", "y1").mapInPandas(run, f"id {df.schema['id'].dataType.simpleString()}, page long, png binary, whole boolean")
