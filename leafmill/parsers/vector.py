"""Vector pictures: rendered to PNG by the first program that is there and gives a picture, on a white ground. Without one they stay as they are."""

from __future__ import annotations

import os
import re
import shutil
import struct
import subprocess
import tempfile
import zlib

EXTENSIONS = {"emf", "wmf", "svg", "emz", "wmz", "emfz"}
#: Command lines, tried in order; {src}, {dest} and {folder} are filled in.
PROGRAMS = (
    ("rsvg-convert", "-b", "white", "-o", "{dest}", "{src}"),
    ("inkscape", "{src}", "--export-type=png", "--export-background=white", "--export-filename={dest}"),
    ("soffice", "--headless", "--convert-to", "png", "--outdir", "{folder}", "{src}"),
    ("libreoffice", "--headless", "--convert-to", "png", "--outdir", "{folder}", "{src}"),
    ("unoconv", "-f", "png", "-o", "{dest}", "{src}"),
    ("convert", "-background", "white", "{src}", "{dest}"),
)
PNG = b"\x89PNG\r\n\x1a\n"


def kind(blob: bytes, ext: str) -> str | None:
    """Kind of a vector picture: its first bytes decide before its name; None for any other."""
    if blob[:4] == b"\xd7\xcd\xc6\x9a":
        return "wmf"
    if blob[:4] == b"\1\0\0\0" and blob[40:44] == b" EMF":
        return "emf"
    if re.match(rb"\s*(?:<\?xml|<svg)", blob[:200]):
        return "svg"
    ext = ext.lower().lstrip(".")
    return ext if ext in EXTENSIONS else None


def render(blob: bytes, ext: str, programs=PROGRAMS, seconds: float = 60) -> bytes | None:
    """PNG bytes of a vector picture; None for any other, and where no program renders it."""
    which = kind(blob, ext)
    if which is None:
        return None
    if which in ("emz", "wmz", "emfz"):
        try:
            blob = zlib.decompressobj(31).decompress(blob)
        except zlib.error:
            return None
        which = kind(blob, {"emz": "emf", "wmz": "wmf", "emfz": "emf"}[which]) or which
    with tempfile.TemporaryDirectory() as folder:
        src, dest = os.path.join(folder, f"in.{which}"), os.path.join(folder, "in.png")
        with open(src, "wb") as f:
            f.write(blob)
        for name, *args in programs:
            if not (path := shutil.which(name)):
                continue
            try:
                subprocess.run([path, *(a.format(src=src, dest=dest, folder=folder) for a in args)], capture_output=True, timeout=seconds, check=False)
                with open(dest, "rb") as f:
                    out = f.read()
            except (OSError, subprocess.SubprocessError):
                continue
            if out.startswith(PNG):
                return on_white(out)
    return None


def _chunks(png: bytes):
    at = 8
    while at + 8 <= len(png):
        (size,) = struct.unpack(">I", png[at : at + 4])
        yield png[at + 4 : at + 8], png[at + 8 : at + 8 + size]
        at += 12 + size


def on_white(png: bytes) -> bytes:
    """A PNG with transparency laid on white, as RGB; any other, and one that cannot be read, as it is."""
    from .pdf import png as written
    from .pdf import unpredicted

    try:
        parts = list(_chunks(png))
        width, height, bits, colour, _, _, woven = struct.unpack(">IIBBBBB", dict(parts)[b"IHDR"])
        channels = {4: 2, 6: 4}.get(colour)
        if bits != 8 or channels is None or woven:
            return png
        data = unpredicted(zlib.decompress(b"".join(d for k, d in parts if k == b"IDAT")), 15, channels, 8, width)
        out = bytearray()
        for i in range(0, width * height * channels, channels):
            alpha = data[i + channels - 1]
            rgb = data[i : i + 3] if channels == 4 else data[i : i + 1] * 3
            out += bytes((c * alpha + 255 * (255 - alpha) + 127) // 255 for c in rgb)
        return written(bytes(out), width, height, 8, 3)
    except (KeyError, struct.error, zlib.error, ValueError, IndexError):
        return png
