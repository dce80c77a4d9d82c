"""A small raster and its PNG file: rectangles and text in a font of 3 x 5 dots."""

import struct
import zlib
from pathlib import Path

import numpy as np

# The signature of PNG files, and the dots of each character, a digit a row, its bits from left to right.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
DOTS = {
    "0": "75557", "1": "26227", "2": "71747", "3": "71717", "4": "55711", "5": "74717", "6": "74757", "7": "71111", "8": "75757", "9": "75717",
    "a": "25755", "b": "65656", "c": "34443", "d": "65556", "e": "74647", "f": "74644", "g": "34553", "h": "55755", "i": "72227", "j": "11152", "k": "55655", "l": "44447", "m": "57755",
    "n": "65555", "o": "25552", "p": "65644", "q": "25563", "r": "65655", "s": "34216", "t": "72222", "u": "55557", "v": "55552", "w": "55775", "x": "55255", "y": "55222", "z": "71247",
    ".": "00002", ",": "00024", "-": "00700", "_": "00007", "/": "11244", ":": "02020", "%": "51245", "+": "02720", "(": "24442", ")": "21112", "|": "22222", " ": "00000", "?": "71202",
}


class Raster:
    """Pixels in red, green and blue, white at first."""

    def __init__(self, width: int, height: int):
        self.pixels = np.full((height, width, 3), 255, np.uint8)

    def box(self, x: float, y: float, width: float, height: float, colour: tuple[int, int, int]) -> None:
        self.pixels[round(y) : round(y + height), round(x) : round(x + width)] = colour

    def text(self, x: int, y: int, said: str, size: int = 2, colour: tuple[int, int, int] = (0, 0, 0)) -> None:
        """Text with its upper left corner at (x, y). Letters without dots of their own are a question mark."""
        for c in said.lower():
            for row, bits in enumerate(DOTS.get(c, DOTS["?"])):
                for k in range(3):
                    if int(bits) >> (2 - k) & 1:
                        self.box(x + k * size, y + row * size, size, size, colour)
            x += 4 * size

    def png(self) -> bytes:
        """The file: header, deflated rows (each with filter 0 in front) and end, each chunk with its length and CRC-32."""

        def chunk(kind: bytes, data: bytes) -> bytes:
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

        height, width, _ = self.pixels.shape
        rows = np.concatenate([np.zeros((height, 1), np.uint8), self.pixels.reshape(height, -1)], axis=1)
        return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def write_bars(rows: list[tuple[str, float]], title: str, path: str) -> None:
    """A horizontal bar chart as a PNG file."""
    top, h = max([v for _, v in rows] or [1]) or 1, 24
    r = Raster(640, 50 + h * len(rows))
    r.text(5, 10, title, 3)
    for i, (name, v) in enumerate(rows):
        y = 40 + i * h
        r.text(5, y + 5, str(name)[:19])
        r.box(160, y + 3, 380 * v / top, 16, (0x44, 0x77, 0xAA))
        r.text(round(165 + 380 * v / top), y + 5, f"{v:g}")
    Path(path).write_bytes(r.png())
