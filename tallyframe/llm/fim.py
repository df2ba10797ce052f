"""Fill-in-middle on texts kept as seekable compressed frames.

A text is stored as independent zstandard frames, each a run of whole units, with
cumulative counts of units and code points. A cut is found in the counts; only the
frame it falls into is decompressed. The output is again a list of frames: frames
between the cuts are taken over as they are, marks are frames of their own. Digests
decompress one frame after the other, so a text is never held whole beside them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import append_columns

FRAME = T.StructType(
    [
        T.StructField("units", T.LongType()),
        T.StructField("chars", T.LongType()),
        T.StructField("data", T.BinaryType()),
    ]
)
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class FimSpec:
    """Marks, shares and frame size.

    Four numbers come from the SHA-256 of ``seed:id``. The third, modulo 100, makes a
    text plain from ``plain_from`` on; the fourth makes it suffix-first below
    ``spm_below``. ``frame_units`` is the number of units of a frame.
    """

    seed: int = 42
    plain_from: int = 50
    spm_below: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    frame_units: int = 1024


def unit_ends(data: bytes) -> np.ndarray:
    """Byte offsets where units end: a unit is white space and the word after it, or trailing white space.

    White space is ASCII, so bytes and code points give the same units.
    """
    b = np.frombuffer(data, dtype=np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(b)) if len(b) else ends


def code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))


def cut_frames(data: bytes, units: int, compressor: zstandard.ZstdCompressor) -> list[dict]:
    """Frames of ``units`` units with cumulative counts."""
    ends = unit_ends(data)
    out, start, chars = [], 0, 0
    for first in range(0, len(ends), units):
        done = min(first + units, len(ends))
        piece = data[start : int(ends[done - 1])]
        start += len(piece)
        chars += code_points(piece)
        out.append({"units": done, "chars": chars, "data": compressor.compress(piece)})
    return out


def select_parts(frames: list[dict], low: int, high: int) -> tuple[list[list[bytes]], list[int]]:
    """Frames and code points of the units before ``low``, up to ``high``, and after."""
    opened, packed = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor()
    parts: list[list[bytes]] = [[], [], []]
    chars = [0, 0, 0]
    units_before = chars_before = 0
    for f in frames:
        inside = [c - units_before for c in (low, high) if units_before < c < f["units"]]
        part = (units_before >= low) + (units_before >= high)
        if inside:
            data = opened.decompress(f["data"])
            ends = unit_ends(data)
            starts = [0, *(int(ends[c - 1]) for c in inside)]
            firsts = [units_before, *(units_before + c for c in inside)]
            for unit, a, b in zip(firsts, starts, [*starts[1:], len(data)]):
                if a < b:
                    part = (unit >= low) + (unit >= high)
                    parts[part].append(packed.compress(data[a:b]))
                    chars[part] += code_points(data[a:b])
        else:
            parts[part].append(f["data"])
            chars[part] += f["chars"] - chars_before
        units_before, chars_before = f["units"], f["chars"]
    return parts, chars


def stream(frames: Iterable[bytes]) -> Iterator[bytes]:
    """Contents of frames, one at a time."""
    opened = zstandard.ZstdDecompressor()
    return (opened.decompress(f) for f in frames)


def restored_frames(frames: list[bytes], form: str, spec: FimSpec) -> list[bytes]:
    """Frames of the text that an output was made from.

    A transformed text holds no mark, so a frame that is a mark is one.
    """
    if form == PLAIN:
        return frames
    marks = {m.encode(): m for m in (spec.prefix, spec.suffix, spec.middle)}
    parts: dict[str, list[bytes]] = {m: [] for m in marks.values()}
    now = ""
    longest = max(map(len, marks))
    for frame in frames:
        mark = None
        if zstandard.frame_content_size(frame) <= longest:
            mark = marks.get(zstandard.ZstdDecompressor().decompress(frame))
        if mark is None:
            parts[now].append(frame)
        else:
            now = mark
    return parts[spec.prefix] + parts[spec.middle] + parts[spec.suffix]


def frame_texts(
    docs: DataFrame, spec: FimSpec | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The store: the id, ``frames``, ``n`` units, and ``marked``, whether the text holds a mark.

    It can be written once and cut many times, by other seeds and shares too. A null
    text is an empty one and has no frames. Rows are not merged: repeated rows and
    rows without an id stay. An empty table gives an empty one. Other columns are
    left out, whatever their names.
    """
    spec = spec or FimSpec()
    units = spec.frame_units
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marked = text.contains(spec.prefix) | text.contains(spec.suffix) | text.contains(spec.middle)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), marked.alias("marked"), text.cast("binary").alias("data"))

    def start():
        compressor = zstandard.ZstdCompressor()

        def compute(texts: list) -> list[list]:
            frames = [cut_frames(t, units, compressor) for t in texts]
            return [frames, [f[-1]["units"] if f else 0 for f in frames]]

        return compute

    made = append_columns(
        source, "data", [("frames", T.ArrayType(FRAME)), ("n", T.LongType())], start, ["id", "marked"]
    )
    return made.select(F.col("id").alias(id_col), "n", "marked", "frames")


def id_numbers(ident: Column, seed: int, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex SHA-256 of ``seed:id``, as numbers; a null id is empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(count)]


def fill_in_middle(framed: DataFrame, spec: FimSpec | None = None, id_col: str = "doc_id") -> DataFrame:
    """Outputs of framed texts: the id, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``output`` is an array of frames, which, one after the other, are a valid
    zstandard stream of the output text. Empty texts and texts that hold a mark are
    plain; lengths are null then. A prefix, middle or suffix may be empty. Null ids
    are numbered as empty text. Rows with equal ids are cut alike, each for itself.
    """
    spec = spec or FimSpec()
    h1, h2, h3, h4 = id_numbers(F.col(f"`{id_col}`"), spec.seed)
    form = (
        F.when((F.col("n") == 0) | F.col("marked") | (h3 % 100 >= spec.plain_from), PLAIN)
        .when(h4 % 100 < spec.spm_below, SPM)
        .otherwise(PSM)
    )
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    source = framed.select(
        F.col(f"`{id_col}`").alias("id"),
        "n",
        form.alias("form"),
        F.least(a, b).alias("low"),
        F.greatest(a, b).alias("high"),
        "frames",
    ).select("id", "n", "form", F.struct("form", "low", "high", "frames").alias("job"))

    def start():
        mark = {m: zstandard.ZstdCompressor().compress(m.encode()) for m in (spec.prefix, spec.suffix, spec.middle)}

        def one(job: dict) -> tuple:
            if job["form"] == PLAIN:
                return None, None, [f["data"] for f in job["frames"]]
            (prefix, middle, suffix), chars = select_parts(job["frames"], job["low"], job["high"])
            first, second = [mark[spec.prefix], *prefix], [mark[spec.suffix], *suffix]
            head = first + second if job["form"] == PSM else second + first
            return chars[0], chars[1], [*head, mark[spec.middle], *middle]

        return lambda jobs: list(zip(*map(one, jobs))) if jobs else [[], [], []]

    fields = [("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.ArrayType(T.BinaryType()))]
    made = append_columns(source, "job", fields, start, ["id", "n", "form"])
    return made.select(F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "output")


def with_digests(outputs: DataFrame, spec: FimSpec | None = None) -> DataFrame:
    """``output_sha256`` and ``restored_sha256`` in place of ``output`` (lowercase hex of the UTF-8 bytes).

    Both are fed frame by frame; the second from the frames put back in order, which
    needs the output and its form alone.
    """
    spec = spec or FimSpec()

    def digest(frames: list[bytes]) -> str:
        h = hashlib.sha256()
        for piece in stream(frames):
            h.update(piece)
        return h.hexdigest()

    def start():
        def compute(rows: list) -> list[list]:
            return [
                [digest(r["output"]) for r in rows],
                [digest(restored_frames(r["output"], r["form"], spec)) for r in rows],
            ]

        return compute

    keep = [c for c in outputs.columns if c != "output"]
    source = outputs.select(*[F.col(f"`{c}`") for c in keep], F.struct("output", "form").alias("made"))
    fields = [("output_sha256", T.StringType()), ("restored_sha256", T.StringType())]
    return append_columns(source, "made", fields, start, keep)
