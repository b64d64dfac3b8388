"""ISO media containers (MP4 family) as columns: box walking, sample tables, keyframe byte ranges.

Reading never decodes a payload: boxes are walked by their sizes, the sample tables give each sample's place, and
codec, duration and the byte ranges of key samples are kept. Writing stores bytes losslessly as 8-bit samples of
one raw track, and is a pure function of the payload.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges, text_slices

#: Boxes that hold boxes (ISO/IEC 14496-12).
CONTAINERS = frozenset([b"moov", b"trak", b"edts", b"mdia", b"minf", b"dinf", b"stbl", b"mvex", b"moof", b"traf", b"mfra", b"udta"])
#: Nesting beyond this is refused; real files nest some eight boxes deep.
DEEPEST = 64

UNIT = 64
#: Bytes of a stored sample, samples of a chunk, samples from one key sample to the next, samples a second.
SAMPLE, CHUNK, KEY_EVERY, RATE = 2048, 4, 4, 25


@dataclass
class Track:
    handler: str
    codec: str
    timescale: int
    duration: int
    offsets: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray  # indices of the key samples
    times: np.ndarray  # when each sample is decoded, in units of the time scale


def boxes(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(type, body start, body end) of each box in data[at:end]; a broken size raises ValueError."""
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            if at + 16 > end:
                raise ValueError("box header cut off")
            (size,) = struct.unpack_from(">Q", data, at + 8)
            head = 16
        elif size == 0:
            size = end - at
        if kind == b"uuid":
            head += 16
        if size < head or at + size > end:
            raise ValueError(f"box {kind!r} has size {size}")
        yield kind, at + head, at + size
        at += size
    if at != end:
        raise ValueError("bytes behind the last box")


def _tree(data: memoryview, at: int, end: int) -> list:
    """(type, body start, body end, boxes within) of all boxes, walked with a stack of their own."""
    top: list = []
    left = [(top, at, end, 0)]
    while left:
        into, at, end, deep = left.pop()
        if deep > DEEPEST:
            raise ValueError(f"boxes are nested more than {DEEPEST} deep")
        for kind, a, b in boxes(data, at, end):
            node = (kind, a, b, [])
            into.append(node)
            if kind in CONTAINERS:
                left.append((node[3], a, b, deep + 1))
    return top


def _find(tree: list, *path: bytes) -> Iterator[tuple]:
    for node in tree:
        if node[0] == path[0]:
            if len(path) == 1:
                yield node
            else:
                yield from _find(node[3], *path[1:])


def _table(data: memoryview, node: tuple, kind: str, columns: int = 1, skip: int = 4) -> np.ndarray:
    """The entries of a full box: a count behind ``skip`` bytes, then rows of big-endian numbers."""
    at = node[1] + skip
    (n,) = struct.unpack_from(">I", data, at)
    width = np.dtype(kind).itemsize * columns
    if at + 4 + n * width > node[2]:
        raise ValueError(f"table {node[0]!r} is cut off")
    return np.frombuffer(data, kind, n * columns, at + 4).reshape(n, columns).astype(np.int64)


def _runs(values: np.ndarray, counts: np.ndarray, n: int, what: str) -> np.ndarray:
    """Each value as often as its count says; together there must be n."""
    if sum(counts.tolist()) != n:
        raise ValueError(f"{what} doesn't cover the samples")
    return np.repeat(values, counts)


def _track(data: memoryview, trak: tuple) -> Track:
    one = lambda *path: next(_find(trak[3], *path))
    mdhd = one(b"mdia", b"mdhd")
    if data[mdhd[1]] == 1:
        timescale, duration = struct.unpack_from(">IQ", data, mdhd[1] + 20)
    else:
        timescale, duration = struct.unpack_from(">II", data, mdhd[1] + 12)
    hdlr = one(b"mdia", b"hdlr")
    stbl = (b"mdia", b"minf", b"stbl")
    stsd = one(*stbl, b"stsd")
    codec = bytes(data[stsd[1] + 12 : stsd[1] + 16]).decode("latin-1")
    chunk_at = next((_table(data, x, ">u4")[:, 0] for x in _find(trak[3], *stbl, b"stco")), None)
    if chunk_at is None:
        chunk_at = _table(data, one(*stbl, b"co64"), ">u8")[:, 0]
    stsc = _table(data, one(*stbl, b"stsc"), ">u4", 3)
    runs = np.diff(np.append(stsc[:, 0], len(chunk_at) + 1))
    if (runs <= 0).any() or (stsc[:1, 0] != 1).any() or int(runs.sum()) != len(chunk_at):
        raise ValueError("chunk runs don't cover the chunks")
    # how many samples there are is known from the chunks before anything of that size is made
    stsz = one(*stbl, b"stsz")
    fixed, n = struct.unpack_from(">II", data, stsz[1] + 4)
    if sum(a * b for a, b in zip(runs.tolist(), stsc[:, 1].tolist(), strict=True)) != n:
        raise ValueError("sample tables don't agree")
    if n * max(1, fixed) > len(data):
        raise ValueError("more samples than bytes")
    per_chunk = np.repeat(stsc[:, 1], runs)
    sizes = np.full(n, fixed, np.int64) if fixed else _table(data, stsz, ">u4", skip=8)[:, 0]
    if len(sizes) != n:
        raise ValueError("sample tables don't agree")
    filled = per_chunk > 0
    before = np.cumsum(sizes) - sizes
    heads = (np.cumsum(per_chunk) - per_chunk)[filled]
    offsets = np.repeat(chunk_at[filled] - before[heads], per_chunk[filled]) + before
    if n and (int(offsets.min()) < 0 or int(offsets.max()) > len(data) or int((offsets + sizes).max()) > len(data)):
        raise ValueError("a sample lies outside of the container")
    stss = next(_find(trak[3], *stbl, b"stss"), None)
    keys = _table(data, stss, ">u4")[:, 0] - 1 if stss else np.arange(n)  # no table: every sample is a key sample
    if len(keys) and (int(keys.min()) < 0 or int(keys.max()) >= n):
        raise ValueError("a key sample isn't there")
    stts = _table(data, one(*stbl, b"stts"), ">u4", 2)
    steps = _runs(stts[:, 1], stts[:, 0], n, "the table of times")
    return Track(bytes(data[hdlr[1] + 8 : hdlr[1] + 12]).decode("latin-1"), codec, timescale, duration, offsets, sizes, keys, np.cumsum(steps) - steps)


def _numbers(data: memoryview, at: int, end: int, n: int) -> tuple[list[int], int]:
    """n 32-bit numbers at ``at``, which must lie before ``end``; and where they end."""
    if at + 4 * n > end:
        raise ValueError("a fragment's box is cut off")
    return list(struct.unpack_from(f">{n}I", data, at)), at + 4 * n


def _fragments(data: memoryview, tree: list) -> dict[int, list[np.ndarray]]:
    """Of each track id, rows (offset, size, duration, key) of the samples of its fragments (moof), in file order.

    Defaults come from the track's trex box, then the fragment's tfhd, then its runs (trun).
    """
    defaults: dict[int, list[int]] = {}
    for trex in _find(tree, b"moov", b"mvex", b"trex"):
        (track, _, duration, size, flags), _ = _numbers(data, trex[1] + 4, trex[2], 5)
        defaults[track] = [duration, size, flags]
    out: dict[int, list[np.ndarray]] = {}
    starts = [a for kind, a, _ in boxes(data, 0, len(data)) if kind == b"moof"]
    for moof, body in zip(_find(tree, b"moof"), starts, strict=True):
        moof_at, behind = body - 8, body - 8
        for traf in _find(moof[3], b"traf"):
            tfhd = next(_find(traf[3], b"tfhd"))
            (flags, track), at = _numbers(data, tfhd[1], tfhd[2], 2)
            duration, size, key_flags = defaults.get(track, [0, 0, 0])
            base = moof_at if flags & 0x20000 else behind
            if flags & 1:
                (high, low), at = _numbers(data, at, tfhd[2], 2)
                base = high << 32 | low
            if flags & 2:
                at += 4
            for bit in (8, 16, 32):
                if flags & bit:
                    (value,), at = _numbers(data, at, tfhd[2], 1)
                    duration, size, key_flags = (value, size, key_flags) if bit == 8 else (duration, value, key_flags) if bit == 16 else (duration, size, value)
            place = base
            for trun in _find(traf[3], b"trun"):
                (flags, n), at = _numbers(data, trun[1], trun[2], 2)
                flags &= 0xFFFFFF
                if flags & 1:
                    (shift,) = struct.unpack_from(">i", data, at)
                    place, at = base + shift, at + 4
                first = None
                if flags & 4:
                    (first,), at = _numbers(data, at, trun[2], 1)
                columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
                if n > len(data) or at + 4 * n * len(columns) > trun[2]:
                    raise ValueError("a run of samples is cut off")
                rows = np.frombuffer(data, ">u4", n * len(columns), at).reshape(n, len(columns)).astype(np.int64)
                column = lambda bit, other: rows[:, columns.index(bit)] if bit in columns else np.full(n, other, np.int64)  # noqa: B023, E731
                sizes, marks = column(0x200, size), column(0x400, key_flags)
                if first is not None and n and 0x400 not in columns:
                    marks[0] = first
                offsets = place + np.cumsum(sizes) - sizes
                if n and (int(offsets.min()) < 0 or int(offsets.max()) > len(data) or int((offsets + sizes).max()) > len(data)):
                    raise ValueError("a sample lies outside of the container")
                out.setdefault(track, []).append(np.stack([offsets, sizes, column(0x100, duration), (marks & 0x10000) == 0], axis=1).astype(np.int64))
                place = behind = int(offsets[-1] + sizes[-1]) if n else place
    return out


def _with_fragments(data: memoryview, trak: tuple, track: Track, more: dict[int, list[np.ndarray]]) -> Track:
    tkhd = next(_find(trak[3], b"tkhd"), None)
    if tkhd is None or not more:
        return track
    (number,) = struct.unpack_from(">I", data, tkhd[1] + (20 if data[tkhd[1]] == 1 else 12))
    if number not in more:
        return track
    rows = np.concatenate(more[number])
    n = len(track.sizes)
    begin = track.duration if n else 0
    keys = np.concatenate([track.keys, n + np.flatnonzero(rows[:, 3])])
    times = np.concatenate([track.times, begin + np.cumsum(rows[:, 2]) - rows[:, 2]])
    return Track(track.handler, track.codec, track.timescale, max(track.duration, begin + int(rows[:, 2].sum())), np.concatenate([track.offsets, rows[:, 0]]), np.concatenate([track.sizes, rows[:, 1]]), keys, times)


def index_media(media: bytes) -> list[Track]:
    """All tracks of a container, with the samples of its fragments; ValueError if its boxes or tables are broken or
    don't fit the file, or it has no moov box. What is allocated is bounded by the file's length."""
    data = memoryview(media)
    try:
        tree = _tree(data, 0, len(data))
        if not any(node[0] == b"moov" for node in tree):
            raise ValueError("no moov box")
        more = _fragments(data, tree)
        return [_with_fragments(data, trak, _track(data, trak), more) for trak in _find(tree, b"moov", b"trak")]
    except (struct.error, StopIteration, IndexError, OverflowError) as e:
        raise ValueError(f"broken container: {e!r}") from None


def read_samples(media: bytes, track: Track) -> bytes:
    """The bytes of all samples in order, by the sample tables."""
    raw = np.frombuffer(media, np.uint8)
    if len(track.sizes) and int((track.offsets + track.sizes).max()) > len(raw):
        raise ValueError("a sample lies outside of the container")
    return raw[ranges(track.offsets, track.sizes)].tobytes()


def _box(kind: bytes, *body: bytes) -> bytes:
    joined = b"".join(body)
    return struct.pack(">I4s", 8 + len(joined), kind) + joined


def write_media(payload: bytes) -> bytes:
    """A container with one raw track whose samples are the payload's bytes; the same bytes for the same payload."""
    n = -(-len(payload) // SAMPLE)
    sizes = np.full(n, SAMPLE, ">u4")
    if len(payload) % SAMPLE:
        sizes[-1] = len(payload) % SAMPLE
    n_chunks = -(-n // CHUNK)
    full, rest = divmod(n, CHUNK)
    runs = ([(1, CHUNK, 1)] if full else []) + ([(full + 1, rest, 1)] if rest else [])
    full_box = bytes(4)
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    big = len(payload) > 0xF0000000
    chunks = np.arange(n_chunks, dtype=np.int64) * (CHUNK * SAMPLE)
    keys = np.arange(1, n + 1, KEY_EVERY)

    def moov(at: int) -> bytes:
        places = _box(b"co64", full_box, struct.pack(">I", n_chunks), (chunks + at).astype(">u8").tobytes()) if big else _box(b"stco", full_box, struct.pack(">I", n_chunks), (chunks + at).astype(">u4").tobytes())
        entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIII", UNIT, SAMPLE // UNIT, 0x480000, 0x480000, 0), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 8, -1))
        stbl = _box(
            b"stbl",
            _box(b"stsd", full_box, struct.pack(">I", 1), entry),
            _box(b"stts", full_box, struct.pack(">III", 1, n, 1)),
            _box(b"stss", full_box, struct.pack(">I", len(keys)), keys.astype(">u4").tobytes()),
            _box(b"stsc", full_box, struct.pack(">I", len(runs)), b"".join(struct.pack(">III", *r) for r in runs)),
            _box(b"stsz", full_box, struct.pack(">II", 0, n), sizes.tobytes()),
            places,
        )
        dinf = _box(b"dinf", _box(b"dref", full_box, struct.pack(">I", 1), _box(b"url ", b"\0\0\0\1")))
        minf = _box(b"minf", _box(b"vmhd", b"\0\0\0\1", bytes(8)), dinf, stbl)
        mdia = _box(b"mdia", _box(b"mdhd", full_box, struct.pack(">IIIIHH", 0, 0, RATE, n, 0x55C4, 0)), _box(b"hdlr", full_box, bytes(4), b"vide", bytes(12), b"\0"), minf)
        tkhd = _box(b"tkhd", b"\0\0\0\7", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), matrix, struct.pack(">II", UNIT << 16, (SAMPLE // UNIT) << 16))
        mvhd = _box(b"mvhd", full_box, struct.pack(">IIIIIH", 0, 0, RATE, n, 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    head = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload)) if big else struct.pack(">I4s", 8 + len(payload), b"mdat")
    at = len(ftyp) + len(moov(0)) + len(head)  # the table of places has the same length for any place
    return b"".join([ftyp, moov(at), head, payload])


def pad(data: bytes) -> bytes:
    """Zero bytes behind, up to a positive multiple of UNIT."""
    return data + bytes(max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


def media_columns(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """Container metadata of a binary column, one row per track: id, track, handler, codec, duration_s, n_samples,
    keyframes array<struct<offset, length, seconds>>, error.

    A null, empty or broken container gives one row with track null and the error named; one without tracks likewise.
    Repeated rows are repeated, other columns (whatever their names) are ignored, an empty table gives no rows; a
    container is read as it is, however long, by its boxes and tables alone.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, media in zip(b.column("id").to_pylist(), b.column("media").to_pylist(), strict=True):
                try:
                    if media is None:
                        raise ValueError("null")
                    tracks = index_media(media)
                    if not tracks:
                        raise ValueError("no track")
                    for k, t in enumerate(tracks):
                        keys = [{"offset": int(t.offsets[j]), "length": int(t.sizes[j]), "seconds": t.times[j] / t.timescale if t.timescale else None} for j in t.keys]
                        rows.append((i, k, t.handler, t.codec, t.duration / t.timescale if t.timescale else None, len(t.sizes), keys, None))
                except ValueError as e:
                    rows.append((i, None, None, None, None, None, None, str(e)))
            types = [b.schema.field("id").type, pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("seconds", pa.float64())])), pa.string()]
            names = ["id", "track", "handler", "codec", "duration_s", "n_samples", "keyframes", "error"]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=names)

    schema = f"id {kind}, track int, handler string, codec string, duration_s double, n_samples long, keyframes array<struct<offset:long,length:long,seconds:double>>, error string"
    return df.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def stored_features(docs: DataFrame) -> DataFrame:
    """Stores every whole text (null: empty) as a container, reads it back and describes it; doc_id and digests.

    The container lives only inside the task; feature is codec|seconds|samples|offset+length of each key sample. Rows
    are described one by one: equal texts (repeated rows too) get equal values, a null or repeated doc_id is kept as it
    is, a very long text is stored whole, other columns are ignored, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            rows = []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                data = text or b""
                media = write_media(pad(data))
                (track,) = index_media(media)
                back = read_samples(media, track)
                keys = ",".join(f"{o}+{s}" for o, s in zip(track.offsets[track.keys].tolist(), track.sizes[track.keys].tolist(), strict=True))
                feature = f"{track.codec.strip()}|{track.duration / track.timescale:.2f}|{len(track.sizes)}|{keys}"
                rows.append((i, len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names=names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op5_media_columns(spark, sf_dir: str) -> DataFrame:
    return stored_features(spark.read.parquet(f"{sf_dir}/documents.parquet"))
