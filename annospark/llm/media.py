"""Media columns of telephony audio.

Mu-law and A-law bytes are expanded by lookup tables of 256 entries; blocks of IMA
ADPCM are decoded by numpy across blocks, one step for the same sample of all of
them.  The decoded telephone-band samples are resampled to the wanted rate and
stored as 16-bit PCM.  Files are RIFF/WAVE with the format tags of each coding.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the formats: RIFF tags, and IMA ADPCM's index steps and step sizes.
TAGS = {"pcm": 1, "alaw": 6, "mulaw": 7, "ima_adpcm": 17}
INDEX_STEPS = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)
STEP_SIZES = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45,
    50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307,
    337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066,
    2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899,
    15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
STEPS = len(STEP_SIZES)
#: Telephone rate, and that of the stored PCM.
RATE, STORED_RATE = 8000, 16000
#: A payload is padded to a positive multiple of so many bytes with PAD.
UNIT, PAD = 576, 255
#: Data bytes of an ADPCM block, behind a header of 4 bytes.
ADPCM_DATA = 288
#: ADPCM blocks in one step at most, and bytes of files that are decoded together.
AT_ONCE, GROUP_BYTES = 4096, 1 << 20


def mulaw_table() -> np.ndarray:
    """The 16-bit sample of each mu-law byte: bits inverted, 4 of mantissa, 3 of exponent, sign."""
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << (code >> 4 & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """The 16-bit sample of each A-law byte: even bits inverted, 4 of mantissa, 3 of exponent, sign."""
    code = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, size = code >> 4 & 7, (code & 0x0F) << 4
    size = np.where(exponent == 0, size + 8, (size + 0x108) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


MULAW, ALAW = mulaw_table(), alaw_table()


def write_wave(coding: str, data: bytes, rate: int = RATE) -> bytes:
    """A mono WAVE file.  ``data`` of ``ima_adpcm``: whole blocks with their headers; of ``pcm``: 16-bit samples."""
    align, bits, extra = {"mulaw": (1, 8, b""), "alaw": (1, 8, b""), "pcm": (2, 16, b""), "ima_adpcm": (4 + ADPCM_DATA, 4, struct.pack("<HH", 2, 1 + 2 * ADPCM_DATA))}[coding]
    per_second = rate * align if coding != "ima_adpcm" else rate * align // (1 + 2 * ADPCM_DATA)
    form = struct.pack("<HHIIHH", TAGS[coding], 1, rate, per_second, align, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wave(media: bytes) -> tuple[str, int, bytes]:
    """(coding, rate, data) of a file; a ValueError for anything else."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, form, data = 12, None, None
    while at + 8 <= len(media) and data is None:
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            form = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data":
            data = media[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    coding = next((k for k, tag in TAGS.items() if form and tag == form[0]), None)
    if coding is None or data is None:
        raise ValueError("not a telephony WAVE file")
    return coding, form[2], data


def decode_adpcm(data: bytes) -> np.ndarray:
    """Samples of IMA ADPCM blocks, decoded across blocks: each step takes one nibble of every block."""
    blocks = np.frombuffer(data, np.uint8).reshape(-1, 4 + ADPCM_DATA)
    out = np.empty((len(blocks), 1 + 2 * ADPCM_DATA), np.int16)
    for first in range(0, len(blocks), AT_ONCE):
        part = blocks[first : first + AT_ONCE]
        value = part[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
        index = np.minimum(part[:, 2], STEPS - 1).astype(np.int32)
        codes = np.ascontiguousarray(part[:, 4:].T)
        rows = np.empty((1 + 2 * ADPCM_DATA, len(part)), np.int16)
        rows[0] = value
        for n in range(2 * ADPCM_DATA):
            code = codes[n >> 1] >> 4 if n & 1 else codes[n >> 1] & 15
            step = STEP_SIZES[index]
            change = step >> 3
            change = change + np.where(code & 1, step >> 2, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 4, step, 0)
            value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
            index = np.clip(index + INDEX_STEPS[code], 0, STEPS - 1)
            rows[1 + n] = value
        out[first : first + AT_ONCE] = rows.T
    return out.reshape(-1)


def adpcm_blocks(payload: bytes) -> bytes:
    """``payload``, a multiple of ``ADPCM_DATA`` bytes, as blocks that each start from silence."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ADPCM_DATA)
    return np.concatenate([np.zeros((len(rows), 4), np.uint8), rows], axis=1).tobytes()


def samples(coding: str, data: bytes) -> np.ndarray:
    if coding == "pcm":
        return np.frombuffer(data, "<i2")
    if coding == "ima_adpcm":
        return decode_adpcm(data)
    return (MULAW if coding == "mulaw" else ALAW)[np.frombuffer(data, np.uint8)]


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """``x`` at another rate: linear between neighbours, in integers, rounded down; the last sample holds."""
    if rate == to or not len(x):
        return x.astype(np.int16)
    n = len(x) * to // rate
    if to == 2 * rate:
        out = np.empty(n, np.int16)
        out[::2] = x
        wide = x.astype(np.int32)
        out[1:-1:2] = (wide[:-1] + wide[1:]) >> 1
        out[-1] = x[-1]
        return out
    at = np.arange(n, dtype=np.int64) * rate
    low, rest = at // to, at % to
    high = np.minimum(low + 1, len(x) - 1)
    wide = x.astype(np.int64)
    return ((wide[low] * (to - rest) + wide[high] * rest) // to).astype(np.int16)


def features(pcm: np.ndarray) -> str:
    """Samples, peak, mean size, sign changes and clipped samples, all in whole numbers."""
    wide = pcm.astype(np.int32)
    size = np.abs(wide)
    changes = np.count_nonzero((wide[1:] < 0) != (wide[:-1] < 0))
    return f"samples={len(pcm)};peak={int(size.max(initial=0))};mean={int(size.sum(dtype=np.int64)) // max(1, len(pcm))};changes={changes};clipped={np.count_nonzero(size >= 32767)}"


def padded(raw: bytes) -> bytes:
    return raw + bytes([PAD]) * (-len(raw) % UNIT if raw else UNIT)


def store(payload: bytes, coding: str) -> bytes:
    """A file that holds ``payload`` losslessly: as 8-bit samples, or as the code bytes of ADPCM blocks."""
    return write_wave(coding, adpcm_blocks(payload) if coding == "ima_adpcm" else payload)


def stored(media: bytes) -> bytes:
    """The payload of a file that ``store`` made."""
    coding, _, data = read_wave(media)
    return np.frombuffer(data, np.uint8).reshape(-1, 4 + ADPCM_DATA)[:, 4:].tobytes() if coding == "ima_adpcm" else data


def to_pcm(files: list[bytes | None], rate: int = STORED_RATE) -> list[bytes | None]:
    """Telephony files as files of 16-bit PCM at ``rate``; None for None and for what is no such file.

    The ADPCM blocks of all files are decoded together, so that short files make as wide a step as long ones.
    """
    parts: list[tuple[str, int, bytes] | None] = []
    for f in files:
        try:
            coding, have, data = read_wave(f or b"")
            parts.append((coding, have, data) if coding != "ima_adpcm" or len(data) % (4 + ADPCM_DATA) == 0 else None)
        except (ValueError, struct.error):
            parts.append(None)
    blocks = b"".join(p[2] for p in parts if p and p[0] == "ima_adpcm")
    decoded, at, out = decode_adpcm(blocks), 0, []
    for p in parts:
        if p is None:
            out.append(None)
            continue
        coding, have, data = p
        if coding == "ima_adpcm":
            n = len(data) // (4 + ADPCM_DATA) * (1 + 2 * ADPCM_DATA)
            x, at = decoded[at : at + n], at + n
        else:
            x = samples(coding, data)
        out.append(write_wave("pcm", resample(x, have, rate).astype("<i2").tobytes(), rate))
    return out


def in_groups(files: Iterable[bytes | None]):
    """Files in runs of about ``GROUP_BYTES``, so that a batch of long ones isn't decoded at once."""
    group, size = [], 0
    for f in files:
        group.append(f)
        size += len(f or b"")
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def coding_of(payload: bytes) -> str:
    """A coding for a payload, from its content alone."""
    return ("mulaw", "alaw", "ima_adpcm")[zlib.crc32(payload) % 3]


def pcm_column(media: Column, rate: int = STORED_RATE) -> Column:
    """Telephony files as PCM files at ``rate``; null for null and for what is no such file."""

    @F.arrow_udf("binary")
    def convert(files: pa.Array) -> pa.Array:
        return pa.array([x for group in in_groups(files.to_pylist()) for x in to_pcm(group, rate)], pa.binary())

    return convert(media)


#: What a stored file holds, read back from its bytes, and the PCM file that is stored beside it.
HOLDS = {
    "media": "binary", "pcm": "binary", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long",
    "media_sha256": "string", "feature": "string", "coding": "string", "pcm_sha256": "string",
}


def held(media: bytes, pcm: bytes) -> dict:
    payload = stored(media)
    return {
        "media": media, "pcm": pcm, "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(), "feature": features(samples(*read_wave(pcm)[::2])),
        "coding": read_wave(media)[0], "pcm_sha256": hashlib.sha256(pcm).hexdigest(),
    }


def text_media(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes``, the columns ``media`` (the telephony file) and ``pcm`` (the resampled one), and what ``held`` reads from them.

    A null or empty text is one unit of padding with ``n_bytes`` 0.  A null ``doc_id`` stays null, repeated rows
    give repeated rows, equal texts equal values, no rows give no rows; other columns are not read.  Texts are worked on about
    ``GROUP_BYTES`` at a time, a longer text by itself in about 30 bytes of memory for each of its bytes.
    """

    def each(batches):
        for batch in batches:
            ids, at = batch.column(0), 0
            payloads = (padded((t or "").encode()) for t in batch.column(1).to_pylist())
            for group in in_groups(store(p, coding_of(p)) for p in payloads):
                found = [held(f, pcm) for f, pcm in zip(group, to_pcm(group), strict=True)]
                columns = [pa.array([x[name] for x in found], {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[kind]) for name, kind in HOLDS.items()]
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(found)), *columns], ["doc_id", *HOLDS])
                at += len(found)

    column, kind = F.col(f"`{text}`"), dict(docs.dtypes)[doc_id]
    rows = docs.select(F.struct(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.octet_length(column), F.lit(0)).cast("long").alias("n_bytes")).alias("id"), column.alias("text"))
    schema = f"doc_id struct<doc_id:{kind},n_bytes:long>, {', '.join(f'{n} {t}' for n, t in HOLDS.items())}"
    return rows.mapInArrow(each, schema).select("doc_id.*", *HOLDS)
