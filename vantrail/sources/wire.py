"""Topic values: a zero byte, a four-byte schema id and an Avro record.

Framing, checks and routing are Spark expressions. Spark's Avro functions are a
separate module that a plain installation lacks, so an Arrow helper reads and
writes the bodies of this one fixed record layout, a whole batch at a time.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from vantrail.schema import POSITION_SOURCES, TELEMETRY, WIRE_HEADER_BYTES, WIRE_MAGIC

# --- Fixed values: errors of a value that cannot be read ------------------------
TOO_SHORT = "message too short"
BAD_MAGIC = "unexpected magic byte"
BAD_RECORD = "avro record cannot be decoded"
# -----------------------------------------------------------------------------


class _Reader:
    """One pass over the record bodies of an Arrow batch, all rows at a time.

    ``at`` is each row's place in the shared bytes, ``good`` is false from the
    first value on that a row cannot give.
    """

    def __init__(self, bodies: pa.Array) -> None:
        self.good = np.asarray(bodies.is_valid())
        self.data, offsets = _bytes_of(bodies)
        self.data = np.concatenate([self.data, np.zeros(16, np.uint8)])
        self.at, self.end = offsets[:-1].copy(), offsets[1:]

    def _need(self, rows: np.ndarray, size) -> None:
        self.good &= ~rows | ((self.at + size <= self.end) & (size >= 0))

    def number(self, rows: np.ndarray) -> np.ndarray:
        """Zigzag variable-length integers."""
        value, more = np.zeros(len(rows), np.uint64), rows & self.good
        for shift in range(0, 70, 7):
            self._need(more, 1)
            more &= self.good
            byte = self.data[np.where(more, self.at, 0)]
            value |= np.where(more, byte & 0x7F, 0).astype(np.uint64) << np.uint64(shift)
            self.at += more
            more &= byte > 0x7F
            if not more.any():
                break
        self.good &= ~more
        return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)

    def doubles(self, rows: np.ndarray) -> np.ndarray:
        self._need(rows, 8)
        found = np.zeros(len(rows))
        take = rows & self.good
        cells = self.data[self.at[take][:, None] + np.arange(8)]
        found[take] = np.ascontiguousarray(cells).view("<f8").ravel()
        self.at += np.where(take, 8, 0)
        return found

    def flags(self, rows: np.ndarray) -> np.ndarray:
        self._need(rows, 1)
        byte = self.data[np.where(rows & self.good, self.at, 0)]
        self.good &= ~rows | (byte <= 1)
        self.at += rows & self.good
        return byte == 1

    def texts(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) of each text."""
        size = self.number(rows)
        self._need(rows, size)
        size = np.where(rows & self.good, size, 0)
        start = self.at.copy()
        self.at += size
        return start, size

    def strings(self, start: np.ndarray, size: np.ndarray, rows: np.ndarray) -> pa.Array:
        """Text column; a row whose bytes are no UTF-8 turns bad."""
        offsets = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=offsets[1:])
        flat = self.data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
        if (flat > 0x7F).any():
            for i in np.flatnonzero(size):
                try:
                    flat[offsets[i] : offsets[i + 1]].tobytes().decode()
                except UnicodeDecodeError:
                    self.good[i] = False
                    flat[offsets[i] : offsets[i + 1]] = 0
        array = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(flat))
        return pc.if_else(pa.array(rows), array.cast(pa.string()), None)


def _bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; null counts as empty."""
    plain = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = plain.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _decode_bodies(bodies: pa.Array) -> tuple[list[pa.Array], np.ndarray]:
    reader = _Reader(bodies)
    everyone = reader.good.copy()
    found = []
    for field in TELEMETRY.fields:
        rows = everyone & reader.good
        if field.nullable:
            branch = reader.number(rows)
            reader.good &= ~rows | (branch == 0) | (branch == 1)
            rows = rows & reader.good & (branch == 1)
        kind = type(field.dataType)
        if field.name == "position_source":
            value = reader.number(rows)
            reader.good &= ~rows | ((value >= 0) & (value < len(POSITION_SOURCES)))
        elif kind is T.DoubleType:
            value = reader.doubles(rows)
        elif kind is T.BooleanType:
            value = reader.flags(rows)
        elif kind is T.StringType:
            value = reader.texts(rows)
        else:
            value = reader.number(rows)
            if kind is T.IntegerType:
                reader.good &= ~rows | (np.abs(value + 0.5) < 2**31)
        found.append((field, kind, rows, value))
    texts = {f.name: reader.strings(*v, r) for f, k, r, v in found if k is T.StringType and f.name != "position_source"}
    good, columns = reader.good & everyone, []
    for field, kind, rows, value in found:
        gone = ~(rows & good)
        if field.name in texts:
            columns.append(pc.if_else(pa.array(gone), None, texts[field.name]))
        elif field.name == "position_source":
            columns.append(pa.array(POSITION_SOURCES).take(pa.array(np.where(gone, 0, value), mask=gone)))
        elif kind is T.TimestampType:
            columns.append(pa.array(value, mask=gone).cast(pa.timestamp("us", "UTC")))
        elif kind is T.IntegerType:
            columns.append(pa.array(np.where(gone, 0, value).astype(np.int32), mask=gone))
        else:
            columns.append(pa.array(value, mask=gone))
    return columns, good


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = batch.column("_body")
        columns, good = _decode_bodies(bodies)
        failed = np.asarray(bodies.is_valid()) & ~good
        errors = pc.if_else(pa.array(failed), BAD_RECORD, pa.scalar(None, pa.string()))
        names = [n for n in batch.schema.names if n != "_body"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names] + columns + [errors],
            names=names + TELEMETRY.fieldNames() + ["_record_error"],
        )


Piece = tuple[np.ndarray, np.ndarray]  # bytes per row, and the bytes of all rows


def _number_piece(values: np.ndarray, rows: np.ndarray) -> Piece:
    left = (values.astype(np.int64) << 1 ^ values.astype(np.int64) >> 63).astype(np.uint64)
    cells, used = np.zeros((len(values), 10), np.uint8), np.zeros((len(values), 10), bool)
    more = rows.copy()
    for i in range(10):
        used[:, i] = more
        cells[:, i] = (left & np.uint64(0x7F)).astype(np.uint8) | np.where(left > 0x7F, 0x80, 0).astype(np.uint8)
        more = more & (left > 0x7F)
        left = left >> np.uint64(7)
    return used.sum(axis=1), cells[used]


def _value_pieces(field: T.StructField, column: pa.Array) -> list[Piece]:
    """Avro bytes of a column; nullable fields are a union with null first."""
    rows = np.asarray(column.is_valid())
    pieces = [_number_piece(rows.astype(np.int64), np.ones(len(rows), bool))] if field.nullable else []
    if field.name == "position_source":
        return [_number_piece(pc.index_in(column, pa.array(POSITION_SOURCES)).to_numpy(zero_copy_only=False), rows)]
    if isinstance(field.dataType, T.StringType):
        data, offsets = _bytes_of(column)
        size = np.diff(offsets)
        return [*pieces, _number_piece(size, rows), (size, data[offsets[0] : offsets[-1]])]
    if isinstance(field.dataType, T.DoubleType):
        values = pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False).astype("<f8")
        return [*pieces, (np.where(rows, 8, 0), values[rows].view(np.uint8))]
    if isinstance(field.dataType, T.BooleanType):
        return [*pieces, (np.ones(len(rows), np.int64), np.asarray(column).astype(np.uint8))]
    return [*pieces, _number_piece(pc.fill_null(column, 0).to_numpy(zero_copy_only=False), rows)]


def _encode_bodies(columns: list[pa.Array]) -> pa.Array:
    pieces = [p for field, column in zip(TELEMETRY.fields, columns) for p in _value_pieces(field, column)]
    total = np.sum([size for size, _ in pieces], axis=0).astype(np.int64)
    offsets = np.zeros(len(total) + 1, np.int64)
    np.cumsum(total, out=offsets[1:])
    out, place = np.zeros(offsets[-1], np.uint8), offsets[:-1].copy()
    for size, flat in pieces:
        before = np.cumsum(size) - size
        out[np.repeat(place - before, size) + np.arange(len(flat))] = flat
        place += size
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(total), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return array.cast(pa.binary())


def _encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = _encode_bodies([batch.column(name) for name in TELEMETRY.fieldNames()])
        names = [n for n in batch.schema.names if n not in TELEMETRY.fieldNames()]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], bodies], names=[*names, "_body"])


def encode_topic(df: DataFrame, schema_id: int, *keep: str) -> DataFrame:
    """Telemetry as topic rows: ``key`` is the aircraft, ``value`` the framed record."""
    flat = df.select(
        *keep,
        F.col("icao24").cast("binary").alias("key"),
        *[
            F.unix_micros("observed_at").alias("observed_at") if c == "observed_at" else F.col(c)
            for c in TELEMETRY.fieldNames()
        ],
    )
    out = T.StructType([*[flat.schema[c] for c in (*keep, "key")], T.StructField("_body", T.BinaryType())])
    header = struct.pack(">BI", WIRE_MAGIC, schema_id)
    return flat.mapInArrow(_encode_batches, out).withColumn(
        "value", F.concat(F.lit(bytearray(header)), F.col("_body"))
    ).drop("_body")


def _framed(df: DataFrame, value: str) -> DataFrame:
    body = F.col(value)
    magic = F.hex(F.substring(body, 1, 1))
    error = F.when(body.isNull() | (F.length(body) <= WIRE_HEADER_BYTES), TOO_SHORT).when(
        magic != f"{WIRE_MAGIC:02X}", BAD_MAGIC
    )
    return df.withColumn("_frame_error", error).withColumn(
        "_body", F.when(F.col("_frame_error").isNull(), F.substring(body, WIRE_HEADER_BYTES + 1, 2**31 - 1))
    )


def decode_topic(df: DataFrame, value: str = "value") -> DataFrame:
    """Telemetry with ``error``: null for a record, a reason for a dead letter.

    Other columns of the topic row are kept, the value only for dead letters.
    """
    keep = [c for c in df.columns if c != value]
    framed = _framed(df, value)
    loose = [T.StructField(f.name, f.dataType) for f in TELEMETRY.fields]
    out = T.StructType(
        [
            *[f for f in framed.schema.fields if f.name != "_body"],
            *loose,
            T.StructField("_record_error", T.StringType()),
        ]
    )
    decoded = framed.mapInArrow(_decode_batches, out).withColumn("error", F.coalesce("_frame_error", "_record_error"))
    return decoded.select(
        *keep, *TELEMETRY.fieldNames(), "error", F.when(F.col("error").isNotNull(), F.col(value)).alias("dead_letter")
    )


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, dead letters)."""
    dead = [c for c in decoded.columns if c not in TELEMETRY.fieldNames()]
    return (
        decoded.filter(F.col("error").isNull()).drop("error", "dead_letter"),
        decoded.filter(F.col("error").isNotNull()).select(*dead),
    )
