"""Best-fit packing of documents into token sequences, as a tree of local packings.

Pieces are dealt into groups of about PIECES by hash. Each group packs its pieces best-fit, longest first.
Bins that are nearly full are sequences; all others are items of the next round, dealt by hash into as many groups as their number asks for,
about FAN * CARRY to a group, so that no group grows with the input. The last group emits all. Where a round would leave no fewer
groups, the next one hands on only bins that are at most half full: the others have no room for one another, and best fit leaves at most one
such bin in a group, so a group misses one place at most. The outcome depends on the rows alone, not on how Spark deals or repeats tasks.

Equal rows are counted first, and each copy is dealt by its number, so that no group gets all copies of a row.

Only the pieces' lengths take part in the rounds. pack_ids() joins the token ids to their places afterwards, by SHA-256 of the ids;
sequences() gives the packed sequences themselves.

Cases: a null or empty text is a document of the closing id alone. Repeated rows and null ids are packed like any others.
A table without rows gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import saved, slices, texts_of
from faultline.llm.tokens import encoder

TOKENIZER = "word_bpe_49k.json"
LENGTH = 2048
CLOSING_ID = 0
PIECES = 8192
FAN = 4
NEARLY_FULL = LENGTH - LENGTH // 128
CARRY = 4096
COPIES = 4096  # of one row that a task numbers at a time

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_IDS = ", ids_sha256 binary, ids array<int>"


def _ids_columns(parts: list[bytes]) -> list[pa.Array]:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))
    return [pa.array([hashlib.sha256(p).digest() for p in parts], pa.binary()), ids]


def cut(docs: DataFrame, path: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `length` tokens: doc_id, piece, start, length, ids_crc32. Only documents of more tokens are cut.

    On request also ids_sha256 and ids, the token ids; crc32 and SHA-256 are those of unsigned 32-bit little-endian numbers.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches):
            rows, parts = [], []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts_of(batch))):
                ids += CLOSING_ID.to_bytes(4, "little")
                for piece, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        parts.append(part)
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays, names = [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = arrays + _ids_columns(parts), [*names, "ids_sha256", "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(pieces, _PIECE + _IDS if with_ids else _PIECE)


def best_fit(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For items with sizes of 1 to `length`, taken in order: the bin of each, and its place there.

    Each goes to the open bin that it leaves least room in. Bit r of `rooms` says that a bin with room r is open.
    """
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    open_: list[list[int]] = [[] for _ in range(length + 1)]
    rooms, count = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if fit := rooms >> size:
            room = size + (fit & -fit).bit_length() - 1
            at = open_[room].pop()
            if not open_[room]:
                rooms ^= 1 << room
        else:
            room, at, count = length, count, count + 1
        bins[i], places[i] = at, length - room
        if left := room - size:
            open_[left].append(at)
            rooms |= 1 << left
    return bins, places


def _pack(rows: pa.Table, round_: int, done_from: int, length: int) -> pa.Table:
    if round_:
        rows = rows.sort_by([("bin", "ascending"), ("offset", "ascending")])
        bin_ = rows["bin"].to_numpy()
        item = np.cumsum(np.concatenate([[0], bin_[1:] != bin_[:-1]]))
    else:
        rows = rows.sort_by([(c, "descending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        item = np.arange(rows.num_rows)
    sizes = np.bincount(item, rows["length"].to_numpy()).astype(np.int64)
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.empty_like(sizes), np.empty_like(sizes)
    bins[order], places[order] = best_fit(sizes[order], length)
    fill = np.bincount(bins, sizes).astype(np.int64)
    done = fill >= done_from
    part = rows["part"][0].as_py()
    new = {"bin": (round_ << 56) + (part << 24) + bins[item], "offset": rows["offset"].to_numpy() + places[item], "done": done[bins[item]]}
    for name, values in new.items():
        rows = rows.set_column(rows.column_names.index(name), name, pa.array(values))
    return rows


def _packer(*settings):
    def packed(group: pa.Table) -> pa.Table:
        return _pack(group, *settings)

    return packed


def _numbered(pieces: DataFrame) -> tuple[int, DataFrame]:
    """How many rows there are, and the rows with `copy`, which numbers equal ones from 0."""
    columns = pieces.columns
    counted = saved(pieces.groupBy(*columns).agg(F.count("*").alias("copies")), "pieces")
    once = counted.where("copies = 1").select(*columns, F.lit(0).cast("long").alias("copy"))
    blocks = counted.where("copies > 1").select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")).alias("block"))
    blocks = blocks.repartition("doc_id", "piece", "ids_crc32", "block")
    more = blocks.select(*columns, F.explode(F.expr(f"sequence(block * {COPIES}, least(copies, (block + 1) * {COPIES}) - 1)")).alias("copy"))
    return counted.agg(F.sum("copies")).first()[0] or 0, once.unionByName(more)


def pack(pieces: DataFrame, length: int = LENGTH, per_group: int = PIECES, fan: int = FAN, nearly_full: int = NEARLY_FULL, carry: int = CARRY) -> DataFrame:
    """The rows of cut(), with all their columns, and sequence_id and offset: the place in the sequence, without gaps from 0."""
    columns = pieces.columns
    count, numbered = _numbered(pieces)
    parts = max(1, -(-count // per_group))
    # A null leaves a hash as it is: the first copy is dealt by its key alone.
    deal = F.xxhash64("doc_id", "piece", "ids_crc32", F.nullif("copy", F.lit(0)))
    rows = numbered.select(*columns, F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"), F.pmod(deal, F.lit(parts)).alias("part"))
    done, round_, done_from = None, 0, nearly_full
    while True:
        packed = _packer(round_, 0 if parts == 1 else done_from, length)
        rows = rows.withColumn("done", F.lit(False))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        rows = saved(rows.groupBy("part").applyInArrow(packed, schema), "packing")
        ready = rows.where("done").drop("done", "part")
        done = ready if done is None else done.unionByName(ready)
        if parts == 1:
            return done.withColumnRenamed("bin", "sequence_id").select(*columns, "sequence_id", "offset")
        rows = rows.where("not done")
        after = max(1, -(-rows.where("offset = 0").count() // (fan * carry)))
        done_from = nearly_full if after < parts else length // 2 + 1
        parts, round_ = after, round_ + 1
        rows = rows.withColumn("part", F.pmod(F.xxhash64("bin"), F.lit(parts)))


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    return pack(cut(docs, path))


def pack_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of pack_documents() with ids, the token ids of each piece as an array."""
    pieces = saved(cut(docs, path, with_ids=True), "piece-ids")
    # Equal pieces are one row here, however often they are packed.
    ids = pieces.groupBy("ids_sha256").agg(F.first("ids").alias("ids"))
    return pack(pieces.drop("ids")).join(ids, "ids_sha256").drop("ids_sha256")


def sequences(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The packed training sequences: sequence_id, ids (at most LENGTH)."""
    parts = pack_ids(docs, path).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
