"""Token ids as bit-plane shuffled, zstandard-compressed files with a chunk index."""

from __future__ import annotations

import itertools
import math
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.llm.tokens import encoder
from corpusloom.runtime import frugal, new_path, qualified, ship, text_bytes

MAGIC = b"CLBP0001"
BLOCK = 1 << 16  # ids in a block; its bit planes are 8 KiB each
#: Header: magic, blocks, documents, tokens, byte offset of the index.
HEADER = struct.Struct("<8sQQQQ")


def _transpose8(x: np.ndarray) -> np.ndarray:
    """Each uint64 as an 8 x 8 bit matrix, transposed."""
    for shift, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
        t = (x ^ (x >> np.uint64(shift))) & np.uint64(mask)
        x = x ^ t ^ (t << np.uint64(shift))
    return x


def shuffle_block(ids: np.ndarray, level: int = 3) -> tuple[int, bytes]:
    """(mask of the planes that hold a one, these planes compressed one by one, each after its length).

    Plane k holds bit k of every id, eight ids a byte, lowest first; the number of ids is in the chunk index.
    """
    import zstandard

    wide = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4  # upper planes without a one aren't made
    padded = np.zeros(-(-len(ids) // 8) * 8, f"<u{wide}")
    padded[: len(ids)] = ids
    columns = padded.view(np.uint8).reshape(-1, wide)
    compress = zstandard.ZstdCompressor(level=level).compress
    mask, out = 0, []
    for g in range(wide):
        planes = _transpose8(np.ascontiguousarray(columns[:, g]).view("<u8")).view(np.uint8).reshape(-1, 8).T
        for k in range(8):
            if planes[k].any():
                mask |= 1 << (8 * g + k)
                z = compress(planes[k].tobytes())
                out += [struct.pack("<I", len(z)), z]
    return mask, b"".join(out)


def unshuffle_block(mask: int, data: bytes | memoryview, n: int) -> np.ndarray:
    import zstandard

    decompress = zstandard.ZstdDecompressor().decompress
    wide, size, at = 2 if mask < 1 << 16 else 4, -(-n // 8), 0
    out = np.zeros((8 * size, wide), np.uint8)
    for g in range(wide):
        planes = np.zeros((size, 8), np.uint8)
        for k in range(8):
            if mask >> (8 * g + k) & 1:
                (length,) = struct.unpack_from("<I", data, at)
                planes[:, k] = np.frombuffer(decompress(data[at + 4 : at + 4 + length], max_output_size=size), np.uint8)
                at += 4 + length
        out[:, g] = _transpose8(planes.reshape(-1).view("<u8")).view(np.uint8)
    return out.reshape(-1).view(f"<u{wide}")[:n].astype(np.uint32)


def encode_file(docs: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[bytes]:
    """The bytes of a file of (id, ids), block by block; the header comes last (it is written over the first bytes).

    After the blocks come the chunk index (offset, bytes, ids, mask: 4 x u64 a block) and the document index (id,
    null flag, tokens: i64, u64, u64 a document).
    """
    place, chunks, index, held, size = HEADER.size, [], [], [], 0
    for doc, ids in docs:
        index.append((0 if doc is None else doc, doc is None, len(ids)))
        held.append(ids)
        size += len(ids)
        while size >= BLOCK:
            stream = np.concatenate(held)
            mask, data = shuffle_block(stream[:BLOCK])
            chunks.append((place, len(data), BLOCK, mask))
            place += len(data)
            yield data
            held, size = [stream[BLOCK:]], size - BLOCK
    if size:
        mask, data = shuffle_block(np.concatenate(held))
        chunks.append((place, len(data), size, mask))
        place += len(data)
        yield data
    yield np.array(chunks, "<u8").reshape(-1, 4).tobytes()
    yield b"".join(struct.pack("<qQQ", d, int(null), n) for d, null, n in index)
    yield HEADER.pack(MAGIC, len(chunks), len(index), sum(x[2] for x in index), place)


def decode_file(data: bytes | memoryview) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of each document, in the file's order; one block is unpacked at a time."""
    data = memoryview(data)
    magic, n_chunks, n_docs, _, at = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a bit-plane file")
    chunks = np.frombuffer(data[at : at + 32 * n_chunks], "<u8").reshape(-1, 4).tolist()
    docs = struct.iter_unpack("<qQQ", data[at + 32 * n_chunks : at + 32 * n_chunks + 24 * n_docs])
    blocks = (unshuffle_block(mask, data[o : o + b], n) for o, b, n, mask in chunks)
    rest = np.empty(0, np.uint32)
    for doc, null, n in docs:
        parts, have = [rest], len(rest)
        while have < n:
            parts.append(next(blocks))
            have += len(parts[-1])
        stream = np.concatenate(parts) if len(parts) > 1 else rest
        yield None if null else doc, stream[:n]
        rest = stream[n:]


def _put(folder: str, name: str, pieces: Iterator[bytes]) -> int:
    """Write a file under a name of its own and move it into place, so that a second attempt of a task does no harm."""
    header, total = b"", HEADER.size
    temp = f".{name}.{uuid.uuid4().hex}"
    if folder.startswith("file:"):
        local = "/" + folder.split(":", 1)[1].lstrip("/")
        os.makedirs(local, exist_ok=True)
        with open(f"{local}/{temp}", "wb") as f:
            f.write(bytes(HEADER.size))
            for piece in pieces:
                f.write(header)
                total += len(header)
                header = piece
            f.seek(0)
            f.write(header)
        os.replace(f"{local}/{temp}", f"{local}/{name}")
        return total
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(at, recursive=True)
    body = list(pieces)  # a file is bounded by file_ids
    with store.open_output_stream(f"{at}/{temp}") as f:
        for piece in (body[-1], *body[:-1]):
            f.write(piece)
            total += len(piece)
    store.move(f"{at}/{temp}", f"{at}/{name}")
    return total


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    partition_bytes: int = 24 << 20,
    most_partitions: int = 50_000,
    file_ids: int = 16 << 20,
) -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending order of (id, text hash) under ``path`` (any place that Spark writes to; without a scheme, in its default file system).

    A partition is a range of about ``partition_bytes`` of text (more where that would make over ``most_partitions``) and writes a file whenever ``file_ids`` ids
    are together: part-00000-00000.clbp, part-00000-00001.clbp ... in order. Returns file, documents, bytes a file; the files are written when the result is computed. Null ids come first, null texts are
    empty (the end id alone), repeated rows are separate documents. Document ids of another type than integers are refused. An empty table writes no file.
    """
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col}: document ids must be integers")
    ship(df.sparkSession)
    path = qualified(df.sparkSession, path)
    _, size = text_bytes(df, text_col)
    parts = min(most_partitions, max(1, math.ceil(size / partition_bytes)))
    rows = df.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(parts, "doc", "tie").sortWithinPartitions("doc", "tie").select("doc", "text")

    def write(batches):
        import pyarrow as pa

        e = encoder(tokenizer)
        end = np.array([end_id], np.uint32)
        docs = (
            (doc, np.concatenate([ids, end]))
            for batch in batches
            for doc, ids in zip(batch.column(0).to_pylist(), e.encode_column(batch.column(1)))
        )
        held = next(docs, None)
        for n in itertools.count():
            if held is None:
                return
            wrote = [0, 0]  # documents, ids

            def one_file():
                nonlocal held
                while held is not None and (not wrote[0] or wrote[1] + len(held[1]) <= file_ids):
                    wrote[0] += 1
                    wrote[1] += len(held[1])
                    yield held
                    held = next(docs, None)

            name = f"part-{TaskContext.get().partitionId():05d}-{n:05d}.clbp"
            total = _put(path, name, encode_file(one_file()))
            yield pa.RecordBatch.from_pydict({"file": [name], "documents": [wrote[0]], "bytes": [total]})

    return ordered.mapInArrow(frugal(write), "file string, documents long, bytes long")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of all files under ``path``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.clbp").load(path).select("path", "content")

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                out, at = [], 0
                for doc, ids in decode_file(content.as_buffer()):
                    out.append((name, doc, at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())))
                    at += len(ids)
                cols = [list(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names=["path", "doc_id", "inner", "n_tokens", "ids_crc32"])

    return files.mapInArrow(frugal(read), "path string, doc_id long, inner long, n_tokens long, ids_crc32 long")


def with_starts(docs: DataFrame) -> DataFrame:
    """Turn places in a file into places in the whole: a running sum over the files (one row each)."""
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = docs.groupBy("path").agg(F.sum("n_tokens").alias("total"))
    offsets = files.select("path", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return docs.join(offsets, "path").select("doc_id", (F.col("offset") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(df: DataFrame, tokenizer: str, path: str | None = None, **kwargs) -> DataFrame:
    """Write the files, read them back, return what ``read_token_files`` found with starts over all files."""
    from corpusloom.runtime import materialize

    path = path or new_path(df.sparkSession, "ids")
    written = materialize(write_token_files(df, path, tokenizer, **kwargs), "manifest")
    if written.isEmpty():
        return df.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return with_starts(materialize(read_token_files(df.sparkSession, path), "ids-read"))
