"""Token ids as length-delimited binary records with an offset index.

A record file is a row of frames, each of them::

    uint64 length of the payload | uint32 masked checksum of these 8 bytes
    payload                      | uint32 masked checksum of the payload

All numbers are little-endian. A checksum is CRC-32, masked by rotating it right by 15 bits and
adding a constant, so that a checksum stored inside a payload doesn't check itself. The payload is
one flag byte (1: the id is null), one byte with the width of a token id (2 or 4), the id as int64
and the token ids as unsigned numbers of that width. Beside each file ``x.rec`` lies ``x.idx``, the uint64 offset of each frame, so a reader can take frames in any order.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ripplelog.llm.frames import batches_of, cut, kept
from ripplelog.session import workspace

END_ID = 2
#: Frames of one file that a reading task takes.
READ_FRAMES = 4096
_LENGTH, _CHECK, _HEAD = "<Q", "<I", "<BBq"
_HEAD_BYTES = 10


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(_LENGTH, len(payload))
    return b"".join((length, struct.pack(_CHECK, masked(length)), payload, struct.pack(_CHECK, masked(payload))))


def unframe(file, offset: int) -> bytes:
    """The payload of the frame at an offset; ValueError if it is damaged."""
    file.seek(offset)
    head = file.read(12)
    if len(head) < 12 or struct.unpack_from(_CHECK, head, 8)[0] != masked(head[:8]):
        raise ValueError(f"damaged length at {offset}")
    length = struct.unpack_from(_LENGTH, head)[0]
    body = file.read(length + 4)
    if len(body) < length + 4 or struct.unpack_from(_CHECK, body, length)[0] != masked(body[:length]):
        raise ValueError(f"damaged record at {offset}")
    return body[:length]


class Encoder:
    """Token ids of texts by a public tokenizer's file.

    Byte-level BPE cuts a text into pieces first and codes each piece by itself. Where no two white
    space characters meet, a space always begins a piece, a line feed is one, and a full stop or
    comma after a word is one. So a text is cut at spaces and line feeds, and what each part is
    coded as is kept for the next time, up to ``most`` parts. Other texts are only cut at spaces
    before a character that isn't white space.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Texts that hold the string of an added token go whole through the tokenizer.
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values() if x.content]
        self.known: dict[str, bytes] = {}
        self.most = most
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.feed, *marks = self._encode(["\n", ".", ","])
        self.marks = dict(zip(".,", marks, strict=True))

    def _encode(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.width == 2 else "I"
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(kind, x.ids).tobytes() for x in coded]

    def _encode_words(self, words: list[str], before: str) -> list[bytes]:
        """Codes of words without white space, each after ``before``; many go through as one text.

        A line feed between them is a piece and a token by itself.
        """
        out = []
        for a in range(0, len(words), 1000):
            some = words[a : a + 1000]
            data = self._encode([before + f"\n{before}".join(some)])[0]
            ids = np.frombuffer(data, f"<u{self.width}")
            cuts = np.flatnonzero(ids == np.frombuffer(self.feed, ids.dtype)[0]) * self.width
            bounds = [-self.width, *cuts.tolist(), len(data)]
            parts = [data[i + self.width : j] for i, j in zip(bounds, bounds[1:])]  # noqa: B905
            out += parts if len(parts) == len(some) else self._encode([before + x for x in some])
        return out

    def _learn(self, parts: set[str]) -> None:
        """Parts that begin with a line feed stand for themselves, the others follow a space."""
        known, marks = self.known, self.marks
        new = parts.difference(known)
        if len(known) + 2 * len(new) > self.most:
            known.clear()
            new = parts
        marked = {x for x in new if x[-1:] in marks and x[:-1].isalpha()}
        plain = (new - marked | {x[:-1] for x in marked}).difference(known)
        words = [x for x in plain if x.isalnum()]
        known.update(zip(words, self._encode_words(words, " "), strict=True))
        lines = [x for x in plain if x[:1] == "\n" and x[1:].isalnum()]
        known.update(
            (x, self.feed + code) for x, code in zip(lines, self._encode_words([x[1:] for x in lines], ""), strict=True)
        )
        others = list(plain.difference(words, lines))
        known.update(zip(others, self._encode([x if x[:1] == "\n" else " " + x for x in others]), strict=True))
        known.update((x, known[x[:-1]] + marks[x[-1]]) for x in marked)

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian numbers of ``width`` bytes."""
        parts = []
        for text in texts:
            if not text:
                parts.append([])
            elif any(x in text for x in self.added):
                parts.append((self._encode([text])[0], []))
            elif len(" ".join(text.split())) != len(text):  # white space meets, or stands at an end
                first, *rest = re.split(r" (?=\S)", text)
                parts.append((self._encode([first])[0] if first else b"", rest))
            else:
                # The first part is coded as after a line feed, which is taken off again.
                parts.append((None, ("\n" + text.replace("\n", " \n")).split(" ")))
        self._learn({x for p in parts if p for x in p[1]})
        code = self.known.__getitem__
        out = []
        for p in parts:
            whole = b"".join(map(code, p[1])) if p else b""
            out.append(whole[len(self.feed) :] if p and p[0] is None else (p[0] if p else b"") + whole)
        return out


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path) if "://" in path else path.removeprefix("file:"))


def write_records(
    df: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    files: int | None = None,
) -> DataFrame:
    """Encode each whole text, append ``end_id`` and write record files in ascending id order.

    Returns the manifest: one row (part, name, frames, tokens) per file, the parts in id order. A
    task names its files anew, so a repeated or speculative attempt can't damage another's files,
    and only files of the manifest count. Null and empty texts hold the end id alone; null ids come
    first; rows with equal ids lie beside each other, ordered by a hash of their text; other columns
    are not read. An empty table gives an empty manifest. Memory is bounded by one batch of rows.
    """
    if df.schema[id_col].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be a whole number")

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = None, TaskContext.get().partitionId()
        name, offsets, tokens, at = f"part-{part:06d}-{uuid.uuid4().hex}", [], 0, 0
        store, root = _filesystem(folder)
        out = None
        for batch in batches_of(rows, 2 << 20):
            if out is None:
                encode = kept(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{name}.rec")
            end = end_id.to_bytes(encode.width, "little")
            for key, ids in zip(batch.column(0).to_pylist(), encode.many(batch.column(1).to_pylist()), strict=True):
                ids += end
                data = frame(struct.pack(_HEAD, key is None, encode.width, key or 0) + ids)
                out.write(data)
                offsets.append(at)
                at, tokens = at + len(data), tokens + len(ids) // encode.width
        if out is not None:
            out.close()
            with store.open_output_stream(f"{root}/{name}.idx") as index:
                index.write(np.array(offsets, "<u8").tobytes())
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "name": [name], "frames": [len(offsets)], "tokens": [tokens]}
            )

    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    return cut(ordered.mapInArrow(write, "part bigint, name string, frames bigint, tokens bigint"), "manifest")


def read_records(
    spark: SparkSession, folder: str, manifest: DataFrame, order: str = "id", seed: int = 0
) -> DataFrame:
    """Rows (part, frame, id, ids) of the files in a manifest; every checksum is verified.

    ``order`` "shuffled" reads the frames of each task in a seeded order by way of the offset
    index. A task takes at most ``READ_FRAMES`` frames, so large files are read by many tasks.
    ``ids`` is binary, little-endian uint32.
    """

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)
        for batch in rows:
            for job in batch.to_pylist():
                with store.open_input_file(f"{root}/{job['name']}.idx") as file:
                    file.seek(8 * job["first"])
                    offsets = np.frombuffer(file.read(8 * (job["last"] - job["first"])), "<u8")
                numbers = np.arange(job["first"], job["last"])
                if order == "shuffled":
                    numbers = np.random.default_rng([seed, job["part"], job["first"]]).permutation(numbers)
                with store.open_input_file(f"{root}/{job['name']}.rec") as file:
                    for some in np.array_split(numbers, -(-len(numbers) // 256)):
                        yield _decoded(job, some, (unframe(file, int(offsets[n - job["first"]])) for n in some))

    def _decoded(job: dict, numbers: np.ndarray, payloads: Iterable[bytes]) -> pa.RecordBatch:
        ids, tokens = [], []
        for payload in payloads:
            missing, width, key = struct.unpack_from(_HEAD, payload)
            ids.append(None if missing else key)
            tokens.append(np.frombuffer(payload, f"<u{width}", offset=_HEAD_BYTES).astype("<u4").tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([job["part"]] * len(ids), pa.int64()),
                pa.array(numbers, pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(tokens, pa.binary()),
            ],
            ["part", "frame", "id", "ids"],
        )

    step = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("frames") - 1, F.lit(READ_FRAMES).cast("bigint")))
    jobs = manifest.select("part", "name", "frames", step.alias("first"))
    jobs = jobs.withColumn("last", F.least(F.col("first") + READ_FRAMES, "frames")).drop("frames")
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return jobs.repartition(width, "name", "first").mapInArrow(
        read, "part bigint, frame bigint, id bigint, ids binary"
    )


def token_table(df: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write records to a new shared folder, read them back: (id, start, n_tokens, ids_crc32).

    ``start`` counts the token ids of all documents before: those of earlier files come from the
    manifest, those within a file from bounded groups of frames.
    """
    spark = df.sparkSession
    folder = workspace(spark, "records")
    manifest = write_records(df, folder, tokenizer, **options)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    rows = read_records(spark, folder, manifest).select(
        "part",
        "frame",
        F.floor(F.col("frame") / READ_FRAMES).alias("chunk"),
        "id",
        F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    rows = cut(rows, "frames")
    chunks = rows.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("chunk_tokens"))
    within = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        "part", "chunk", F.coalesce(F.sum("chunk_tokens").over(within), F.lit(0)).alias("before")
    ).join(bases, "part")
    ahead = Window.partitionBy("part", "chunk").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)))
    start = F.col("base") + F.col("before") + F.col("ahead")
    return rows.join(chunks, ["part", "chunk"]).select(
        "id", start.cast("bigint").alias("start"), "n_tokens", "ids_crc32"
    )
