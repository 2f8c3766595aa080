"""Token ids in length-delimited binary records, with an index of offsets for shuffled reads.

A record is

    u64  length of the payload          little-endian, like all that follows
    u32  masked CRC-32 of those 8 bytes
    ...  payload: u8 flags (bit 0: the id is null), i64 document id, u8 bytes a token (2 or 4), token ids
    u32  masked CRC-32 of the payload
    u8   0x0A

and a file is records one after another. Masking rotates a checksum and adds a constant, so that the checksum of
data that holds checksums stays meaningful. Files are written by Spark's text writer, whose line end is the
record's last byte: any file system Spark knows will do, and its commit protocol drops what failed tasks wrote.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.words import byte_hashes

#: Records a file holds at most, which bounds what a reader takes into memory.
RECORDS_A_FILE = 20_000
#: Bytes of text that the range partition behind a file holds on average, at most.
FILE_BYTES = 128_000_000
#: Code points encoded at once.
BLOCK_CHARS = 1_000_000
#: Pieces that a worker remembers before it starts anew.
CACHE_PIECES = 400_000

INDEX_SCHEMA = "file string, part long, doc_id long, record long, offset long, length long, n_tokens long, ids_crc32 long, start_in_file long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def pack_record(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = struct.pack("<BqB", doc_id is None, doc_id or 0, width) + ids.astype("<u2" if width == 2 else "<u4").tobytes()
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<IB", masked_crc(payload), 10)


def unpack_records(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Offset, length, document id and token ids of each record; raises ValueError on damage."""
    at = 0
    while at < len(content):
        head = content[at : at + 8]
        if len(head) < 8 or at + 12 > len(content) or struct.unpack_from("<I", content, at + 8)[0] != masked_crc(head):
            raise ValueError(f"damaged record length at byte {at}")
        n = struct.unpack("<Q", head)[0]
        payload = content[at + 12 : at + 12 + n]
        if len(content) < at + n + 17 or struct.unpack_from("<I", content, at + 12 + n)[0] != masked_crc(payload):
            raise ValueError(f"damaged record at byte {at}")
        null, doc_id, width = struct.unpack_from("<BqB", payload)
        yield at, n + 17, None if null else doc_id, np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=10)
        at += n + 17


class PieceEncoder:
    """Byte-level BPE of whole blocks of text: cuts them into the pieces that the tokenizer's own rule cuts, has the
    tokenizers library merge each distinct piece once, and puts the ids together. Texts that hold a string of the tokenizer's added tokens go through the library whole."""

    LETTER, NUMBER, OTHER, SPACE = range(4)
    _classes: np.ndarray | None = None

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or self.tokenizer.normalizer is not None:
            raise ValueError("a byte-level tokenizer without normalizer is needed")
        self.model = self.tokenizer.model
        self.rule = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.as_char = {b: chr(b if b in printable else next(others)) for b in range(256)}
        self._forget()

    def _forget(self) -> None:
        """Known pieces: sorted hashes, and where each one's ids lie in one flat array."""
        self.keys, self.base, self.sizes, self.flat = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint32)

    @classmethod
    def classes(cls) -> np.ndarray:
        if cls._classes is None:
            kind = {"L": cls.LETTER, "N": cls.NUMBER}
            found = np.fromiter((kind.get(unicodedata.category(chr(c))[0], cls.OTHER) for c in range(0x110000)), np.uint8, 0x110000)
            found[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = cls.SPACE
            cls._classes = found
        return cls._classes

    def _merge(self, text: str) -> list[int]:
        pieces = self.rule.findall(text) if "'" in text else [text]
        return [t.id for p in pieces for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.as_char))]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids = [self._merge(p) for p in pieces]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        base = (len(self.flat) + np.cumsum(sizes) - sizes).astype(np.int32)
        self.flat = np.concatenate([self.flat, np.fromiter((i for p in ids for i in p), np.uint32, int(sizes.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.base, self.sizes = np.insert(self.keys, at, keys), np.insert(self.base, at, base), np.insert(self.sizes, at, sizes)

    def _starts(self, points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Where pieces begin. An apostrophe's piece and what stands around it, up to spaces, stay together for _ids to cut."""
        kind = self.classes()[points]
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[rows] = True
        before, after = np.full(n, self.SPACE, np.uint8), np.full(n, self.SPACE, np.uint8)
        before[1:], after[:-1] = kind[:-1], kind[1:]
        first, last = edge[:n], edge[1:]
        space = kind == self.SPACE
        blank = points == 0x20
        follows = np.zeros(n, bool)  # stands after a blank of the same row, which it takes with it
        follows[1:] = blank[:-1] & ~space[1:]
        follows &= ~first
        starts = first | (~space & (kind != before) & ~follows)
        # In a run of white space the last one parts from the rest if more follows in the row.
        ends_run = space & ~last & (after != self.SPACE)
        starts |= space & (first | (before != self.SPACE) | ends_run)
        if (quotes := np.flatnonzero(points == 0x27)).size:
            # Between two places where the rule surely cuts, row starts and blanks before a word, all is one piece.
            sure = np.flatnonzero(first | (blank & ~last & (after != self.SPACE)))
            at = np.searchsorted(sure, quotes, "right")
            cover = np.zeros(n + 1, np.int32)
            np.add.at(cover, sure[at - 1] + 1, 1)
            np.add.at(cover, np.append(sure, n)[at], -1)
            starts &= np.cumsum(cover)[:n] == 0
        return np.flatnonzero(starts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        marked = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not marked:
            return self._encode(texts)
        plain = list(texts)
        for i in marked:
            plain[i] = ""
        out = self._encode(plain)
        for i in marked:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        raw = "".join(texts).encode("utf-32-le")
        points = np.frombuffer(raw, np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        rows = np.concatenate([[0], np.cumsum(lengths)])
        if not len(points):
            return [np.empty(0, np.uint32) for _ in texts]
        starts = self._starts(points, rows)
        ends = np.append(starts[1:], len(points))
        keys = byte_hashes(np.frombuffer(raw, np.uint8), 4 * starts, 4 * ends)
        distinct, sample, of = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        new = at == len(self.keys)
        new[~new] = self.keys[at[~new]] != distinct[~new]
        if len(self.keys) + new.sum() > CACHE_PIECES:
            self._forget()
            new[:] = True
        if new.any():
            self._learn(distinct[new], [raw[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, distinct)
        base, flat = self.base[at].astype(np.int64), self.flat
        each = self.sizes[at][of].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(each)])
        out = flat[np.arange(upto[-1]) + np.repeat(base[of] - upto[:-1], each)]
        cuts = upto[np.searchsorted(starts, rows)]
        return [out[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text and writes records in ascending order of the id into path/records, their index into path/index.

    A null text is an empty one and gives a record of the end id alone (of nothing if end_id is None). A null id
    comes first. Rows of one id follow one another in an order that depends on their texts only. Other columns are
    not read. An empty table gives no records. Files hold at most RECORDS_A_FILE records, and those of a range partition at
    most. There are as many partitions as Spark's setting says, or as keep them at FILE_BYTES of text on average.
    """
    if end_id is not None and end_id < 0:
        raise ValueError("end_id")
    spark = docs.sparkSession
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = -(-(read.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES)
    ranges = [parts] if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = (
        read.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*ranges, F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "text")
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 and (end_id or 0) < 1 << 16 else 4
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
            a = 0
            while a < len(doc_ids):
                part, n, b = [], 0, a
                while b < len(doc_ids) and (b == a or n < BLOCK_CHARS):
                    part.append(texts[b].as_py())
                    n += len(part[-1])
                    b += 1
                out = [pack_record(d, np.concatenate([ids, tail]), width)[:-1] for d, ids in zip(doc_ids[a:b], enc.encode(part), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                a = b

    (ordered.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", RECORDS_A_FILE).text(f"{path}/records"))
    index_records(spark, path)


def index_records(spark: SparkSession, path: str) -> None:
    """Reads the files of path/records, checks every sum, and writes path/index."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, start = [], 0
                for k, (at, length, doc_id, ids) in enumerate(unpack_records(content.as_py())):
                    rows.append((doc_id, k, at, length, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), start))
                    start += len(ids)
                leaf = name.rpartition("/")[2]
                part, _, piece = leaf.removeprefix("part-").partition("-")
                order = int(part) * 1_000_000 + int(piece.partition(".")[0].rpartition("-c")[2])
                columns = list(zip(*rows, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array([leaf] * len(rows), pa.string()), pa.array([order] * len(rows), pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
                    ["file", "part", "doc_id", "record", "offset", "length", "n_tokens", "ids_crc32", "start_in_file"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    files.select("path", "content").mapInArrow(scan, INDEX_SCHEMA).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with `start`: the number of token ids in all records before. Starts are summed within files first, then over the files."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("in_file"))
    base = files.select("part", (F.sum("in_file").over(Window.orderBy("part")) - F.col("in_file")).alias("base"))
    return index.join(base, "part").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids of every record, read back from the files."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = [(d, ids.astype(np.int32)) for _, _, d, ids in unpack_records(content.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select("content").mapInArrow(scan, "doc_id long, ids array<int>")
