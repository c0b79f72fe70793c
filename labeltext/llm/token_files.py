"""Token ids of documents in files with one shared Zstandard dictionary.

An archive is a folder: ``dictionary``, ``shard-*.ids`` files and ``manifest``, a Parquet table
with a row per shard. A shard file is

* a header: magic, version, bytes of an id (2 or 4), SHA-256 of the dictionary,
* one Zstandard frame per document, its ids as little-endian unsigned integers, compressed
  alone with the dictionary, so that a short document is read without its neighbours and still
  compresses well,
* an index, itself one frame: ids of the documents, which of them are null, bytes of each
  frame and number of token ids of each,
* a trailer: where the index begins, how many documents, magic.

The dictionary is trained on a bounded sample of pieces (``SAMPLE_DOCS`` documents, a piece of
``SAMPLE_CHARS`` characters each, picked by hash); every document is written whole. Documents
are encoded once, in a map stage; what is sorted by ``doc_id`` are compressed frames. Tasks
write under names of their own and the manifest names the files that count, so a task that runs
again leaves the archive right. Shards are ranges of ``doc_id``: ``start``, the number of ids
before a document, is the shard's base plus a sum inside the shard. Files are read and written
through ``pyarrow.fs``, in any store that it and Spark both reach.

Every document ends with the id ``END``; the strings of special tokens in a text are ordinary
text. A null text is an empty one. Null ids come first; rows with equal ids are all kept, in the
order of a digest of their token ids. Other columns are ignored. An empty table makes an
archive without shards."""

from __future__ import annotations

import functools
import hashlib
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm.shared import shuffle_partitions, stored
from labeltext.llm.words import row_chunks, text_bytes
from labeltext.session import checkpoint_dir

END = 2
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 4000
DICTIONARY_BYTES = 65_536
LEVEL = 3
# Compressed bytes of a shard, and bytes of text encoded at a time.
SHARD_BYTES, ENCODE_BYTES = 64_000_000, 8_000_000
# Parts of texts whose ids a task keeps, and the longest it keeps.
KNOWN_PARTS, KNOWN_CHARS = 500_000, 32
ROWS = 1000

MAGIC, VERSION = b"LTIDS\0", 1
HEADER, TRAILER = "<6sBB32s", "<QQ6s"

MANIFEST = "file string, first_id long, first_tie long, docs long, tokens long, bytes long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Text columns to arrays of token ids, each with the end id.

    Where the tokenizer cuts texts by the usual byte-level pattern, no piece reaches over the
    change from a visible character to white space. Texts are split there, the library encodes
    each distinct part once, and the parts' ids are put together again; the result is that of
    the whole text. Other tokenizers get whole texts."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.encode_special_tokens = True
        most = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, END)
        self.kind = np.dtype("<u2" if most < 1 << 16 else "<u4")
        rules = json.loads(self.tokenizer.to_str())
        cut = rules["pre_tokenizer"] or {}
        self.splits = (
            rules["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
        )
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The serialized ids of each text; about ``ENCODE_BYTES`` of texts are in hand."""
        end = np.array([END], self.kind).tobytes()
        data, edges = text_bytes(texts)
        for lo, hi in row_chunks(edges, ENCODE_BYTES):
            part, rows = data[edges[lo] : edges[hi]], edges[lo : hi + 1] - edges[lo]
            ids, first = self._ids(part, rows)
            for a, b in zip(first[:-1], first[1:], strict=True):
                yield ids[a:b].tobytes() + end

    def _ids(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and where each row's begin (and the end)."""
        cut = np.zeros(len(data) + 1, bool)
        cut[rows] = True
        if self.splits:
            cut[_splits(data)] = True
        starts = np.flatnonzero(cut[:-1])
        offsets = np.append(starts, len(data)).astype(np.int32)
        parts = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        which = parts.indices.to_numpy()
        often = np.bincount(which, minlength=len(parts.dictionary)) > 1
        ids = self._look_up(parts.dictionary.to_pylist(), often)
        size = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        flat = np.frombuffer(b"".join(ids), self.kind)
        many = size[which]
        ends = np.cumsum(many)
        shift = (np.cumsum(size) - size)[which] - (ends - many)
        at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        at += np.repeat(shift.astype(np.int32), many)
        first = np.concatenate([[0], ends])[np.searchsorted(starts, rows)]
        return flat[at], first

    def _look_up(self, parts: list[str], often: np.ndarray) -> list[bytes]:
        """The ids of the parts; those that come often are remembered."""
        known = self.known
        ids = [known.get(p) for p in parts]
        new = [k for k, x in enumerate(ids) if x is None]
        plain = [k for k in new if self.splits and _plain(parts[k])]
        for k, found in self._joined(parts, plain):
            ids[k] = found
        rest = [k for k in new if ids[k] is None]
        for k, found in zip(rest, self._encode([parts[k] for k in rest]), strict=True):
            ids[k] = found.tobytes()
        if len(known) > KNOWN_PARTS:
            known.clear()
        known.update((parts[k], ids[k]) for k in new if often[k] and len(parts[k]) <= KNOWN_CHARS)
        return ids

    def _joined(self, parts: list[str], plain: list[int]) -> Iterator[tuple[int, bytes]]:
        """Ids of parts without line ends, encoded many together with line ends between: a
        line end among visible characters and single spaces is a piece and a token alone."""
        groups = [plain[k : k + ROWS] for k in range(0, len(plain), ROWS)]
        texts = ["\n".join([parts[k] for k in group]) for group in groups]
        line = self._encode(["\n"])[0][0] if plain else None
        for group, ids in zip(groups, self._encode(texts), strict=True):
            ends = np.append(np.flatnonzero(ids == line), len(ids)).tolist()
            first, data, width = 0, ids.tobytes(), ids.itemsize
            for k, end in zip(group, ends, strict=True):
                yield k, data[first * width : end * width]
                first = end + 1

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind) for x in found]


def _plain(part: str) -> bool:
    """Whether a part has no white space but one space at its beginning."""
    return part.split() == [part[1:] if part[0] == " " else part]


@functools.cache
def encoder(tokenizer: str) -> Encoder:
    """One per Python process: tasks that share a process share the known parts."""
    return Encoder(tokenizer)


def _splits(data: np.ndarray) -> np.ndarray:
    """Places where a piece begins whatever stands around: a space or line end after a visible
    character, and what follows a line end between two visible characters. Visible are those of
    ASCII and letters of two bytes; the lead bytes C3 to DF begin no white space."""
    ascii_ = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF)
    ends, begins = ascii_.copy(), ascii_ | lead
    ends[1:] |= lead[:-1]
    line = data == 0x0A
    white = line | (data == 0x20)
    before = np.flatnonzero(white[1:] & ends[:-1]) + 1
    alone = before[line[before] & (before + 1 < len(data))]
    return np.concatenate([before, alone[begins[alone + 1]] + 1])


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, tokenizer: str, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for serialized ids; empty if the table is too small to train one."""
    length = F.char_length("text")
    rows = docs.where("text is not null").select("doc_id", "text").withColumn(
        "by", F.xxhash64("doc_id", length)
    )
    # Rows with the smallest hashes; a bound on the hash leaves a few times as many as needed.
    share = min(1.0, 4 * SAMPLE_DOCS / max(docs.count(), 1))
    rows = rows.where(F.col("by") <= int(-(2**63) + share * (2**64 - 1025)))
    # A piece from a place given by the hash, so that not only beginnings are seen.
    place = F.pmod(F.xxhash64("by"), F.greatest(length - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    picked = rows.select("by", F.substr("text", place.cast("int"), F.lit(SAMPLE_CHARS)).alias("piece"))
    picked = picked.orderBy("by", "piece").limit(SAMPLE_DOCS)

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_ = encoder(tokenizer)
        for batch in batches:
            ids = list(encoder_.encode(batch.column("piece")))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    samples = [bytes(r[0]) for r in picked.mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _frames(docs: DataFrame, tokenizer: str, dictionary: bytes) -> DataFrame:
    """A row per document with its compressed ids."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_ = encoder(tokenizer)
        held = _dictionary(dictionary)
        if held is not None:
            held.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_checksum=False, write_dict_id=False
        )
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * ROWS):
                part = batch.slice(at, 4 * ROWS)
                ties, many, frames = [], [], []
                for raw in encoder_.encode(part.column("text")):
                    ties.append(int.from_bytes(hashlib.sha256(raw).digest()[:8], "little", signed=True))
                    many.append(len(raw) // encoder_.kind.itemsize)
                    frames.append(packer.compress(raw))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(ties, pa.int64()),
                        pa.array(many, pa.int64()),
                        pa.array([len(f) for f in frames], pa.int64()),
                        pa.array(frames, pa.binary()),
                    ],
                    ["doc_id", "tie", "n_tokens", "size", "frame"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        compress, "doc_id long, tie long, n_tokens long, size long, frame binary"
    )


def write_archive(docs: DataFrame, tokenizer: str, folder: str | None = None) -> str:
    """Encode every document and write the archive; returns its folder. Without ``folder`` it
    goes below the shared checkpoint folder."""
    spark = docs.sparkSession
    if folder is None:
        folder = f"{checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    dictionary = train_dictionary(docs, tokenizer)
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/dictionary") as out:
        out.write(dictionary)
    frames = stored(_frames(docs, tokenizer, dictionary))
    total = frames.agg(F.sum("size")).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-total // SHARD_BYTES))
    width = encoder(tokenizer).kind.itemsize
    head = struct.pack(HEADER, MAGIC, VERSION, width, hashlib.sha256(dictionary).digest())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        batch = next(batches, None)
        if batch is None:
            return
        store, path = _store(folder)
        name = f"shard-{uuid.uuid4().hex}.ids"
        first = [batch.column(k)[0].as_py() for k in ("doc_id", "tie")]
        parts, size = [], len(head)
        with store.open_output_stream(f"{path}/{name}") as out:
            out.write(head)
            while batch is not None:
                for frame in batch.column("frame"):
                    out.write(frame.as_buffer())
                parts.append(batch.select(["doc_id", "size", "n_tokens"]))
                batch = next(batches, None)
            index = pa.Table.from_batches(parts)
            ids, sizes, many = (index[k].combine_chunks() for k in ("doc_id", "size", "n_tokens"))
            size += int(sizes.to_numpy().sum())
            packed = zstandard.compress(
                ids.fill_null(0).to_numpy().astype("<i8").tobytes()
                + ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
                + sizes.to_numpy().astype("<i8").tobytes()
                + many.to_numpy().astype("<i8").tobytes()
            )
            out.write(packed)
            out.write(struct.pack(TRAILER, size, len(ids), MAGIC))
        rows = [[name], [first[0]], [first[1]], [len(ids)], [int(many.to_numpy().sum())], [size]]
        kinds = [pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(rows, kinds, strict=True)],
            ["file", "first_id", "first_tie", "docs", "tokens", "bytes"],
        )

    ranges = frames.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ranges.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards in order, each with ``base``, the number of token ids before it. The window
    without a key is over one row per shard file."""
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_tie").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return rows.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


class Shard:
    """One shard file, open for reading; checks that ``dictionary`` is the one it was written
    with."""

    def __init__(self, store: pafs.FileSystem, path: str, dictionary: bytes):
        self.file = store.open_input_file(path)
        magic, version, width, digest = struct.unpack(
            HEADER, self.file.read_at(struct.calcsize(HEADER), 0)
        )
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{path}: no file of token ids")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path}: written with another dictionary")
        self.kind = np.dtype(f"<u{width}")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per document: id, whether it is null, place and bytes of the frame, token ids."""
        end, tail = self.file.size(), struct.calcsize(TRAILER)
        at, docs, _ = struct.unpack(TRAILER, self.file.read_at(tail, end - tail))
        raw = zstandard.decompress(self.file.read_at(end - tail - at, at))
        ids = np.frombuffer(raw, "<i8", docs)
        null = np.frombuffer(raw, np.uint8, docs, 8 * docs).astype(bool)
        size = np.frombuffer(raw, "<i8", docs, 9 * docs)
        many = np.frombuffer(raw, "<i8", docs, 17 * docs)
        return ids, null, struct.calcsize(HEADER) + np.cumsum(size) - size, size, many

    def ids(self, at: int, size: int) -> np.ndarray:
        """The token ids of the document whose frame lies there."""
        return np.frombuffer(self.unpacker.decompress(self.file.read_at(size, at)), self.kind)


def _open(folder: str, opened: dict, name: str) -> Shard:
    if opened.get("name") != name:
        store, path = _store(folder)
        if "dictionary" not in opened:
            with store.open_input_file(f"{path}/dictionary") as file:
                opened["dictionary"] = file.read()
        opened["name"] = name
        opened["shard"] = Shard(store, f"{path}/{name}", opened["dictionary"])
    return opened["shard"]


def read_archive(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document of the archive, from its files: doc_id, start, n_tokens, ids_crc32 of the
    ids as unsigned 32-bit integers, frame_bytes, and the ids themselves if wanted."""
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long, frame_bytes long"
    if with_ids:
        kind += ", ids array<int>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {}
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = _open(folder, opened, name)
                doc, null, at, size, many = shard.index()
                start = base + np.cumsum(many) - many
                for lo in range(0, len(doc), ROWS):
                    hi = min(lo + ROWS, len(doc))
                    yield from rows(shard, doc, null, at, size, start, lo, hi)

    def rows(shard, doc, null, at, size, start, lo, hi) -> Iterator[pa.RecordBatch]:
        many, crc, held, bytes_ = [], [], [], 0
        first = lo
        for k in range(lo, hi):
            ids = shard.ids(int(at[k]), int(size[k])).astype("<u4")
            many.append(len(ids))
            crc.append(zlib.crc32(ids.tobytes()))
            if with_ids:
                held.append(ids.view("<i4"))
                bytes_ += ids.nbytes
            if k + 1 == hi or bytes_ > SHARD_BYTES:
                span = slice(first, k + 1)
                columns = [
                    pa.array(doc[span], pa.int64(), mask=null[span]), pa.array(start[span]),
                    pa.array(many, pa.int64()), pa.array(crc, pa.int64()), pa.array(size[span]),
                ]
                if with_ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "frame_bytes", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])
                many, crc, held, bytes_, first = [], [], [], 0, k + 1

    files = manifest(spark, folder).select("file", "base")
    return files.repartition(_tasks(spark, folder)).mapInArrow(read, kind)


def _tasks(spark: SparkSession, folder: str) -> int:
    return max(1, spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count())


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document lies: doc_id, file, at, size, n_tokens. Reads the files' ends only."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {}
        for batch in batches:
            for name in batch.column("file").to_pylist():
                doc, null, at, size, many = _open(folder, opened, name).index()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64(), mask=null), pa.array([name] * len(doc), pa.string()),
                        pa.array(at), pa.array(size), pa.array(many),
                    ],
                    ["doc_id", "file", "at", "size", "n_tokens"],
                )

    files = manifest(spark, folder).select("file").repartition(_tasks(spark, folder))
    return files.mapInArrow(read, "doc_id long, file string, at long, size long, n_tokens long")


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of the documents whose ids are in ``wanted``'s column doc_id: only their
    frames are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = {}
        for batch in batches:
            for doc, name, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = _open(folder, opened, name).ids(at, size).astype("<u4").view("<i4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], pa.int64()), pa.array([ids], pa.list_(pa.int32()))],
                    ["doc_id", "ids"],
                )

    places = index(spark, folder).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    places = places.select("doc_id", "file", "at", "size").sortWithinPartitions("file", "at")
    return places.mapInArrow(read, "doc_id long, ids array<int>")
