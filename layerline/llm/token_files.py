"""Token ids in Arrow stream files with fixed-size lists.

Documents are tokenized in the order of their ids and laid end to end into
sequences of one length. A file is an Arrow IPC stream whose record batches hold
the same number of sequences, so sequence i lies in batch i // rows at i % rows
and a memory-mapped file gives its ids and masks without copying. Columns:

- ``input_ids`` fixed_size_list<uint16>, or uint32 for a vocabulary beyond 65,536
- ``attention_mask`` fixed_size_list<bool>, a bit each: false where a file's last sequence is filled up
- ``start_mask`` fixed_size_list<bool>: true where a document starts
- ``doc_ids`` list: the documents that start in the sequence

Each task writes a file of its own, under a name no other attempt has, and
reports it as a row of the manifest. Spark's own write commits the manifest, so
a file of a lost or repeated attempt is never read: the manifest does not name it.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string
from tokenizers import Tokenizer

from layerline.llm.work import Work

MANIFEST = "part int, path string, seq_len int, batch_rows int, documents long, sequences long, tokens long"
#: Words and pieces whose ids are remembered, and characters encoded at a time.
KNOWN_WORDS, KNOWN_PIECES, SLICE_CHARACTERS = 200_000, 100_000, 1 << 20
#: Longer words and pieces, in bytes and characters, are not remembered. New words are parted so many at a time.
LONGEST_KNOWN, NEW_WORDS = 64, 2_000
# The steps of a tokenizer that drops white space, as its file states them.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class TextEncoder:
    """Ids of whole texts, whatever the tokenizer."""

    def __init__(self, settings: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(settings)

    def texts(self, texts: pa.Array | list[str | None]) -> Iterator[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column, start = pc.fill_null(column, ""), 0
        ends = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < len(column):
            before = ends[start - 1] if start else 0
            end = min(int(np.searchsorted(ends, before + SLICE_CHARACTERS)) + 1, len(column))
            yield from self.ids(column[start:end])
            start = end

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for encoding in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False):
            yield np.array(encoding.ids, dtype="<u4")


class PieceEncoder(TextEncoder):
    """For a tokenizer that drops white space and lower-cases (see ``encoder_for``): ids are looked up by piece.

    Neither tokens nor any step before them reach across ASCII white space, so a
    text is the words between it, and each word's ids are remembered as they are
    written. A new word is parted into pieces by the tokenizer's pattern, tokens lie
    within one, and only new pieces go to the tokenizer's model. That holds for Latin
    letters, where every character is its own normal form; words with any other
    character, and those that may hold a special token, go through the whole
    tokenizer, one by one.
    """

    def __init__(self, settings: str):
        super().__init__(settings)
        self.model, self.known = self.tokenizer.model, {}
        self.words, self.once = {}, set()
        # Below the first combining mark.
        of_kind = {"L": "", "N": ""}
        for character in map(chr, range(0x21, 0x250)):
            kind = unicodedata.category(character)[0]
            of_kind[kind] = of_kind.get(kind, "") + character
        letters, numbers = re.escape(of_kind["L"]), re.escape(of_kind["N"])
        self.piece = re.compile(rf"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{numbers}]|[^\s{letters}{numbers}]+")
        self.parted = re.compile(f" |{self.piece.pattern}")
        self.plain = re.compile(r"[\t-\r -~\u00A1-\u024F]*")
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [byte for byte in range(256) if byte not in shown]
        table = {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}
        self.byte_text = "".join(table[byte] for byte in range(256))

    def pieces(self, word: str) -> list[str]:
        """A piece that starts with a line feed is a whole word for the tokenizer."""
        lower = word.lower()
        return self.piece.findall(lower) if self.is_plain(word, lower) else ["\n" + word]

    def is_plain(self, text: str, lower: str) -> bool:
        return "<|" not in text and bool(self.plain.fullmatch(text) and self.plain.fullmatch(lower))

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for known, most in ((self.words, KNOWN_WORDS), (self.once, KNOWN_WORDS), (self.known, KNOWN_PIECES)):
            if len(known) > most:
                known.clear()
        parted = pc.ascii_split_whitespace(texts)
        named = parted.flatten().dictionary_encode()
        place, found = named.indices.to_numpy(), self._known_ids(named.dictionary)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        table, firsts = np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(sizes) - sizes
        # Where each text's words end among all of these texts' words, and its ids among all of their ids.
        words = parted.offsets.to_numpy().astype(np.int64) - parted.offsets[0].as_py()
        for start, end in zip(words[:-1].tolist(), words[1:].tolist()):
            own = place[start:end]
            counts = sizes[own]
            stops = np.cumsum(counts)
            total = int(stops[-1]) if len(stops) else 0
            yield table[np.arange(total) + np.repeat(firsts[own] - stops + counts, counts)]

    def _known_ids(self, distinct: pa.Array) -> list[bytes]:
        """Ids of different words, in their order."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(distinct)], distinct), pa.scalar(" ", distinct.type))
        words = joined.cast(pa.large_binary())[0].as_py().split()
        if len(words) < len(distinct):
            words.insert(pc.index(distinct, "").as_py(), b"")
        found = [*map(self.words.get, words)]
        places = [i for i, ids in enumerate(found) if ids is None]
        for start in range(0, len(places), NEW_WORDS):
            some = places[start : start + NEW_WORDS]
            # Most new words never come again: one is remembered when it comes for the second time.
            for i, (word, ids) in zip(some, self._word_ids([words[i] for i in some])):
                found[i] = ids
                if word in self.once:
                    self.words[word] = ids
                elif len(word) <= LONGEST_KNOWN:
                    self.once.add(word)
        return found

    def _word_ids(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """The words with their ids. They are parted together, with a sign between them that stands for no token."""
        text = b" ".join(words).decode()
        lower = text.lower()
        if self.is_plain(text, lower):
            pieces = self.parted.findall(lower)
        else:
            pieces = [piece for word in words for piece in (" ", *self.pieces(word.decode()))][1:]
        new = set(pieces).difference(self.known, (" ",))
        self._learn(new)
        self.known[" "] = b"\xff\xff\xff\xff"
        ids = b"".join(map(self.known.__getitem__, pieces))
        for piece in new:
            if len(piece) > LONGEST_KNOWN:
                del self.known[piece]
        ends = 4 * np.flatnonzero(np.frombuffer(ids, dtype="<u4") == 2**32 - 1)
        starts = [0, *(ends + 4).tolist()]
        return zip(words, [ids[start:end] for start, end in zip(starts, [*ends.tolist(), len(ids)])])

    def _learn(self, new: set[str]) -> None:
        words = [piece for piece in new if piece[0] == "\n"]
        for word, found in zip(words, self.tokenizer.encode_batch_fast([w[1:] for w in words], add_special_tokens=False)):
            self.known[word] = np.array(found.ids, dtype="<u4").tobytes()
        for piece in new.difference(words):
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.byte_text)
            ids = [token.id for token in self.model.tokenize(shown)]
            self.known[piece] = struct.pack(f"<{len(ids)}I", *ids)


def encoder_for(settings: str) -> TextEncoder:
    """Pieces only where the tokenizer's steps are exactly those that ``PieceEncoder`` relies on."""
    steps = json.loads(settings)
    plain = all(not token["lstrip"] and not token["rstrip"] for token in steps["added_tokens"])
    named = all(token["content"].startswith("<|") for token in steps["added_tokens"])
    same = (steps["normalizer"], steps["pre_tokenizer"], steps["post_processor"]) == (NORMALIZER, PRE_TOKENIZER, None)
    return (PieceEncoder if same and plain and named else TextEncoder)(settings)


def worker_encoder(settings: str) -> TextEncoder:
    """One per worker process: tasks that follow one another in it find the pieces of those before.

    This module travels with each task, so what is to outlast one lives with ``sys``.
    """
    kept = sys.__dict__.setdefault("_layerline_encoder", {})
    if settings not in kept:
        kept.clear()
        kept[settings] = encoder_for(settings)
    return kept[settings]


def _fixed(values: np.ndarray, size: int) -> pa.FixedSizeListArray:
    return pa.FixedSizeListArray.from_arrays(pa.array(values), size)


def sequence_schema(seq_len: int, token_type: pa.DataType, id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("input_ids", pa.list_(token_type, seq_len)),
            ("attention_mask", pa.list_(pa.bool_(), seq_len)),
            ("start_mask", pa.list_(pa.bool_(), seq_len)),
            ("doc_ids", pa.list_(id_type)),
        ]
    )


class SequenceWriter:
    """Holds one batch of sequences at a time, however long the documents are."""

    def __init__(self, sink, batch_rows: int, schema: pa.Schema):
        self.schema, self.seq_len = schema, schema.field("input_ids").type.list_size
        self.capacity = self.seq_len * batch_rows
        self.ids = np.zeros(self.capacity, schema.field("input_ids").type.value_type.to_pandas_dtype())
        self.stream = pa.ipc.new_stream(sink, schema)
        self.used, self.doc_ids, self.doc_places = 0, [], []
        self.documents = self.sequences = self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.documents += 1
        self.tokens += len(ids)
        at = 0
        while at < len(ids):
            if self.used == self.capacity:
                self._flush()
            if not at:
                self.doc_ids.append(doc_id)
                self.doc_places.append(self.used)
            n = min(len(ids) - at, self.capacity - self.used)
            self.ids[self.used : self.used + n] = ids[at : at + n]
            self.used, at = self.used + n, at + n

    def _flush(self) -> None:
        rows = -(-self.used // self.seq_len)
        if not rows:
            return
        end = rows * self.seq_len
        self.ids[self.used : end] = 0
        starts = np.zeros(end, bool)
        starts[self.doc_places] = True
        offsets = np.searchsorted(self.doc_places, np.arange(rows + 1) * self.seq_len).astype(np.int32)
        doc_ids = pa.array(self.doc_ids, self.schema.field("doc_ids").type.value_type)
        columns = [_fixed(x, self.seq_len) for x in (self.ids[:end], np.arange(end) < self.used, starts)]
        columns.append(pa.ListArray.from_arrays(pa.array(offsets), doc_ids))
        self.stream.write_batch(pa.record_batch(columns, schema=self.schema))
        self.sequences += rows
        self.used, self.doc_ids, self.doc_places = 0, [], []

    def close(self) -> None:
        self._flush()
        self.stream.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    seq_len: int = 2048,
    batch_rows: int = 256,
) -> DataFrame:
    """Writes the documents' ids in ascending id order and returns the manifest, a row per file in that order.

    ``folder`` is where all executors can write, on a file system that Arrow
    reaches. The tokenizer's file is read here and sent along. Null text is empty
    and leaves its end id. Null ids come first; rows of one id follow their
    texts' hash. No documents give no files.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        settings = file.read()
    most = max(end_id, *Tokenizer.from_str(settings).get_vocab().values())
    settings = spark.sparkContext.broadcast(settings)
    token_type = pa.uint16() if most < 2**16 else pa.uint32()
    schema = sequence_schema(seq_len, token_type, to_arrow_type(docs.schema[doc_id].dataType))
    manifest = pa.schema(
        [("part", pa.int32()), ("path", pa.string()), ("seq_len", pa.int32()), ("batch_rows", pa.int32())]
        + [(name, pa.int64()) for name in ("documents", "sequences", "tokens")]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = sink = None
        end = np.array([end_id], "<u4")
        part = TaskContext.get().partitionId()
        path = f"{folder.rstrip('/')}/part-{part:05d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                files, name = fs.FileSystem.from_uri(path)
                files.create_dir(os.path.dirname(name), recursive=True)
                sink = files.open_output_stream(name)
                writer = SequenceWriter(sink, batch_rows, schema)
                encoder = worker_encoder(settings.value)
            ids = batch.column(0).to_pylist()
            for one, found in zip(ids, encoder.texts(batch.column(1))):
                writer.add(one, np.concatenate([found, end]))
        if writer is not None:
            writer.close()
            sink.close()
            row = [part, path, seq_len, batch_rows, writer.documents, writer.sequences, writer.tokens]
            yield pa.record_batch([pa.array([x], t) for x, t in zip(row, manifest.types)], schema=manifest)

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    # The last key only deals out rows that are alike in the others; their order is the same to a reader.
    dealt = rows.repartitionByRange(F.col("id").asc_nulls_first(), "hash", F.spark_partition_id())
    ordered = dealt.sortWithinPartitions(F.col("id").asc_nulls_first(), "hash").select("id", "text")
    return Work(spark, "token-manifest").keep(ordered.mapInArrow(write, MANIFEST), "manifest")


def open_stream(path: str) -> pa.ipc.RecordBatchStreamReader:
    """Local files are memory-mapped."""
    files, name = fs.FileSystem.from_uri(path)
    if isinstance(files, fs.LocalFileSystem):
        return pa.ipc.open_stream(pa.memory_map(name))
    return pa.ipc.open_stream(files.open_input_file(name))


class TokenFile:
    """Sequences of one file by place, as Arrow arrays that view the file; ``ids`` also as numpy view."""

    def __init__(self, path: str):
        self.batches = list(open_stream(path))
        self.rows = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(batch.num_rows for batch in self.batches)

    def __getitem__(self, i: int) -> dict[str, pa.Array]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = self.batches[i // self.rows], i % self.rows
        return {name: batch.column(name)[row].values for name in ("input_ids", "attention_mask", "start_mask")}

    def ids(self, i: int) -> np.ndarray:
        return self[i]["input_ids"].to_numpy(zero_copy_only=True)


def file_documents(path: str) -> Iterator[tuple]:
    """(id, place of the first token in the file, number of tokens, crc32 of the ids), read batch by batch."""
    current, place = None, 0
    for batch in open_stream(path):
        ids = batch.column("input_ids").flatten().to_numpy(zero_copy_only=True)
        used = batch.column("attention_mask").flatten().true_count
        starts = batch.column("start_mask").flatten().to_numpy(zero_copy_only=False)
        firsts = np.flatnonzero(starts[:used]).tolist()
        names = batch.column("doc_ids").flatten().to_pylist()
        # What comes before the first start goes on from the batch before.
        pieces = [(0, firsts[0] if firsts else used, None)]
        pieces += zip(firsts, [*firsts[1:], used], [[name, place + at, 0, 0] for name, at in zip(names, firsts)])
        for at, end, begun in pieces:
            if begun:
                if current:
                    yield tuple(current)
                current = begun
            if end > at:
                current[2] += end - at
                current[3] = zlib.crc32(ids[at:end].astype("<u4"), current[3])
        place += used
    if current is not None:
        yield tuple(current)


def read_documents(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """A row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, path."""
    # One row per file, so one task can order them.
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    placed = manifest.select("path", before.alias("before")).repartition(max(1, manifest.count()))
    schema = pa.schema(
        [("doc_id", to_arrow_type(_parse_datatype_string(id_type)))]
        + [(name, pa.int64()) for name in ("start", "n_tokens", "ids_crc32")]
        + [("path", pa.string())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                found = file_documents(path)
                while rows := list(islice(found, 10_000)):
                    ids, starts, counts, sums = zip(*rows)
                    columns = [ids, [offset + start for start in starts], counts, sums, [path] * len(rows)]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    columns = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, path string"
    return placed.mapInArrow(read, columns)
