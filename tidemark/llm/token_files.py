"""Token-id files: each document compressed by itself with a dictionary that all share.

A file holds, one after another: the magic ``TMTOK1``; the SHA-256 of the dictionary; a
zstandard frame for each document, of its ids as little-endian numbers; the index, an Arrow
table of doc_id, offset, size and n_tokens; and the footer: where the index begins, the bytes
of an id, and the magic again. The dictionary lies beside the files under its SHA-256. A
document is read by its index entry alone.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import batches, ready, run_hashes, whole_text
from tidemark.llm.files import opened, put, written
from tidemark.session import shared_dir, stage

END_ID = 0
ROWS_PER_FILE = 4096
SAMPLE_DOCS, SAMPLE_CHARS = 512, 8192   # the dictionary is trained on so many texts of up to so many characters
DICTIONARY_BYTES = 32_768
KNOWN_PIECES = 2_000_000                # pieces whose ids a worker remembers
PIECES_AT_ONCE = 10_000                 # pieces encoded as one text
BATCH_BYTES = 2 << 20
LEVEL = 3
_MAGIC = b"TMTOK1"
_FOOTER = "<QB6s"
# Kinds of bytes. What is not ASCII is of no kind, but for the first byte of letters like é.
_ALNUM, _MARK, _SOLID = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_ALNUM[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_SOLID[0x21:0x7F] = True
_MARK[:] = _SOLID & ~_ALNUM
_STARTS = _SOLID.copy()
_STARTS[0xC3] = True
_ENCODERS: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """Ids of texts, remembering those of pieces met before.

    The vocabulary first cuts a text into words, marks and blanks, a single space going with
    what is behind it. A text is cut here only where that cuts it whatever stands around: before
    a space with no blank behind it, between a letter or digit and a mark, and on either side of
    a line feed that stands alone. So it has the ids of its pieces, one after another.

    Pieces are looked up by a 64-bit hash, in sorted arrays, and compared byte by byte with the piece
    that was learnt under it. Texts with a piece that differs are encoded whole by the library.

    With ``added``, the vocabulary's added tokens, such as <|endoftext|>, are found in a text as
    the library finds them by itself, and what is between them is encoded as texts of its own.
    Without, what looks like a special token is text.
    """

    def __init__(self, path: str, dtype: str, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        tokens = {t.content.encode(): (i, t) for i, t in self.tokenizer.get_added_tokens_decoder().items()} if added else {}
        if any(t.lstrip or t.rstrip or t.single_word or (t.normalized and self.tokenizer.normalizer) for _, t in tokens.values()):
            raise ValueError("the vocabulary has added tokens that take more than their own characters")
        self.added = {content: np.array([i], dtype).tobytes() for content, (i, _) in tokens.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None
        self.tokenizer.encode_special_tokens = True  # pieces hold none
        self.dtype, self.width = dtype, int(dtype[-1])
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # byte-level: a character of a token is a byte
            self.sizes[number] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)                               # hashes, sorted
        self.at, self.count = np.empty(0, np.int64), np.empty(0, np.int64)  # where their ids lie in the pool
        self.pool = np.empty(0, self.dtype)
        self.from_, self.size = np.empty(0, np.int64), np.empty(0, np.int64)  # where their bytes lie in theirs
        self.bytes = np.empty(0, np.uint8)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in found]

    def _together(self, pieces: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of pieces that begin with a space, encoded many as one text; how many each has."""
        ids, counts = [], []
        for i in range(0, len(pieces), PIECES_AT_ONCE):
            some = pieces[i:i + PIECES_AT_ONCE]
            ids += self._encode([b"".join(some)])
            ends = np.cumsum([len(p) for p in some])
            bytes_ = np.cumsum(self.sizes[ids[-1]])
            cuts = np.searchsorted(bytes_, ends) + 1
            if not np.array_equal(bytes_[cuts - 1], ends):
                raise ValueError("the ids of a piece go beyond its end; the vocabulary does not cut before spaces")
            counts.append(np.diff(cuts, prepend=0))
        return ids, np.concatenate([np.empty(0, np.int64), *counts])

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """``hashes`` are sorted, and not known yet."""
        spaced = np.array([p[0] == 0x20 for p in pieces], bool)
        ids, counts = self._together([p for p, s in zip(pieces, spaced, strict=True) if s])
        single = self._encode([p for p, s in zip(pieces, spaced, strict=True) if not s])
        count = np.empty(len(pieces), np.int64)
        count[spaced], count[~spaced] = counts, [len(x) for x in single]
        at = np.empty(len(pieces), np.int64)
        for some in (spaced, ~spaced):
            at[some] = np.cumsum(count[some]) - count[some]
        at[~spaced] += counts.sum()
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.at, self.count = np.insert(self.at, place, at + len(self.pool)), np.insert(self.count, place, count)
        self.pool = np.concatenate([self.pool, *ids, *single])
        size = np.array([len(p) for p in pieces], np.int64)
        self.from_ = np.insert(self.from_, place, np.cumsum(size) - size + len(self.bytes))
        self.size = np.insert(self.size, place, size)
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), np.uint8)])

    def _are(self, place: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> bool:
        """Whether the known pieces at ``place`` are those of ``data``, which lie one after another."""
        if not np.array_equal(self.size[place], sizes):
            return False
        begin = self.from_[place] - (np.cumsum(sizes) - sizes)
        return np.array_equal(self.bytes[np.repeat(begin, sizes) + np.arange(len(data))], data)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text and the end, as bytes."""
        end = np.array([END_ID], self.dtype).tobytes()
        if not self.cuts:
            return [ids + end for ids in self._ids(texts)]
        parts = [self.cuts.split(t) for t in texts]  # every other part is an added token
        between = iter(self._ids([x for p in parts for x in p[::2]]))
        return [b"".join(self.added[x] if k % 2 else next(between) for k, x in enumerate(p)) + end for p in parts]

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if not texts:
            return []
        joined = b"".join(t + b"\t" for t in texts)  # a blank, before which no rule cuts a space off
        after = np.cumsum([len(t) + 1 for t in texts])
        begins, ends = np.concatenate([[0], after[:-1]]), after - 1
        data = np.frombuffer(joined + b"\t", np.uint8)
        here, before, two = data[:-1], np.concatenate([[9], data[:-2]]), np.concatenate([[9, 9], data[:-3]])[:len(joined)]
        cut = (here == 0x20) & _STARTS[data[1:]]
        cut |= _ALNUM[before] & _MARK[here]
        cut |= _SOLID[before] & (here == 0x0A)
        cut |= _SOLID[two] & (before == 0x0A) & _STARTS[here]
        cut[begins] = cut[ends] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(joined))
        of_text = np.ones(len(joined), bool)
        of_text[ends] = False
        keep = of_text[first]
        first, last = first[keep], last[keep]

        hashes, where, which = np.unique(run_hashes(data, first, last), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        new = ~np.isin(hashes, self.known, assume_unique=True)
        if new.any():
            self._learn(hashes[new], [joined[a:b] for a, b in zip(first[where[new]].tolist(), last[where[new]].tolist(), strict=True)])
        place = np.searchsorted(self.known, hashes)[which]
        if not self._are(place, last - first, here[of_text]):
            return [ids.tobytes() for ids in self._encode(texts)]
        count = self.count[place]
        done = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(self.at[place] - done[:-1], count) + np.arange(done[-1])].tobytes()
        from_, to = (done[np.searchsorted(first, x)] * self.width for x in (begins, ends))
        return [ids[a:b] for a, b in zip(from_.tolist(), to.tolist(), strict=True)]


def encoder(path: str, dtype: str) -> Encoder:
    """The encoder of this worker, which outlives a task."""
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = Encoder(path, dtype, added=True)
    return _ENCODERS[path, dtype]


def id_type(path: str) -> str:
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def train_dictionary(docs: DataFrame, path: str, dtype: str) -> bytes:
    """A zstandard dictionary from the ids of a bounded sample; empty where there is too little to learn from.

    The sample is the SAMPLE_DOCS different texts of up to SAMPLE_CHARS characters with the lowest
    hash. Only hashes are ranked; texts come to the driver for those that are chosen.
    """
    text = F.col("text")
    short = docs.where(text.isNotNull() & (F.length(text) <= SAMPLE_CHARS)).select(F.xxhash64(text).alias("place"), "text")
    lowest = short.groupBy("place").agg(F.lit(1).alias("one")).orderBy("place").limit(SAMPLE_DOCS).select("place")
    chosen = short.join(F.broadcast(lowest), "place").groupBy("place").agg(F.min("text").alias("text")).collect()
    samples = Encoder(path, dtype, added=True)([r.text.encode() for r in sorted(chosen)])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(content: bytes, level: int | None = None) -> zstandard.ZstdCompressionDict | None:
    """The dictionary, made ready once where it is to compress many documents."""
    if not content:
        return None
    dictionary = zstandard.ZstdCompressionDict(content)
    if level:
        dictionary.precompute_compress(level=level)
    return dictionary


_INDEX = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("n_tokens", pa.int64())])


def write_files(docs: DataFrame, folder: str, path: str, rows: int) -> DataFrame:
    """Write the documents in ascending order of doc_id; one row per file: part, file, n_docs, n_ids.

    A file is a range of doc_id; within one doc_id, of a hash of the text. Null ids come first.
    """
    dtype = id_type(path)
    content = train_dictionary(docs, path, dtype)
    digest = hashlib.sha256(content).digest()
    put(f"{folder}/dictionary-{digest.hex()}", content)
    order = ["doc_id", "place"]
    ranged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("place"), whole_text().alias("text")
    ).repartitionByRange(max(1, -(-rows // ROWS_PER_FILE)), *order).sortWithinPartitions(*order)

    def write(parts):
        encode, compress = encoder(path, dtype), zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content, LEVEL))
        part, index, at = TaskContext.get().partitionId(), [], len(_MAGIC) + len(digest)
        name = f"{folder}/ids-{part:08d}"
        groups = batches(parts, most=BATCH_BYTES)
        group = next(groups, None)
        if group is None:
            return
        with written(name) as out:
            out.write(_MAGIC + digest)
            while group is not None:
                rest, texts = group
                for doc_id, ids in zip(rest.column(0).to_pylist(), encode(texts), strict=True):
                    frame = compress.compress(ids)
                    out.write(frame)
                    index.append((doc_id, at, len(frame), len(ids) // int(dtype[-1])))
                    at += len(frame)
                group = next(groups, None)
            table = pa.table([pa.array(c, pa.int64()) for c in zip(*index, strict=True)], schema=_INDEX)
            with pa.ipc.new_stream(sink := pa.BufferOutputStream(), _INDEX) as stream:
                stream.write_table(table)
            out.write(sink.getvalue())
            out.write(struct.pack(_FOOTER, at, int(dtype[-1]), _MAGIC))
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(index)], "n_ids": [sum(i[3] for i in index)]})

    return stage(ranged.mapInArrow(write, "part long, file string, n_docs long, n_ids long"), "token_files")


def read_file(name: str, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, number of ids before it in the file, ids: of all documents, or of those wanted."""
    with opened(name) as file:
        size = file.size()
        file.seek(size - struct.calcsize(_FOOTER))
        at, width, magic = struct.unpack(_FOOTER, file.read(struct.calcsize(_FOOTER)))
        file.seek(0)
        head = file.read(len(_MAGIC) + 32)
        if magic != _MAGIC or head[:len(_MAGIC)] != _MAGIC:
            raise ValueError(f"{name} is not a token-id file, or was cut short")
        with opened(f"{name.rpartition('/')[0]}/dictionary-{head[len(_MAGIC):].hex()}") as other:
            content = other.read()
        if hashlib.sha256(content).digest() != head[len(_MAGIC):]:
            raise ValueError(f"the dictionary of {name} has changed")
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        file.seek(at)
        index = pa.ipc.open_stream(file.read(size - struct.calcsize(_FOOTER) - at)).read_all().to_pydict()
        before = 0
        for doc_id, offset, length, n in zip(*index.values(), strict=True):
            if wanted is None or doc_id in wanted:
                file.seek(offset)
                yield doc_id, before, np.frombuffer(expand.decompress(file.read(length)), f"<u{width}")
            before += n


def encode_files(docs: DataFrame, path: str) -> DataFrame:
    """One row per document, from the files read back: doc_id, start, n_tokens, ids_crc32.

    ``path`` is the vocabulary file. The vocabulary's added tokens, such as <|endoftext|>, are
    recognised in a text, as by the library's own call. A document's ids end in id 0. ``start`` is the number of
    ids of all documents before it, by ascending doc_id, null ids first; rows of one doc_id lie
    in the order of a hash of their text. ``ids_crc32`` is that of the ids as little-endian
    32-bit numbers. A null or empty text has the end only. An empty table writes no file and
    gives no rows. Other columns are not read.
    """
    spark = ready(docs.sparkSession)
    written_files = write_files(docs, shared_dir(spark, "token_ids"), path, docs.count())
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = written_files.withColumn("first", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long"))
    spread = files.select("file", "first").repartition(max(1, files.count()), "file")

    def read(parts):
        for batch in parts:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [
                    (doc_id, first + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, before, ids in read_file(name)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
