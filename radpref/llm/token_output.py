"""Token ids in Arrow stream files of fixed-size-list batches.

A file holds the ids of consecutive documents, each followed by the end id, cut into rows of equal length:
``ids: fixed_size_list<uint16 or uint32>[row_length]`` and ``mask: fixed_size_list<bool>[row_length]``, the
mask false only on what fills up the file's last row. All batches but the last have the same number of rows, and
nothing is compressed, so token k of a file lies at a known place, and a memory-mapped file gives any
sequence without a copy. Beside it, an index file has each document's first token and number of tokens.
Files follow one another by ascending document id.
"""

from __future__ import annotations

import gc
import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from radpref.llm.common import cut, shared_dir, small_batches, text_or_empty

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
ROW_LENGTH = 2048
ROWS_PER_BATCH = 256
#: Words that a Python worker keeps ids of.
_CACHE = 600_000
_STOPS = {b".", b","}
#: How the tokenizer that goes by words cuts a text into pieces. A fixed value.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def stored_as(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def letters_only(word: bytes) -> bool:
    """Whether a word is letters before and after its case is folded."""
    return word.isalpha() or (not word.isascii() and (t := word.decode()).isalpha() and t.lower().isalpha())


def is_plain(word: bytes) -> bool:
    """Whether a word of letters is in lower case and composed form already."""
    return word.isascii() and word.islower() or ((t := word.decode()).lower() == t and unicodedata.is_normalized("NFC", t))


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the collector of cycles, as it would walk a batch's lists of words again and again; these hold none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def goes_by_words(path: str) -> bool:
    """Whether a tokenizer file is of the make that :class:`WordEncoder` takes apart.

    That is: composed and lower-cased text, pieces that are letters alone or hold none and never white
    space, byte-level merges with a mark on a word's end, and special tokens that begin with "<".
    """
    with open(path, encoding="utf-8") as source:
        made = json.load(source)
    steps = lambda part, inner: [x["type"] for x in (made.get(part) or {}).get(inner, [])]
    split = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    return (
        steps("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"]
        and steps("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
        and split.get("pattern", {}).get("Regex") == _PIECES
        and made["model"]["type"] == "BPE"
        and made["model"].get("end_of_word_suffix") == "</w>"
        and all(t["content"].startswith("<") and not t["content"].split()[1:] for t in made.get("added_tokens", []))
    )


class WordEncoder:
    """Ids of whole texts, by words: this tokenizer's tokens never cross white space, and words come again.

    A file of another make is left to the library, text by text.

    A word's ids are kept as bytes ready to be joined. Once there are too many, only words of the last two
    batches stay: those that are common. Letters with one full stop or comma behind them are two
    pieces that never join, so they share the work of the bare word; the tokenizer folds case. A word
    that may hold a special token's name is left as it is. Words of letters alone are encoded many at a
    time, and told apart by the ids that end a word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = stored_as(self.tokenizer.get_vocab_size())
        self.by_words = goes_by_words(path)
        if not self.by_words:
            return
        # plain words are as the normalizer would leave them, and one piece each: the same merges without those steps
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[k for t, k in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.last: set[bytes] = set()
        self.stop = {s: self._each([s.decode()])[0] for s in _STOPS}

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.dtype).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _together(self, words: list[bytes], plain: bool) -> list[bytes]:
        """Of words of letters only, which are one piece each; ``plain``: as :func:`is_plain` says."""
        out: list[bytes] = []
        tokenizer = self.plain if plain else self.tokenizer
        groups = [words[i : i + 200] for i in range(0, len(words), 200)]
        for group, x in zip(groups, tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(x.ids, self.dtype)
            edges = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(edges) != len(group):
                out += self._each([w.decode() for w in group])
                continue
            raw, n = ids.tobytes(), self.dtype.itemsize
            out += [raw[a * n : b * n] for a, b in zip([0, *edges], edges, strict=False)]
        return out

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > _CACHE:
            self.known = {w: self.known[w] for w in words & self.last if w in self.known}
            new = words.difference(self.known)
        self.last = words
        stems, ids_of = [], {}
        plain, letters, others = [], [], []
        for w in new:
            k = w if b"<" in w else w.lower()
            if not (simple := k.isalpha()) and k[-1:] in _STOPS and ((simple := k[:-1].isalpha()) or letters_only(k[:-1])):
                k = k[:-1]
            stems.append(k)
            if k not in ids_of:
                ids_of[k] = self.known.get(k)
                if ids_of[k] is None:
                    (plain if simple else others if not letters_only(k) else plain if is_plain(k) else letters).append(k)
        ways = ((plain, lambda x: self._together(x, True)), (letters, lambda x: self._together(x, False)), (others, lambda x: self._each([k.decode() for k in x])))
        for keys, encode in ways:
            for i in range(0, len(keys), 20_000):
                part = keys[i : i + 20_000]
                ids_of.update(zip(part, encode(part), strict=True))
        self.known.update((w, ids_of[k] if len(w) == len(k) else ids_of[k] + self.stop[w[-1:]]) for w, k in zip(new, stems, strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_words:
            return self._each([t.decode() for t in texts])
        with uncollected():
            split = [(t if b"<" in t else t.lower()).split() for t in texts]
            self.learn(set().union(*split))
            return [b"".join(map(self.known.__getitem__, ws)) for ws in split]


@lru_cache(2)
def encoder_of(path: str) -> WordEncoder:
    """One for each Python worker, whatever number of tasks it runs."""
    return WordEncoder(path)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


class SequenceWriter:
    """Writes one file of the format; memory holds one batch."""

    def __init__(self, uri: str, dtype: np.dtype, row_length: int = ROW_LENGTH, rows_per_batch: int = ROWS_PER_BATCH):
        self.fs, self.path = _open(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}"  # an attempt of its own: a lost task's file is never read
        self.sink = self.fs.open_output_stream(self.part)
        self.row_length, self.full, self.dtype = row_length, row_length * rows_per_batch, dtype
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), row_length)), ("mask", pa.list_(pa.bool_(), row_length))], {"row_length": str(row_length), "rows_per_batch": str(rows_per_batch)})
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.rest = np.zeros(0, dtype)
        self.n = 0

    def _batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.row_length)
        mask = np.zeros(rows * self.row_length, bool)
        mask[: len(ids)] = True
        ids = np.concatenate((ids, np.zeros(len(mask) - len(ids), self.dtype)))
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.row_length) for x in (ids, mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.n += len(ids)
        self.rest = np.concatenate((self.rest, ids))
        while len(self.rest) >= self.full:
            self._batch(self.rest[: self.full])
            self.rest = self.rest[self.full :]

    def close(self) -> None:
        if len(self.rest):
            self._batch(self.rest)
        self.out.close()
        self.sink.close()
        self.fs.move(self.part, self.path)


class SequenceReader:
    """Random access to one file. On a local file ids are views of the mapped file; masks are bits, unpacked when asked for."""

    def __init__(self, uri: str):
        fs, path = _open(uri)
        self.source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        reader = pa.ipc.open_stream(self.source)
        self.row_length = int(reader.schema.metadata[b"row_length"])
        self.rows_per_batch = int(reader.schema.metadata[b"rows_per_batch"])
        self.batches = list(reader)

    def row(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence k: its ids and its mask."""
        batch, at = self.batches[k // self.rows_per_batch], k % self.rows_per_batch
        return batch.column("ids")[at].values.to_numpy(zero_copy_only=True), batch.column("mask")[at].values.to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Tokens from ``start`` on, across rows and batches; without a copy if they lie in one batch."""
        full, parts = self.row_length * self.rows_per_batch, []
        while n > 0:
            ids = self.batches[start // full].column("ids").values.to_numpy(zero_copy_only=True)
            parts.append(ids[start % full : start % full + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_sequences(docs: DataFrame, out_dir: str, tokenizer: str | None = None, end_id: int = END_ID, row_length: int = ROW_LENGTH) -> DataFrame:
    """Encode and write all texts by ascending id. Returns the written manifest: ``file, path, docs, tokens``."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        uri = f"{out_dir}/part-{file:06d}.arrows"
        encoder = writer = index = None
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = encoder_of(path)
                writer = SequenceWriter(uri, encoder.dtype, row_length)
                end = np.array([end_id], encoder.dtype).tobytes()
                fs, at = _open(f"{uri}.index")
                mine = f"{at}.{uuid.uuid4().hex}"
                sink = fs.open_output_stream(mine)
                schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n", pa.int64())])
                index = pa.ipc.new_stream(sink, schema)
            ids = encoder.encode([t.as_buffer().to_pybytes() for t in batch.column("text")])
            n = np.fromiter((len(x) // encoder.dtype.itemsize + 1 for x in ids), np.int64, len(ids))
            first = writer.n + np.cumsum(n) - n
            writer.add(np.frombuffer(b"".join(x + end for x in ids), encoder.dtype))
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(first), pa.array(n)], schema=schema))
            count += len(ids)
        if writer is not None:
            index.close()
            sink.close()
            fs.move(mine, at)
            writer.close()
            yield pa.RecordBatch.from_pylist([{"file": file, "path": uri, "docs": count, "tokens": writer.n}])

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    ordered = body.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return cut(ordered.mapInArrow(run, "file long, path string, docs long, tokens long"), "sequence-manifest")


def read_sequences(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                reader = SequenceReader(r["path"])
                fs, at = _open(f"{r['path']}.index")
                with fs.open_input_stream(at) as source:
                    for part in pa.ipc.open_stream(source):
                        first, n = part.column("first").to_numpy(), part.column("n").to_numpy()
                        crc = [zlib.crc32(reader.tokens(int(a), int(k)).astype("<u4").tobytes()) for a, k in zip(first, n, strict=True)]
                        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(first + r["before"]), part.column("n"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.count()
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut(manifest.withColumn("before", before), "sequence-offsets")  # one row a file
    return offsets.repartition(max(1, files), "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, row_length: int = ROW_LENGTH) -> DataFrame:
    """Write all documents' ids to a new folder of the cluster's shared one, and return what the files hold.

    A null or empty text is the end id alone. Null ids come first; rows of the same id stand in the order
    of their texts, each for itself. An empty table writes no file and gives an empty result.
    """
    manifest = write_sequences(docs, shared_dir(docs.sparkSession, "sequences"), tokenizer, end_id, row_length)
    return read_sequences(manifest)
