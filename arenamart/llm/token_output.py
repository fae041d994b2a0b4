"""Token-ID output: frequency-ranked ids in a byte-aligned variable-length code.

Every text is encoded with a tokenizer of the ``tokenizers`` library and ends with id 0. All ids of the
corpus are counted; the most frequent id gets rank 0, and so on. The files hold ranks: of every rank
only its 1 to 4 significant bytes, and, apart from them, control bytes with two bits (bytes - 1) for
each of four ranks. A table of the 256 control bytes gives the four lengths when reading.

The container is a folder of Parquet files, so that Spark's committer deals with lost tasks and any
shared store: file ``part`` k holds the k-th range of document ids, and its rows are blocks in order
(block, first token, document ids and their token counts, control bytes, data bytes). The folder
``vocabulary`` beside ``blocks`` maps ranks to ids.

Encoding splits a text before white space; there the tokenizer's own pattern always starts a new piece, so
the pieces can be encoded one by one. Each Python worker keeps the ids of pieces that it has met, up to
``PIECES``, and the library encodes only new ones. Texts with the string of an added token, such as
``<|endoftext|>``, are encoded whole and get that token's id, as the loaded tokenizer gives it.

Defined results: a null text counts as empty and has only the end id; documents with equal ids keep
their rows, in order of length and content; a null id comes first; an empty table gives no rows; extra
columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arenamart.llm.common import read, stored
from arenamart.session import fresh_path

TOKENIZER = "byte_bpe_50k.json"
END = 0
#: Pieces that a worker remembers; then it starts afresh. Half as many take about 100 MB less of a worker
#: and cost a tenth more CPU time; the ids are the same.
PIECES = 2_000_000
#: Texts that are encoded at a time: so many rows, or bytes if that is less (a longer text goes alone).
SLICE_ROWS, SLICE_BYTES = 4096, 2 << 20
#: Ids in one block, and in one part, about.
BLOCK_IDS = 1 << 20
PART_IDS = 1 << 24
#: Texts that are not split: empty ones, those with other white space than single spaces and line feeds
#: between pieces. The strings of added tokens come behind it.
WHOLE = r"^$|^[ \n]|[ \n]$|[ \n][ \n]|[\t\r\x0b\x0c\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _grown(array: np.ndarray, filled: int, size: int) -> np.ndarray:
    """``array`` with room for ``size`` elements; only the filled ones are copied."""
    if size <= len(array):
        return array
    more = np.empty(max(size, 2 * len(array)), array.dtype)
    more[:filled] = array[:filled]
    return more


class Encoder:
    """Ids of whole texts, with the ids of known pieces kept in one array.

    ``ordinary`` reads the strings of special tokens as ordinary text; the operator leaves the tokenizer
    as it is loaded.
    """

    def __init__(self, path: str, ordinary: bool = True, pieces: int | None = None):
        self.pieces = pieces
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        # The tokenizer looks for added tokens before it splits, so that texts with one stay whole.
        added = [a.content for a in self.tokenizer.get_added_tokens_decoder().values() if a.content]
        self.whole = "|".join([WHOLE, *(re.sub(r"(\W)", r"\\\1", a) for a in added)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # A byte-level vocabulary writes each byte of a token as one letter.
        self.bytes_of = np.ones(1 + max(vocabulary.values()), np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        # Room beyond what is filled stays untouched and takes no memory.
        self.ids, self.filled = np.empty(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32)

    def _keep(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Appends ids that belong to ``pieces`` one after the other."""
        n = len(self.known)
        self.starts, self.lengths = (_grown(a, n, n + len(pieces)) for a in (self.starts, self.lengths))
        self.ids = _grown(self.ids, self.filled, self.filled + len(ids))
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.lengths[n : n + len(pieces)] = lengths
        self.starts[n : n + len(pieces)] = self.filled + np.cumsum(lengths) - lengths
        self.filled += len(ids)
        self.known.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        # The fast form leaves out the places of tokens in the text, which nothing here asks for.
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, names: list[str], pieces: pa.Array) -> None:
        """Encodes new pieces, many in one text; the bytes of the ids tell where each ends."""
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pieces, pa.scalar(" ", pa.large_string()))
        full = pc.if_else(pc.starts_with(pieces, "\n"), pieces, spaced)
        # An Arrow array holds its strings one behind the other.
        edges, data = np.frombuffer(full.buffers()[1], np.int64)[full.offset :][: len(full) + 1], memoryview(full.buffers()[2])
        for at in range(0, len(names), 1024):
            edge = edges[at : at + 1025]
            ids = self._ids([str(data[edge[0] : edge[-1]], "utf-8")])[0]
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), edge[1:] - edge[0]) + 1
            self._keep(names[at : at + 1024], ids, np.diff(ends, prepend=0))

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text, the end id not included.

        A text is split into parts that start with one space (left out) or one line feed: before a run of
        white space the tokenizer's pattern always starts anew, so that the ids of a text are those of its
        parts, put together. Each distinct part of the texts is looked up once.
        """
        if len(self.known) > (self.pieces or PIECES):
            self.clear()
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return []
        whole = pc.match_substring_regex(texts, self.whole)
        # A text that stays whole is its own first piece.
        split = pc.split_pattern(pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n"), " ")
        pieces, sizes = split.flatten(), split.value_lengths().to_numpy()
        first = np.cumsum(sizes) - sizes
        # The first piece of a text has no space before it and is encoded with the whole texts.
        heads = self._ids(pc.if_else(whole, texts, pieces.take(pa.array(first))).to_pylist())
        behind = np.ones(len(pieces), bool)
        behind[first] = False
        flat = pieces.filter(pa.array(behind)).dictionary_encode()
        distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = list(map(self.known.get, distinct))
        if None in codes:
            new = pa.array([c is None for c in codes])
            self._learn([p for p, c in zip(distinct, codes, strict=True) if c is None], flat.dictionary.filter(new))
            codes = list(map(self.known.get, distinct))
        codes = np.array(codes, np.int64)[flat.indices.to_numpy()]
        lengths = self.lengths[codes].astype(np.int64)
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[codes] - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        tails = np.split(self.ids[places], np.append(0, ends)[np.cumsum(sizes - 1)][:-1])
        return [np.concatenate(x) if len(x[1]) else x[0] for x in zip(heads, tails, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str, pieces: int | None = None) -> Encoder:
    return Encoder(path, ordinary=False, pieces=pieces)


def _pack(ids: np.ndarray) -> bytes:
    """Ids as two bytes each where that is enough, else four, compressed; the first byte says which."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    return bytes([width]) + pa.compress(ids.astype(f"<u{width}").tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(memoryview(data)[1:], decompressed_size=data[0] * n, codec="zstd", asbytes=True)
    return np.frombuffer(raw, f"<u{data[0]}")


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Place and length of the slices of a batch; neighbours may all be long, as after a sort by size."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        most = (ends[at - 1] if at else 0) + SLICE_BYTES
        stop = min(max(at + 1, int(np.searchsorted(ends, most, "right"))), at + SLICE_ROWS)
        yield at, stop - at
        at = stop


IDS = "doc_id bigint, n bigint, ids binary, seen array<bigint>, times array<bigint>"


def _tokenize(path: str, pieces: int | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row of ids for every document, and one row with the id counts of the task behind them."""
    names = [f.split()[0] for f in IDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = encoder(path, pieces), np.zeros(0, np.int64)
        for batch in batches:
            for at, rows in _slices(batch.column("text")):
                part = batch.slice(at, rows)
                ids = [np.append(x, np.uint32(END)) for x in own.encode(pc.fill_null(part.column("text"), ""))]
                counts = np.bincount(np.concatenate(ids), minlength=len(total))
                counts[: len(total)] += total
                total = counts
                none = pa.nulls(len(ids), pa.list_(pa.int64()))
                arrays = [part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array(map(_pack, ids), pa.binary()), none, none]
                yield pa.RecordBatch.from_arrays(arrays, names)
        # The worker lives on, so what its texts took goes back.
        pa.default_memory_pool().release_unused()
        seen = np.flatnonzero(total)
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (seen, total[seen])]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), *lists], names)

    return run


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2^32."""
    ranks = ranks.astype("<u4")
    code = (ranks > 0xFF).astype("u1") + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.pad(code, (0, -len(code) % 4)).reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view("u1").reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.astype("u1").tobytes(), data.tobytes()


#: Lengths of the four ranks of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, "u1")].ravel()[:n]
    raw = np.frombuffer(data, "u1")
    starts = np.cumsum(lengths) - lengths
    ranks = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        ranks[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


BLOCKS = "part int, block int, first bigint, n bigint, doc_ids array<bigint>, lengths array<bigint>, control binary, data binary"


def _blocks(rank_of: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted documents of one part to blocks; a document never spans two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first, held = TaskContext.get().partitionId(), 0, 0, []

        def row() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            control, data = encode_ranks(rank_of[ids])
            names = [f.split()[0] for f in BLOCKS.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            values = [part, block, first, len(ids), [d for d, _ in held], [len(x) for _, x in held], control, data]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        size = 0
        for batch in batches:
            for doc_id, n, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids")), strict=True):
                if held and size + n > BLOCK_IDS:
                    yield row()
                    block, first, held, size = block + 1, first + size, [], 0
                held.append((doc_id, _unpack(data, n)))
                size += n
        if held:
            yield row()

    return run


def _rows(id_of: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = id_of[decode_ranks(r["control"], r["data"], r["n"])].astype("<u4")
                sizes = np.array(r["lengths"], np.int64)
                ends = np.cumsum(sizes)
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes, ends, strict=True)]
                arrays = [[r["part"]] * len(sizes), r["doc_ids"], r["first"] + ends - sizes, sizes, crc]
                kinds = [pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], ["part", "doc_id", "first", "n_tokens", "ids_crc32"]
                )

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, pieces: int | None = None) -> None:
    """Writes ``blocks`` and ``vocabulary`` below ``path`` for all documents, by ascending doc_id."""
    spark, file = docs.sparkSession, public_tokenizers.path(tokenizer)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tokenized = stored(rows.mapInArrow(_tokenize(file, pieces), IDS), "token-ids")
    each = tokenized.where("seen is not null").select(F.inline(F.arrays_zip(F.col("seen").alias("id"), F.col("times").alias("n"))))
    counts = each.groupBy("id").agg(F.sum("n").alias("n"))
    ids = tokenized.where("seen is null").select("doc_id", "n", "ids")
    ranked = counts.orderBy(F.desc("n"), "id").collect()  # bounded by the vocabulary
    id_of = np.array([r["id"] for r in ranked], np.int64)
    rank_of = np.zeros(int(id_of.max(initial=0)) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of))
    parts = 1 + sum(r["n"] for r in ranked) // PART_IDS
    dealt = ids.repartitionByRange(int(parts), F.col("doc_id").asc_nulls_first())
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", F.crc32("ids"))
    vocabulary = spark.createDataFrame([(k, r["id"], r["n"]) for k, r in enumerate(ranked)], "rank bigint, id bigint, n bigint")
    vocabulary.coalesce(1).write.parquet(f"{path}/vocabulary")
    dealt.mapInArrow(_blocks(rank_of), BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    known = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()  # bounded by the vocabulary
    id_of = np.array([r["id"] for r in known], np.uint32)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rows = blocks.mapInArrow(_rows(id_of), "part int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    joined = rows.join(F.broadcast(parts), "part")
    return joined.select("doc_id", (F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Writes the files of ``docs`` to a new path in the shared folder and reads them back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_tokens(docs, path, pieces=pieces)
    return read_tokens(spark, path)


def op8_tokens(spark, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"))
