"""Token ids on disk with Elias-Fano document boundaries.

A store is a folder of two Parquet tables:

``blocks``  one row per block of consecutive documents (about ``block_tokens``
            ids): ``shard``, ``block``, ``first`` (ids of the shard before the
            block), ``n_docs``, ``n_tokens``, ``doc_ids``, ``ids`` (all ids, little
            endian, ``width`` bytes each) and the boundaries ``low``, ``high``,
            ``hints``
``shards``  ``shard``, ``start`` (ids of all shards before it)

The ends of a block's documents are an Elias-Fano sequence: ``low`` packs the
low ``l`` bits of each end, ``high`` holds the rest in unary (bit ``(end >> l) +
i`` is set for end ``i``), about ``2 + log2(ids / documents)`` bits a document;
``hints`` keeps the place of every 256th set bit, from which ``select`` finds any
end without a table of offsets.  Shards are ranges of the document order, so
blocks by (shard, block) are the documents in ascending order.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import WordCache, pieces

HINT_EVERY = 256
#: White space of the tokenizer's splitter (fixed values: Unicode White_Space).
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_SPLIT = re.compile("[" + "".join(map(chr, WHITE_SPACE)) + "]+")
#: What str.split() takes for white space besides.
_ODD = re.compile("[\x1c-\x1f]")


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence of ``n`` integers up to ``universe``."""

    n: int
    universe: int
    low: bytes
    high: bytes
    hints: bytes

    @staticmethod
    def bits(n: int, universe: int) -> int:
        return max(0, (universe // max(n, 1)).bit_length() - 1)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> "EliasFano":
        v = np.asarray(values, np.int64)
        n, l = len(v), cls.bits(len(v), universe)
        low = ((v[:, None] >> np.arange(l)) & 1).astype(np.uint8) if l else np.zeros((n, 0), np.uint8)
        places = (v >> l) + np.arange(n)
        high = np.zeros((universe >> l) + n + 1, np.uint8)
        high[places] = 1
        return cls(n, universe, np.packbits(low.ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), places[::HINT_EVERY].astype("<u4").tobytes())

    def values(self) -> np.ndarray:
        """All values."""
        l = self.bits(self.n, self.universe)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        out = (places - np.arange(self.n)) << l
        if l:
            low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * l].reshape(self.n, l)
            out |= (low.astype(np.int64) << np.arange(l)).sum(axis=1)
        return out

    def select(self, i: int) -> int:
        """Value ``i``: from the nearest hint on, bytes are passed by their count of set bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        l = self.bits(self.n, self.universe)
        place = int(np.frombuffer(self.hints, "<u4")[i // HINT_EVERY])
        left = i % HINT_EVERY
        byte, bit = divmod(place, 8)
        cur = self.high[byte] >> bit << bit
        while left >= cur.bit_count():
            left -= cur.bit_count()
            byte += 1
            cur = self.high[byte]
        for _ in range(left):
            cur &= cur - 1
        place = byte * 8 + (cur & -cur).bit_length() - 1
        first = i * l
        chunk = int.from_bytes(self.low[first // 8:(first + l + 7) // 8], "little") >> first % 8
        return (place - i) << l | (chunk & ((1 << l) - 1))


#: Texts of these characters only are lower-cased and cut at the ends of words
#: before they are looked up: up to Latin Extended-B (but for the dotted capital
#: I), dashes, quotes and the euro sign, where lower case commutes with NFC.
#: Control characters 1C to 1F are white space for some splitters only.
_NOT_PLAIN = r"[^\x{00}-\x{1B}\x{20}-\x{12F}\x{131}-\x{24F}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20AC}]|<\|"
#: A mark after a letter starts a token of its own (apostrophes may not).
_MARK = r"([a-z\x{DF}-\x{F6}\x{F8}-\x{FF}])([.,;:!?])"


#: Words of these letters are single units for the tokenizer's model.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, (*range(0xE0, 0xF7), *range(0xF8, 0x100))))
_LETTERS_ONLY = re.compile(f"[{_LETTERS}]+").fullmatch


@functools.lru_cache(maxsize=2)
def _words(path: str) -> WordCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    code = "H" if t.get_vocab_size() <= 1 << 16 else "I"

    def whole(words: list[str]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for e in t.encode_batch_fast(words, add_special_tokens=False)]

    # a word of plain letters needs no normalizing and splitting: it goes to the model as the splitter would spell it
    spelling = {ord(c): t.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _LETTERS} if t.pre_tokenizer else {}
    model = t.model

    def direct(word: str) -> bytes:
        return array(code, [x.id for x in model.tokenize(word.translate(spelling))]).tobytes()

    probe = ["the", "zwölfé", _LETTERS, "qxzj"]
    if [direct(w) for w in probe] != whole(probe):
        return WordCache(whole, 600_000)

    def compute(new: list[str]) -> list[bytes]:
        plain = list(map(_LETTERS_ONLY, new))
        rest = iter(whole([w for w, p in zip(new, plain) if not p]))
        return [direct(w) if p else next(rest) for w, p in zip(new, plain)]

    return WordCache(compute, 600_000)


def _encode(cache: WordCache, texts: pa.Array, kind: np.dtype, end_id: int) -> list[bytes]:
    """Ids of each text and the end id.  No token of the vocabulary spans white
    space, nor the end of a word and the mark after it, so the parts between
    are encoded one by one, each distinct part once."""
    plain = pc.invert(pc.match_substring_regex(texts, _NOT_PLAIN))
    out: list[bytes] = [b""] * len(texts)
    end = np.array([end_id], kind).tobytes()
    for i in np.flatnonzero(~np.asarray(plain)):
        text = texts[int(i)].as_py()
        words = [w for w in _SPLIT.split(text) if w] if _ODD.search(text) else text.split()
        out[i] = b"".join(cache.values_of(words)) + end
    where = np.flatnonzero(np.asarray(plain))
    if not len(where):
        return out
    spaced = pc.replace_substring_regex(pc.utf8_lower(texts.filter(plain)), _MARK, r"\1 \2")
    parts = pc.utf8_split_whitespace(spaced)
    counts, parts = np.asarray(pc.list_value_length(parts)), parts.flatten()
    # the splitter gives empty parts at the ends of a text
    filled = np.asarray(pc.greater(pc.binary_length(parts), 0))
    owner = np.repeat(np.arange(len(where)), counts)[filled]
    coded = parts.filter(pa.array(filled)).dictionary_encode()
    values = cache.values_of(coded.dictionary.to_pylist())
    length = np.fromiter(map(len, values), np.int64, len(values)) // kind.itemsize
    flat, start = np.frombuffer(b"".join(values), kind), np.concatenate([[0], np.cumsum(length)])[:-1]
    code = np.asarray(coded.indices)
    n = length[code]
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    ids = flat[np.repeat(start[code] - first, n) + np.arange(int(n.sum()))]
    ends = np.cumsum(np.bincount(owner, n, len(where)).astype(np.int64))
    whole = np.insert(ids, ends, end_id).tobytes()
    bounds = (np.concatenate([[0], ends + np.arange(1, len(where) + 1)]) * kind.itemsize).tolist()
    for i, a, b in zip(where.tolist(), bounds, bounds[1:]):
        out[i] = whole[a:b]
    return out


def _width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id",
                text_col: str = "text", block_tokens: int = 1 << 20) -> None:
    """Encode ``text_col`` (null: empty) of all rows in ascending order of
    ``id_col`` (nulls first, equal ids by text) and write the store.

    Every document ends with ``end_id``, so an empty one has one id.  The rows
    are dealt by ranges of (id, hash of the text): no range is one key's unless
    whole rows repeat.  A document longer than a block is a block of its own.
    An empty table gives an empty store.  Other columns are ignored.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    width = _width(tokenizer)
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard = _words(tokenizer), TaskContext.get().partitionId()
        first = block = size = 0
        names: list[pa.Array] = []
        parts: list[bytes] = []

        def row():
            nonlocal first, block, size
            ends = np.cumsum([len(p) // width for p in parts])
            total = int(ends[-1])
            ef = EliasFano.encode(ends, total)
            keys = pa.concat_arrays(names)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([len(parts)], pa.int32()), pa.array([total], pa.int64()), pa.array([width], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                 pa.array([b"".join(parts)], pa.binary()), pa.array([ef.low], pa.binary()),
                 pa.array([ef.high], pa.binary()), pa.array([ef.hints], pa.binary())],
                names=["shard", "block", "first", "n_docs", "n_tokens", "width", "doc_ids", "ids", "low", "high", "hints"])
            first, block, size = first + total, block + 1, 0
            names.clear()
            parts.clear()
            return out

        for batch in batches:
            for part, texts in pieces(batch, "__t"):
                keys, since = part.column("__id"), 0
                for i, ids in enumerate(_encode(cache, pa.array(texts, pa.string()), kind, end_id)):
                    parts.append(ids)
                    size += len(parts[-1]) // width
                    if size >= block_tokens:
                        names.append(keys.slice(since, i + 1 - since))
                        since = i + 1
                        yield row()
                if since < len(texts):
                    names.append(keys.slice(since))
        if parts:
            yield row()

    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).withColumn("__x", F.xxhash64("__t"))
    d = d.repartitionByRange("__id", "__x").sortWithinPartitions("__id", "__x").select("__id", "__t")
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("first", T.LongType()),
        T.StructField("n_docs", T.IntegerType()), T.StructField("n_tokens", T.LongType()), T.StructField("width", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(d.schema["__id"].dataType)), T.StructField("ids", T.BinaryType()),
        T.StructField("low", T.BinaryType()), T.StructField("high", T.BinaryType()), T.StructField("hints", T.BinaryType())])
    d.mapInArrow(run, schema).write.parquet(f"{path}/blocks")
    spark = docs.sparkSession
    # one small row per shard (a task of the write), never per document
    totals = spark.read.schema(schema).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    start, rows = 0, []
    for r in totals:
        rows.append((r["shard"], start))
        start += r["n"]
    spark.createDataFrame(rows, "shard int, start bigint").coalesce(1).write.parquet(f"{path}/shards")


def read_store(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of a store: ``id_col``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` (of its ids as little-endian
    unsigned 32-bit integers), all from the files."""
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {k: batch.column(k)[i] for k in batch.schema.names}
                ef = EliasFano(b["n_docs"].as_py(), b["n_tokens"].as_py(), b["low"].as_py(), b["high"].as_py(), b["hints"].as_py())
                ends = ef.values()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = np.frombuffer(b["ids"].as_py(), f"<u{b['width'].as_py()}")
                crc = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(starts, ends)]
                base = b["start"].as_py() + b["first"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [b["doc_ids"].values, pa.array(starts + base, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["__id", "start", "n_tokens", "ids_crc32"])

    with_start = blocks.drop("block").join(F.broadcast(spark.read.parquet(f"{path}/shards")), "shard")
    return with_start.mapInArrow(run, f"__id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("__id", id_col)
