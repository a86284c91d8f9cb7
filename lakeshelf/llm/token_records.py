"""Token ids as length-delimited binary records with masked checksums, and an index of offsets.

A shard holds the documents of one range of doc_id in ascending order. A record is framed as

    length (8 bytes), masked CRC-32C of these 8 bytes (4), payload, masked CRC-32C of the payload (4)

all little-endian; the mask rotates the checksum by 15 bits and adds 0xA282EAD8. A payload is: flags (1 byte;
1: doc_id is null), doc_id (8), number of ids (4), width of an id in bytes (1), and the ids in
Zstandard. Beside each shard lies ``<shard>.idx`` with one entry of 16 bytes for each record, its offset and
number of ids, so that a reader can fetch records in any order.

Defined results: a null or empty text gives a record with the end id alone; rows with equal doc_ids
are all written, ordered by text; null doc_ids come first; an empty table gives no shard. Texts are
encoded whole. Encoding runs on the text's runs between ASCII white space, each distinct run once per
worker: the tokenizer drops white space and never joins across it, so the ids are those of the text.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zlib
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.llm.common import batch, scratch_path, shuffle_partitions, small_batches, stored, texts_of
from lakeshelf.llm.shared_files import created, opened, opened_at

END_ID = 1
#: Documents of a shard, about.
SHARD_DOCS = 20_000
#: Runs that are encoded in one text.
JOINED_RUNS = 64
MASK_ADD = 0xA282EAD8

# ---------------------------------------------------------------- CRC-32C of many messages at once

_POLY = 0x82F63B78  # fixed value: the Castagnoli polynomial, reflected
_ROW = 256


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Tables for four message bytes in one step, and for the passing of a row of zero bytes."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(_POLY), first >> 1).astype(np.uint32)
    steps = [first]
    for _ in range(3):
        steps.append(first[steps[-1] & 255] ^ (steps[-1] >> 8))
    step = np.stack(steps)
    passing = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(_ROW):
        passing = first[passing & 255] ^ (passing >> 8)
    return step, passing


_STEP, _PASS = _tables()
_ONE = [int(x) for x in _STEP[0]]


def masked_of_head(head: bytes) -> int:
    """The masked CRC-32C of a few bytes."""
    crc = 0xFFFFFFFF
    for x in head:
        crc = _ONE[(crc ^ x) & 255] ^ (crc >> 8)
    crc ^= 0xFFFFFFFF
    return (((crc >> 15) | (crc << 17)) + MASK_ADD) & 0xFFFFFFFF


def crc32c(messages: list[bytes]) -> np.ndarray:
    """The CRC-32C of each message (of at least four bytes)."""
    if not messages:
        return np.empty(0, np.uint32)
    sizes = np.array([len(m) for m in messages])
    rows = -(-sizes // _ROW)
    ends = np.cumsum(rows) * _ROW
    data = np.zeros(int(ends[-1]), np.uint8)  # messages end at a row's end; zeros before them change nothing
    for m, e, n in zip(messages, ends, sizes):
        data[e - n : e] = np.frombuffer(m, np.uint8)
    head = ((ends - sizes)[:, None] + np.arange(4)).ravel()
    data[head] ^= 255  # the initial state of ones
    columns = data.view("<u4").reshape(-1, _ROW // 4).T
    state = np.zeros(len(data) // _ROW, np.uint32)
    for word in columns:
        x = state ^ word
        state = _STEP[3][x & 255] ^ _STEP[2][(x >> 8) & 255] ^ _STEP[1][(x >> 16) & 255] ^ _STEP[0][x >> 24]
    starts = np.cumsum(rows) - rows
    total = np.zeros(len(messages), np.uint32)
    order = np.argsort(-rows, kind="stable")
    for k in range(int(rows.max())):
        live = order[: int(np.searchsorted(-rows[order], -k, side="left"))]
        t = total[live]
        t = _PASS[0][t & 255] ^ _PASS[1][(t >> 8) & 255] ^ _PASS[2][(t >> 16) & 255] ^ _PASS[3][t >> 24]
        total[live] = t ^ state[starts[live] + k]
    return ~total


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_ADD)


def frames(payloads: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    checks = masked(crc32c(payloads)).tolist()
    return [h + struct.pack("<I", masked_of_head(h)) + p + struct.pack("<I", c) for h, p, c in zip(heads, payloads, checks)]


def read_frames(stream, portion: int = 1 << 22) -> Iterator[list[bytes]]:
    """The payloads of a stream of records, some MB at a time; a failed checksum is an error."""
    while True:
        heads, payloads, tails, size = [], [], [], 0
        while size < portion:
            head = stream.read(12)
            if not head:
                break
            if len(head) < 12:
                raise ValueError("a record ends early")
            n = struct.unpack("<Q", head[:8])[0]
            if masked_of_head(head[:8]).to_bytes(4, "little") != head[8:]:
                raise ValueError("a record's length fails its checksum")
            body = stream.read(n + 4)
            if len(body) < n + 4:
                raise ValueError("a record ends early")
            payloads.append(body[:n])
            tails.append(body[n:])
            size += n
        if not payloads:
            return
        want = np.frombuffer(b"".join(tails), "<u4")
        if (masked(crc32c(payloads)) != want).any():
            raise ValueError("a record fails its checksum")
        yield payloads


# ---------------------------------------------------------------- encoding

#: A mark after letters or digits is a piece of its own for the tokenizer.
_MARKS = frozenset(bytes([c]) for c in b".,!?;:|$%&#*")

#: The character that a byte-level vocabulary has for each byte: itself where it is visible, else one from 256 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = dict(zip([*_VISIBLE, *sorted(set(range(256)).difference(_VISIBLE))], [*_VISIBLE, *range(256, 512)]))


def _plain_word(word: str) -> bool:
    """Letters alone, which no normalizer changes."""
    return word.isalpha() and (word.isascii() and word.islower() or word == word.lower() and unicodedata.is_normalized("NFC", word))


def _byte_level(word: bytes) -> str:
    return word.decode() if word.isascii() else word.decode("latin-1").translate(_BYTE_CHARS)


_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts; every distinct run of non-space characters is encoded once (and again after a reset)."""

    #: Runs that are remembered: some 200 MB.
    LIMIT = 1_200_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between, self.one_piece = self._separator(), self._takes_words_whole()
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) < 1 << 16 else 4
        self._reset()

    def _reset(self) -> None:
        self.place: dict[bytes, int] = {}
        self.sizes, self.starts, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    @staticmethod
    def _folded(text: bytes) -> bytes:
        """A-Z in lower case, as the tokenizer has it, unless the text may name a special token."""
        return text if b"<|" in text else text.lower()

    def _learn(self, runs: set[bytes]) -> None:
        """Add runs; one that is letters or digits and a last mark is put together from the two."""
        marked, words, rest = [], [], []
        for r in runs:
            word = r.decode()
            if r[-1:] in _MARKS and (word[:-1].isalpha() or r[:-1].isalnum()):
                marked.append(r)
            else:
                (words if self.one_piece and _plain_word(word) else rest).append(r)
        known = self.place.keys()
        parts = ({r[:-1] for r in marked}.union(_MARKS) - known).difference(runs)
        for r in parts:
            (words if self.one_piece and _plain_word(r.decode()) else rest).append(r)
        if words:
            pieces = [[t.id for t in self.tokenizer.model.tokenize(_byte_level(r))] for r in words]
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
            self._append(words, np.fromiter(chain.from_iterable(pieces), np.uint32, int(sizes.sum())), sizes)
        self._add(rest)
        if marked:
            core = np.fromiter((self.place[r[:-1]] for r in marked), np.int64, len(marked))
            mark = np.fromiter((self.place[r[-1:]] for r in marked), np.int64, len(marked))
            both = np.stack([core, mark], axis=1).ravel()
            sizes = self.sizes[both]
            self._append(marked, self._gather(both), sizes.reshape(-1, 2).sum(axis=1))

    def _takes_words_whole(self) -> bool:
        """Whether the tokenizer gives a lower-case word to its model as one piece, byte for byte."""
        made = json.loads(self.tokenizer.to_str())
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        pattern = steps[0].get("pattern", {}).get("Regex", "") if len(steps) == 2 else ""
        letters = r"[\p{L}]+" in pattern.split("|") and steps[1]["type"] == "ByteLevel"
        if not letters or steps[1]["add_prefix_space"] or steps[1]["use_regex"]:
            return False
        words = "the and a zugegeben été façade øre język слово λόγος שלום 日本語 xqzj".split()
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return ids == [[t.id for t in self.tokenizer.model.tokenize(_byte_level(w.encode()))] for w in words]

    def _separator(self) -> tuple[int, str] | None:
        """A special token that stands for one id wherever it is put, if the tokenizer has one."""
        for number, token in sorted(self.tokenizer.get_added_tokens_decoder().items()):
            alone = self.tokenizer.encode(f"a{token.content}a", add_special_tokens=False).ids
            if token.special and "<|" in token.content and alone.count(number) == 1:
                return number, token.content
        return None

    def _add(self, runs: list[bytes]) -> None:
        """Encode and remember runs. Some are put in one text with a special token between them, which no run can hold
        (those with its opening are encoded one by one): an encoding costs more than a short run in it."""
        odd = [r for r in runs if not self.between or b"<|" in r]
        if odd:
            plain = [e.ids for e in self.tokenizer.encode_batch_fast([r.decode() for r in odd], add_special_tokens=False)]
            sizes = np.fromiter(map(len, plain), np.int64, len(plain))
            self._append(odd, np.fromiter(chain.from_iterable(plain), np.uint32, int(sizes.sum())), sizes)
            runs = [r for r in runs if self.between and b"<|" not in r]
        if runs:
            number, token = self.between
            mark = token.encode()
            texts = [mark.join(runs[k : k + JOINED_RUNS] + [b""]).decode() for k in range(0, len(runs), JOINED_RUNS)]
            parts = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.concatenate(parts)
            ends = np.flatnonzero(ids == number)
            if len(ends) != len(runs):
                raise ValueError("the tokenizer joins runs across its special token")
            self._append(runs, ids[ids != number], np.diff(ends, prepend=-1) - 1)

    def _append(self, runs: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(runs, range(len(self.place), len(self.place) + len(runs))))
        self.starts = np.r_[self.starts, len(self.pool) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.pool = np.r_[self.pool, ids]

    def _gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of the runs at these places, one after another."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.pool[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(at) else 0)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, the end id last. Each distinct run of a batch is looked up once."""
        if len(self.place) > self.LIMIT:
            self._reset()
        split = pc.ascii_split_whitespace(pa.array([self._folded(t.encode()) for t in texts], pa.large_binary()).cast(pa.large_string()))
        numbered = split.flatten().dictionary_encode()
        runs = numbered.dictionary.cast(pa.large_binary()).to_pylist()
        found = np.fromiter(map(self.place.get, runs, repeat(-1)), np.int64, len(runs))
        unknown = np.flatnonzero(found < 0)
        new = [runs[k] for k in unknown.tolist()]
        if new:
            self._learn(set(new) - {b""})
            found[unknown] = np.fromiter(map(self.place.get, new, repeat(-1)), np.int64, len(new))
        at = found[numbered.indices.to_numpy()]
        real = at >= 0  # white space at a text's ends leaves an empty run
        ends = np.r_[0, np.cumsum(real)][split.offsets.to_numpy()]
        at = at[real]
        ids = self._gather(at)
        ends = np.r_[0, np.cumsum(self.sizes[at])][ends].tolist()
        return [np.append(ids[a:b], np.uint32(END_ID)) for a, b in zip(ends, ends[1:])]


# ---------------------------------------------------------------- writing and reading

_SHARDS = "shard long, path string, n_docs long, n_tokens long"


def write_shards(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write doc_id and text of ``docs``; one row per shard: shard, path, n_docs, n_tokens."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "token-records")
    schema = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}.rec"
        encoder, pack, offset, docs_n, ids_n = Encoder.of(tokenizer), zstandard.ZstdCompressor(level=1), 0, 0, 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with created(path) as out, created(f"{path}.idx") as index:
            for b in chain([first], batches):
                payloads, counts = [], []
                for i, ids in zip(b.column(0).to_pylist(), encoder.encode(texts_of(b.column(1)))):
                    body = pack.compress(ids.astype(f"<u{encoder.width}").tobytes())
                    payloads.append(struct.pack("<BqIB", i is None, i or 0, len(ids), encoder.width) + body)
                    counts.append(len(ids))
                records = frames(payloads)
                sizes = np.array([len(r) for r in records], np.int64)
                out.write(b"".join(records))
                index.write(np.stack([offset + np.cumsum(sizes) - sizes, counts], axis=1).astype("<i8").tobytes())
                offset, docs_n, ids_n = offset + int(sizes.sum()), docs_n + len(counts), ids_n + sum(counts)
        yield batch(schema, [shard], [path], [docs_n], [ids_n])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    parts = max(shuffle_partitions(spark), docs.count() // SHARD_DOCS)
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write, _SHARDS), "token-shards")


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of a record."""
    null, doc_id, n, width = struct.unpack_from("<BqIB", payload)
    ids = zstandard.ZstdDecompressor().decompress(payload[14:], max_output_size=n * width)
    return None if null else doc_id, np.frombuffer(ids, f"<u{width}", n)


def read_record(path: str, k: int) -> tuple[int | None, np.ndarray]:
    """The k-th record of a shard, found by its index."""
    with opened_at(f"{path}.idx") as index:
        offset = int(np.frombuffer(index.read_at(16, 16 * k), "<i8")[0])
    with opened_at(path) as data:
        n = struct.unpack("<Q", data.read_at(8, offset))[0]
        return parse(next(read_frames(pa.BufferReader(data.read_at(16 + n, offset))))[0])


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per record: doc_id, start, n_tokens, ids_crc32, read back from the shards.

    ``start`` counts the ids of all documents before it, over all shards.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with opened(path) as stream:
                    for payloads in read_frames(stream):
                        rows = [parse(p) for p in payloads]
                        sizes = np.array([len(ids) for _, ids in rows])
                        starts = start + np.cumsum(sizes) - sizes
                        start += int(sizes.sum())
                        crcs = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in rows]
                        yield batch(schema, [i for i, _ in rows], starts, sizes, crcs)

    small_batches(shards.sparkSession)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # over one row per shard
    placed = shards.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    spread = placed.repartition(max(1, shuffle_partitions(shards.sparkSession)), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_shards(write_shards(docs, tokenizer))
