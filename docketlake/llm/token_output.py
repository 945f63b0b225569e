"""Token ids of documents in binary shards with Elias-Fano document boundaries.

A shard file holds the ids of consecutive documents (ascending ``doc_id``) as one array,
then the boundaries and the document ids as Elias-Fano sequences, then a JSON footer:

    ids | boundaries | doc ids | footer JSON | footer length (u32 LE) | magic

Boundaries are the n+1 offsets 0 .. number of ids, kept in about 2 + log2(U/n) bits each;
``EliasFano.select`` returns any of them from the sampled select directory without a table
of 64-bit offsets. Shards never depend on each other, so a task that is run again after a
lost executor writes the same bytes under the same name.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, shared_folder, small_batches, table, trim

MAGIC = b"DKTTOK01"
END_ID = 2
SHARD_BYTES = 32 << 20
#: Bounds of a worker's cache of encoded pieces; it is emptied when full.
CACHE_PIECES = 800_000
CACHE_BYTES = 32 << 20
ENCODE_BYTES = 2 << 20
LINE_PIECES = 1000
#: Pre-tokens whose ids a worker keeps; all are dropped when there are more.
CACHE_PRETOKENS = 1 << 16
#: The library's pre-tokenizer for which ``_SPLIT`` is known to be the same, on pieces of
#: ``_BASIC``: printable ASCII, line feeds inside, and Latin letters up to U+024F.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_LATIN = "À-ÖØ-öø-ɏ"
_BASIC = rf"^[!-~{_LATIN}]([!-~\n{_LATIN}]*[!-~{_LATIN}])?$"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{_LATIN}]+| ?[0-9]+| ?[^ \nA-Za-z0-9{_LATIN}]+|[ \n]+(?![^ \n])|[ \n]+")
#: Documents whose boundaries are selected at a time when a shard is read.
READ_DOCS = 1 << 14
SAMPLE = 256
BLOCK_SHARDS = 4096
NO_ID = -(1 << 63)
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.int64)
_NTH = np.full((256, 8), 8, dtype=np.int64)  # place of the k-th set bit of a byte, lowest first
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _NTH[_b, _k] = _p


class EliasFano:
    """A non-decreasing sequence of unsigned integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits = n, low_bits
        self._low = np.frombuffer(low + b"\0" * 9, dtype=np.uint8)
        self._high = np.frombuffer(high, dtype=np.uint8)
        self._samples = samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        if n and low_bits:
            parts = []
            for a in range(0, n, 1 << 15):  # 8 values fill whole bytes, so chunks join without gaps
                bits = (v[a : a + (1 << 15), None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
                parts.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
            low = b"".join(parts)
        else:
            low = b""
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        low = self._low[:-9].tobytes()
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(low), len(self._high), len(self._samples))
        return head + low + self._high.tobytes() + self._samples.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, low_bits, a, b, c = struct.unpack_from("<QBQQQ", raw)
        at = struct.calcsize("<QBQQQ")
        return cls(n, low_bits, raw[at : at + a], raw[at + a : at + a + b], np.frombuffer(raw, "<u8", c, at + a + b))

    def __len__(self) -> int:
        return self.n

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        byte, out = bit >> 3, np.zeros(len(i), dtype=np.uint64)
        for k in range(8):
            out |= self._low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        shift = (bit & 7).astype(np.uint64)
        out >>= shift
        rest = self._low[byte + 8].astype(np.uint64) << (np.uint64(63) - shift) << np.uint64(1)
        return (out | rest) & np.uint64((1 << self.low_bits) - 1)

    def select(self, i: int | np.ndarray) -> np.ndarray:
        """The values at the given places: the place of the i-th set bit is found from the
        nearest sample by counting bits of the bytes that follow it."""
        i = np.atleast_1d(np.asarray(i, dtype=np.int64))
        out = np.empty(len(i), dtype=np.int64)
        order = np.argsort(i, kind="stable")
        block = i[order] // SAMPLE
        cuts = np.flatnonzero(np.r_[True, np.diff(block) > 0, True]) if len(i) else np.zeros(1, int)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            k = int(block[a])
            start = int(self._samples[k])
            stop = int(self._samples[k + 1]) if k + 1 < len(self._samples) else len(self._high) * 8
            bytes_ = self._high[start >> 3 : (stop >> 3) + 1].copy()
            bytes_[0] &= 0xFF << (start & 7) & 0xFF
            upto = np.cumsum(_POP[bytes_])
            rank = i[order[a:b]] - k * SAMPLE
            at = np.searchsorted(upto, rank, side="right")
            before = upto[at] - _POP[bytes_[at]]
            out[order[a:b]] = ((start >> 3) + at) * 8 + _NTH[bytes_[at], rank - before]
        return ((out - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low_of(i)


def _byte_marks() -> dict[int, str]:
    """The characters that a byte-level vocabulary has for the bytes of each code point up to U+024F."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    marks = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(marks[b] for b in chr(c).encode()) for c in range(0x250)}


def _strings(column: pa.Array) -> list[str]:
    """As to_pylist, without an Arrow scalar for each string."""
    return column.to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, with equal pieces encoded once.

    A byte-level tokenizer never merges across a single space that stands between two other
    characters, so a text without doubled white space is the concatenation of its pieces.
    New pieces are mostly known words with other signs beside them. Those of letters and signs
    for which the byte-level rule is plain are cut into its pre-tokens here, and each pre-token
    goes to the library's model once. Other new pieces go to the library joined into long lines:
    each of their first tokens, and no other, begins with the mark of a space. Texts that hold the content of an
    added token, or white space that borders on a space, are encoded whole. The cache is Arrow
    data without Python objects and is emptied when it would pass CACHE_PIECES or CACHE_BYTES.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        # a task has one core: threads of the library would take others', and their memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.starts = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        rules = json.loads(self.tokenizer.to_str())
        steps = rules["pre_tokenizer"] or {}
        self.plain = not rules["normalizer"] and not rules["post_processor"] and {k: steps.get(k) for k in _BYTE_LEVEL} == _BYTE_LEVEL
        self.model, self.marks = self.tokenizer.model, _byte_marks()
        self.memo: dict[str, bytes] = {}
        self.odd = regex.compile(r"^$|^[\s\p{Z}\p{C}]|[\s\p{Z}\p{C}]$").search
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_string())  # without the space that leads a piece
        self.ids = np.zeros(0, dtype=self.dtype)
        self.start, self.length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _lists(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_pretokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded``, for pieces of ``_BASIC``."""
        names = _SPLIT.findall(" " + " ".join(pieces)) if pieces else []
        if len(self.memo) > CACHE_PRETOKENS:
            self.memo.clear()
        memo, marks, tokenize, kind = self.memo, self.marks, self.model.tokenize, "H" if self.dtype == "<u2" else "I"
        new = [x for x in dict.fromkeys(names) if x not in memo]
        ascii_ = [x for x in new if x.isascii()]
        others = [x for x in new if not x.isascii()]
        between = "\u0300"  # in no piece of _BASIC
        shown = [between.join(ascii_).replace(" ", marks[32]).replace("\n", marks[10]), between.join(others).translate(marks)]
        for group, text in zip((ascii_, others), shown, strict=True):
            for x, name in zip(group, text.split(between) if group else (), strict=True):
                ids = [t.id for t in tokenize(name)]
                memo[x] = struct.pack(f"<{len(ids)}{kind}", *ids)
        parts = [memo[x] for x in names]
        n = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(self.dtype).itemsize
        first = [i for i, x in enumerate(names) if x[0] == " "]
        return np.frombuffer(b"".join(parts), self.dtype), np.add.reduceat(n, first) if pieces else n

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of ids of each), each piece led by a space."""
        lines = [pieces[a : a + LINE_PIECES] for a in range(0, len(pieces), LINE_PIECES)]
        ids, sizes = [], []
        for line, got in zip(lines, self._lists([" " + " ".join(x) for x in lines]), strict=True):
            cuts = np.flatnonzero(self.starts[got])
            if len(cuts) == len(line) and cuts[0] == 0:
                ids.append(got)
                sizes.append(np.diff(np.r_[cuts, len(got)]))
            else:  # a token of this vocabulary breaks the rule: one by one
                apart = self._lists([" " + x for x in line])
                ids += apart
                sizes.append(np.array([len(x) for x in apart], dtype=np.int64))
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (np.zeros(0, self.dtype), np.zeros(0, np.int64))

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        split = pc.split_pattern(column, " ")
        coded = split.flatten().dictionary_encode()
        first = split.offsets.to_numpy()[:-1]
        names = coded.dictionary
        if len(self.known) + len(names) > CACHE_PIECES or self.known.nbytes + names.nbytes > CACHE_BYTES:
            self._clear()
        slot_of = pc.fill_null(pc.index_in(names, value_set=self.known), -1).to_numpy().astype(np.int64)
        # a piece that is empty or borders on more white space gets no slot
        unknown = np.flatnonzero(slot_of < 0)
        new = names.take(pa.array(unknown))
        basic = pc.match_substring_regex(new, _BASIC).to_numpy(zero_copy_only=False).astype(bool) & self.plain
        rest = _strings(new.filter(pa.array(~basic)))
        fine = np.array([not self.odd(x) for x in rest], dtype=bool)
        taken = np.concatenate([unknown[basic], unknown[~basic][fine]])
        found = self._by_pretokens(_strings(new.filter(pa.array(basic)))), self._encoded([x for x, ok in zip(rest, fine, strict=True) if ok])
        ids, n = (np.concatenate(x) for x in zip(*found, strict=True))
        slot_of[taken] = len(self.start) + np.arange(len(taken))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
        self.length = np.concatenate([self.length, n])
        self.ids = np.concatenate([self.ids, ids])
        self.known = pa.concat_arrays([self.known, names.take(pa.array(taken))])
        pieces = coded.indices.to_numpy()
        slot = slot_of[pieces]
        # first pieces have no space before them: encoded for this batch alone
        head = _strings(names.take(pa.array(pieces[first])))
        heads = {x: i for i, x in enumerate(dict.fromkeys(x for x in head if not self.odd(x)))}
        lists = self._lists(list(heads))
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes, [0]])
        length = np.concatenate([self.length, sizes, [0]])
        flat = np.concatenate([self.ids, *lists])
        slot[first] = [heads.get(x, -1 - len(self.start)) + len(self.start) for x in head]
        whole = np.logical_and.reduceat(slot >= 0, first)
        for token in self.added:
            whole &= ~pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        n = np.where(slot >= 0, length[slot], 0)
        at = np.arange(int(n.sum())) + np.repeat(start[slot] - (np.cumsum(n) - n), n)
        out, sizes = flat[at], np.add.reduceat(n, first)
        if not whole.all():
            parts = np.split(out, np.cumsum(sizes)[:-1])
            again = np.flatnonzero(~whole).tolist()
            for i, got in zip(again, self._lists(column.take(pa.array(again)).to_pylist()), strict=True):
                parts[i] = got
            out, sizes = np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)
        return out, sizes


_encoders: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """One for each Python worker, kept over its tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _id_keys(column: pa.Array) -> np.ndarray:
    """Ids as unsigned numbers in their order, with 0 for null (and for the least long, which
    is read back as null)."""
    ids = column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids.view(np.uint64) ^ np.uint64(1 << 63)


def _pack_ids(keys: np.ndarray, ordered: bool) -> bytes:
    """Ascending ids as an Elias-Fano sequence over the least one; others as they are."""
    if not ordered:
        return keys.astype("<u8").tobytes()
    nulls = int(np.searchsorted(keys, 1))
    base = int(keys[nulls]) if nulls < len(keys) else 0
    return struct.pack("<QQ", nulls, base) + EliasFano.build(keys[nulls:] - np.uint64(base)).to_bytes()


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, ordered: bool = True) -> DataFrame:
    """Encode every text and write shard files; returns the manifest (shard, path, n_docs, n_ids).

    Documents are dealt out by ranges of (doc_id, hash of the text, place in the input), so that
    neither a null nor a repeated ``doc_id`` nor a repeated row gathers in one task. Null texts
    count as empty; null ids come first; rows with the same id keep the order of their texts'
    hashes. Extra columns are ignored. An empty table makes no shard. With ``ordered`` false
    nothing moves: each partition of ``docs`` becomes a shard, in the order of its rows, so that
    a corpus that was shuffled before stays shuffled.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if ordered:
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-total // shard_bytes))
        own = own.select("*", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_u"))
        own = own.repartitionByRange(int(parts), "doc_id", "_h", "_u").sortWithinPartitions(F.asc_nulls_first("doc_id"), "_h").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        filesystem, root = _open(folder)
        filesystem.create_dir(root)
        path = f"{root}/shard-{shard:06d}.tok"
        stream, part = None, f"{path}.{TaskContext.get().taskAttemptId()}"
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            stream = stream or filesystem.open_output_stream(part)
            ids.append(_id_keys(batch.column(0)))
            upto = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
            a = 0
            while a < batch.num_rows:  # as many texts as fit ENCODE_BYTES, one at least
                b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + ENCODE_BYTES, side="right")))
                coded, n = encoder.encode(batch.column(1).slice(a, b - a))
                stream.write(np.insert(coded, np.cumsum(n), end_id).tobytes())
                lengths.append(n + 1)
                a = b
            trim()
        if stream is None:
            return
        offsets = np.concatenate([[0], *lengths]).astype(np.int64).cumsum()
        n_docs, n_ids = len(offsets) - 1, int(offsets[-1])
        bounds = EliasFano.build(offsets).to_bytes()
        keys = _pack_ids(np.concatenate(ids), ordered)
        footer = json.dumps({"dtype": encoder.dtype, "n_docs": n_docs, "n_ids": n_ids, "bounds": len(bounds), "keys": len(keys), "ordered": ordered}).encode()
        stream.write(bounds + keys + footer + struct.pack("<I", len(footer)) + MAGIC)
        stream.close()
        filesystem.move(part, path)  # a file with the final name is always whole
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}.tok"], "n_docs": [n_docs], "n_ids": [n_ids]}, schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    manifest = own.mapInArrow(lean(write), "shard long, path string, n_docs long, n_ids long")
    with small_batches(spark):
        manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


class Shard:
    """Random access to one file: boundaries by select, ids by ranges of the file."""

    def __init__(self, uri: str):
        filesystem, path = _open(uri)
        self.file = filesystem.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        n = struct.unpack("<I", tail[:4])[0]
        self.meta = json.loads(self.file.read_at(n, size - 12 - n))
        at = size - 12 - n - self.meta["keys"]
        keys = self.file.read_at(self.meta["keys"], at)
        self.bounds = EliasFano.from_bytes(self.file.read_at(self.meta["bounds"], at - self.meta["bounds"]))
        self.dtype = np.dtype(self.meta["dtype"])
        self._nulls, self._base, self._keys = 0, 0, keys
        if self.meta["ordered"]:
            self._nulls, self._base = struct.unpack_from("<QQ", keys)
            self._keys = EliasFano.from_bytes(keys[16:])

    def doc_ids(self, a: int, b: int) -> pa.Array:
        """Ids of the documents from place a up to place b."""
        if self.meta["ordered"]:
            at = np.arange(a, b) - self._nulls
            keys = np.zeros(b - a, dtype=np.uint64)
            if (at >= 0).any():
                keys[at >= 0] = self._keys.select(at[at >= 0]) + np.uint64(self._base)
        else:
            keys = np.frombuffer(self._keys, "<u8", b - a, a * 8)
        return pa.array((keys ^ np.uint64(1 << 63)).view(np.int64), pa.int64(), mask=keys == 0)

    def ids(self, start: int, stop: int) -> np.ndarray:
        k = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * k, start * k), self.dtype)


def _bases(manifest: DataFrame) -> DataFrame:
    """path and the number of ids in all shards before it: sums of blocks of shards, then sums
    within each block, so that no task takes the whole manifest."""
    m = manifest.withColumn("block", F.floor(F.col("shard") / BLOCK_SHARDS))
    blocks = m.groupBy("block").agg(F.sum("n_ids").alias("ids"))
    blocks = blocks.select("block", (F.sum("ids").over(Window.orderBy("block")) - F.col("ids")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("block").orderBy("shard")) - F.col("n_ids")
    return m.withColumn("within", within).join(blocks, "block").select("path", (F.col("before") + F.col("within")).alias("base"))


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    n = manifest.sparkSession.sparkContext.defaultParallelism * 2

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(path)
                for first in range(0, shard.meta["n_docs"], READ_DOCS):
                    last = min(first + READ_DOCS, shard.meta["n_docs"])
                    bounds = shard.bounds.select(np.arange(first, last + 1)).astype(np.int64)
                    crcs, a = [], 0
                    while a < last - first:  # about 4 MB of ids at a time
                        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + (1 << 20), side="right")) - 1)
                        ids = shard.ids(int(bounds[a]), int(bounds[b])).astype("<u4")
                        cuts = (bounds[a : b + 1] - bounds[a]).tolist()
                        crcs += [zlib.crc32(ids[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                        a = b
                    yield pa.RecordBatch.from_pydict({"doc_id": shard.doc_ids(first, last), "start": pa.array(bounds[:-1] + base, pa.int64()), "n_tokens": pa.array(np.diff(bounds), pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    return _bases(manifest).repartition(n).mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, folder: str | None = None, ordered: bool = True) -> DataFrame:
    """Write the shards of ``docs`` and return what the files say of each document."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_shards(write_shards(docs, folder or shared_folder(spark, "tokens"), tokenizer, ordered=ordered))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark, table(spark, sf_dir, "documents"))
