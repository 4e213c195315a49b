"""Token ids in binary segments: one zstandard frame per document, a shared dictionary.

Format (version 1). A store is a folder with two Parquet tables.

``segments``: one row per segment, a run of documents in ascending doc_id order
of at most about ``SEGMENT_BYTES`` compressed bytes (one document at least):
``shard`` and ``segment`` (order of the run), ``dict_sha256``, ``base`` (ids
before the segment within its shard), ``doc_ids``, ``offsets`` (one more than
documents, byte positions in ``payload``), ``n_tokens`` and ``payload`` (the
frames one after the other). A frame is one document's ids as little-endian
unsigned 32-bit integers, compressed alone with the shared dictionary, so a
single short document is read by its offsets without its neighbours.

``dictionary``: one row (``dict_sha256``, ``dictionary``); empty bytes when
there was too little to train on.

The dictionary is trained on a bounded sample of whole documents
(``sample_rows``, ``sample_bytes``); every document is encoded and stored.

Defined results: null text is empty text, and an empty text holds the end id
alone; rows with the same id are all stored, ordered by their text; null ids
sort first; texts of any length are one frame; an empty table gives an empty
store and no rows. Other columns are not stored.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import _byte_alphabet
from .common import prepare, slices

SEGMENT_BYTES = 1 << 20
LEVEL = 3
REMEMBER = 450_000
#: Words that the library's model gets as one text.
WORDS = 100
#: Marks that close a word; the tokenizer cuts them from letters.
_MARKS = ".,;:!?"
#: Letters that NFC leaves as they are and whose lower case does not depend on their
#: neighbours (Latin without capital dotted I, Cyrillic; not Greek).
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u045f"
#: The tokenizer's cut of such letters and printable ASCII; other characters match nothing.
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+").findall
#: The character of each byte in the vocabulary; the space stays, to part words.
_BYTE_CHARS = "".join(c if b != 0x20 else " " for c, b in
                      sorted(_byte_alphabet().items(), key=lambda x: x[1]))


class CachedTokenizer:
    """The tokenizers library behind a memory of white-space separated pieces, for files
    of one kind: lower-cased, byte-level, words closed by ``</w>``.

    The tokenizer drops white space and never joins text across it, so the ids
    of a text are those of its pieces between spaces and line breaks in order.
    Pieces met before are not encoded again. The memory holds two generations:
    when the newer one is full it becomes the older, whose pieces come back when
    met. An unknown piece of printable ASCII and ``_LETTERS`` is lowered and cut
    here as the tokenizer does it, and its parts go to the library's model, many
    as one spaced text, told apart by the ids that end a word. Other unknown
    pieces go through the whole tokenizer, as one spaced text too, told apart by
    their offsets; marks that close a word of letters are cut off first.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.words = Tokenizer(self.lib.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocab = self.lib.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.seen: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, pieces: list[bytes]) -> None:
        """Pieces that are not in ``seen``, from the older generation or the library."""
        seen, older = self.seen, self.older
        made, parts, odd = [], set(), set()
        for p in pieces:
            known = older.get(p)
            if known is not None:
                seen[p] = known
            elif p.isalpha():  # of bytes: ASCII letters
                word = p.lower()
                parts.add(word)
                if word != p:
                    made.append((p, [word]))
            else:
                text = p.decode()
                low = text.lower()
                cut = _CUT(low)
                if len("".join(cut)) == len(low) and "<|" not in low:
                    cut = [x.encode() for x in cut]
                    parts.update(cut)
                    if cut != [p]:
                        made.append((p, cut))
                    continue
                head = text.rstrip(_MARKS)
                if len(head) < len(text) and head.lower().isalpha():
                    cut = [head.encode(), text[len(head):].encode()]
                    odd.update(cut)  # letters stay letters in lower case, so the cut holds
                    made.append((p, cut))
                else:
                    odd.add(p)
        for todo, encode, step in ((parts, self._encode_words, 20_000), (odd, self._encode, 2_000)):
            new = []
            for x in todo:
                if x not in seen:
                    known = older.get(x)
                    if known is None:
                        new.append(x)
                    else:
                        seen[x] = known
            for lo in range(0, len(new), step):
                some = new[lo:lo + step]
                seen.update(zip(some, encode(some), strict=True))
        for p, cut in made:
            seen[p] = b"".join([seen[x] for x in cut])

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        texts = [codecs.charmap_decode(b" ".join(words[lo:lo + WORDS]), "strict", _BYTE_CHARS)[0]
                 for lo in range(0, len(words), WORDS)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in
                              self.words.encode_batch_fast(texts, add_special_tokens=False)])
        raw, ends = ids.tobytes(), 4 * (np.flatnonzero(self.closes[ids]) + 1)
        return [raw[a:b] for a, b in itertools.pairwise([0, *ends.tolist()])]

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        text = [p.decode() for p in pieces]
        enc = self.lib.encode(" ".join(text), add_special_tokens=False)
        starts = np.cumsum([0, *(len(p) + 1 for p in text[:-1])])
        tokens = np.array([start for start, _ in enc.offsets], np.int64)
        cut = 4 * np.append(np.searchsorted(tokens, starts), len(tokens))
        raw = np.array(enc.ids, "<u4").tobytes()
        return [raw[a:b] for a, b in itertools.pairwise(cut.tolist())]

    def batch(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. Arrow cuts the texts and numbers their pieces; each
        different piece is looked up once, and what is not remembered is learned."""
        if len(self.seen) > REMEMBER:
            self.seen, self.older = {b"": b""}, self.seen
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts.cast(pa.binary()), b""), "\n", " "), " ")
        numbered = cut.flatten().dictionary_encode()
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.seen.get, pieces))
        gaps = [i for i, x in enumerate(ids) if x is None]
        self._learn([pieces[i] for i in gaps])
        for i in gaps:
            ids[i] = self.seen[pieces[i]]
        # 64-bit offsets: the ids of one long text may pass 2 GB
        ids = pa.array(ids, pa.large_binary()).take(numbered.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[cut.offsets.to_numpy()]
        raw = ids.buffers()[2] or pa.py_buffer(b"")  # none where all are empty
        return [raw[a:b].to_pybytes() for a, b in itertools.pairwise(ends.tolist())]


_TOKENIZERS: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    if path not in _TOKENIZERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _TOKENIZERS[path] = CachedTokenizer(path)
    return _TOKENIZERS[path]


def _end(end_id: int | None) -> bytes:
    return b"" if end_id is None else np.array([end_id], "<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, end_id: int | None, sample_rows: int = 1_000,
                     sample_bytes: int = 8 << 20, size: int = 64 << 10) -> bytes:
    """A zstandard dictionary from the ids of at most about ``sample_rows`` whole
    documents (by a hash of the id), the shortest first up to ``sample_bytes``."""
    total = docs.count()
    rows = docs
    if total > sample_rows:
        cut = int((1 << 30) * sample_rows / total)
        rows = rows.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) < cut)

    def run(batches):
        tok = tokenizer(path)
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_pydict({"ids": pa.array(
                [x + _end(end_id) for x in tok.batch(b.column("text"))], pa.binary())})

    got = rows.select("text").mapInArrow(run, "ids binary").withColumn("n", F.length("ids"))
    samples, held = [], 0
    for r in got.orderBy("n", "ids").limit(2 * sample_rows).toLocalIterator():
        if held + len(r["ids"]) > sample_bytes:
            break
        samples.append(bytes(r["ids"]))
        held += len(r["ids"])
    if len(samples) < 16 or held < 8 * size // 4:
        return b""
    try:
        return zstandard.train_dictionary(min(size, held // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _codec_dict(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write(docs: DataFrame, folder: str, path: str, end_id: int | None = None,
          partitions: int | None = None) -> str:
    """Encode ``docs`` (doc_id, text) with the tokenizer file ``path`` into ``folder``."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw = train_dictionary(docs, path, end_id)
    sha = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(sha, bytearray(raw))], "dict_sha256 string, dictionary binary") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(raw)

    def run(batches):
        from pyspark import TaskContext

        tok, tail = tokenizer(path), _end(end_id)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_codec_dict(shared.value),
                                        write_content_size=True)
        shard = TaskContext.get().partitionId()
        base = segment = 0
        ids, frames, counts = [], [], []

        def flush():
            nonlocal base, segment
            off = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype(np.int64)
            out = pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "segment": pa.array([segment], pa.int32()),
                "dict_sha256": [sha], "base": pa.array([base], pa.int64()),
                "doc_ids": pa.array([ids[:]], pa.list_(pa.int64())),
                "offsets": pa.array([off.tolist()], pa.list_(pa.int64())),
                "n_tokens": pa.array([counts[:]], pa.list_(pa.int64())),
                "payload": pa.array([b"".join(frames)], pa.binary())})
            base += sum(counts)
            segment += 1
            for x in (ids, frames, counts):
                x.clear()
            return out

        for b in slices(batches, "text"):
            held = sum(map(len, frames))
            for doc, arr in zip(b.column("doc_id").to_pylist(),
                                tok.batch(b.column("text")), strict=True):
                full = arr + tail
                frame = pack.compress(full)
                if frames and held + len(frame) > SEGMENT_BYTES:
                    yield flush()
                    held = 0
                ids.append(doc)
                frames.append(frame)
                counts.append(len(full) // 4)
                held += len(frame)
        if frames:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    ranged = docs.repartitionByRange(partitions, order[0]) if partitions \
        else docs.repartitionByRange(order[0])
    (ranged.sortWithinPartitions(*order)
     .mapInArrow(run, "shard int, segment int, dict_sha256 string, base long, doc_ids array<long>, "
                      "offsets array<long>, n_tokens array<long>, payload binary")
     .write.option("compression", "uncompressed").parquet(f"{folder}/segments"))
    return folder


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    raw = bytes(row["dictionary"])
    if hashlib.sha256(raw).hexdigest() != row["dict_sha256"]:
        raise ValueError("the dictionary does not have the hash that is written beside it")
    return row["dict_sha256"], raw


def _unpack(folder_sha: str, sha: str, raw: bytes):
    if sha != folder_sha:
        raise ValueError("a segment names another dictionary")
    return zstandard.ZstdDecompressor(dict_data=_codec_dict(raw))


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document, in stored order per
    shard; with ``digest`` the unsigned crc32 of the ids (``ids_crc32``) instead."""
    prepare(spark)
    folder_sha, raw = _dictionary(spark, folder)
    shared = spark.sparkContext.broadcast(raw)
    segments = spark.read.parquet(f"{folder}/segments")
    # one number per shard, of which there are as many as write tasks
    sums = segments.select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"),
                                                lambda a, x: a + x).alias("n")) \
        .groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()
    bases, at = {}, 0
    for r in sums:
        bases[r["shard"]] = at
        at += r["n"]

    def run(batches):
        unpack = None
        for batch in batches:
            for seg in range(batch.num_rows):
                row = {c: batch.column(c)[seg] for c in batch.schema.names}
                if unpack is None:
                    unpack = _unpack(folder_sha, row["dict_sha256"].as_py(), shared.value)
                elif row["dict_sha256"].as_py() != folder_sha:
                    raise ValueError("a segment names another dictionary")
                payload = memoryview(row["payload"].as_buffer())
                off = row["offsets"].as_py()
                counts = np.array(row["n_tokens"].as_py(), np.int64)
                start = bases[row["shard"].as_py()] + row["base"].as_py() + np.cumsum(counts) - counts
                ids = [unpack.decompress(payload[a:b], max_output_size=int(c) * 4)
                       if c else b"" for a, b, c in zip(off[:-1], off[1:], counts, strict=True)]
                if any(len(x) != 4 * c for x, c in zip(ids, counts.tolist(), strict=True)):
                    raise ValueError("a document does not have the length in its index")
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"].as_py(), pa.int64()),
                    "start": pa.array(start), "n_tokens": pa.array(counts),
                    **({"ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())} if digest
                       else {"ids": pa.array(ids, pa.binary())})})

    last = "ids_crc32 long" if digest else "ids binary"
    return segments.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> dict[int, list[int]]:
    """The ids of a few documents: their segments are found by the index columns and
    only their own frames are unpacked."""
    folder_sha, raw = _dictionary(spark, folder)
    want = F.array(*[F.lit(int(d)).cast("long") for d in doc_ids])
    rows = (spark.read.parquet(f"{folder}/segments")
            .where(F.arrays_overlap("doc_ids", want))
            .withColumn("d", F.explode(F.arrays_zip(
                "doc_ids", "n_tokens", F.slice("offsets", 1, F.size("doc_ids")).alias("lo"),
                F.slice("offsets", 2, F.size("doc_ids")).alias("hi"))))
            .where(F.array_contains(want, F.col("d.doc_ids")))
            .select("dict_sha256", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_tokens").alias("n"),
                    F.expr("substring(payload, cast(d.lo + 1 as int), cast(d.hi - d.lo as int))")
                    .alias("frame")))
    out = {}
    for r in rows.collect():
        unpack = _unpack(folder_sha, r["dict_sha256"], raw)
        out[r["doc_id"]] = np.frombuffer(
            unpack.decompress(bytes(r["frame"]), max_output_size=4 * r["n"] or 1), "<u4").tolist()
    return out


def fresh_folder(spark: SparkSession) -> str:
    """A new store folder under the shared checkpoint folder."""
    return scratch_path(spark, "token_store")
