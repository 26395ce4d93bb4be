"""Token ids of documents in binary shards, each document compressed on its own.

Texts are dealt to shards by ranges of (id, text hash) and written in that order. A zstandard
dictionary is trained on the serialized id arrays of a bounded sample; with it every document is
a frame of its own, so one short document is read without its neighbours. A shard is

    magic | length of header | header (JSON) | frames | index (Arrow) | place of index | magic

The header names the id width, the end id and the SHA-256 of the dictionary, which lies beside
the shards. The index has a row per document: its id, the frame's place and size, and how many
ids it holds. The manifest lists the shards in order with the ids before each.

The driver sees one row per shard. A shard appears whole under a name that does not depend on
the attempt, so lost tasks simply write it again.

Defined results: a null or empty text is its end id alone. Rows of equal id are ordered by text
hash; null ids come first. The string of an added token in a text is that token, as the library has
it. An empty table writes no shards.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import crc_mod, small_batches, worker_state
from tabulon.llm.shared_files import opened, read_file, write_file
from tabulon.session import scratch_path, stored

MAGIC = b"TOKIDS01"
#: The dictionary is trained on at most this many documents of at most this many characters.
SAMPLE_DOCUMENTS = 2000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Pieces of text whose ids a worker remembers.
CACHE_PIECES = 1_200_000
#: Unknown pieces encoded as one text.
_ROW_PIECES = 1000
_TEXTS = 128

# White space as the pre-tokenizer's pattern has it (the Unicode property).
_WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_OTHER_WHITE = ("\0\t\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
                + "\u2028\u2029\u202f\u205f\u3000")
_RUNS = ("  ", " \n", "\n ", "\n\n")


def pieces(text: str) -> list[str]:
    """The text cut before every run of white space that follows something else.

    The pre-tokenizer never joins what lies on both sides of such a cut, and looks ahead only
    from within a run of white space, so the ids of a text are those of its pieces in a row.
    Where runs are single blanks and line ends, plain splitting gives the same cuts.
    """
    if (text[-1:] in (" ", "\n") or any(r in text for r in _RUNS)
            or any(c in text for c in _OTHER_WHITE)):
        return _PIECE.findall(text)
    return text.replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")


class Encoder:
    """Ids of texts from a tokenizer file, remembering those of pieces seen before."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Bytes of each token, where the vocabulary writes a byte as a character.
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)
        self.code = "H" if self.width.itemsize == 2 else "I"     # little-endian machines only
        # Pieces seen since the last change of generations, and those of the generation before.
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _in_a_row(self, row: list[str]) -> dict[str, bytes]:
        """Ids of pieces encoded as one text; nothing if the tokens' bytes do not show the cuts."""
        text = "".join(row)
        if any(t in text for t in self.added):
            return {}
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                       self.width)
        ends = np.cumsum(self.lengths[ids])
        cuts = np.cumsum([len(p.encode()) for p in row])
        at = np.searchsorted(ends, cuts)
        if not len(ends) or at[-1] >= len(ends) or (ends[at] != cuts).any():
            return {}
        data, size = ids.tobytes(), self.width.itemsize
        stops = ((at + 1) * size).tolist()
        return {p: data[a:b] for p, a, b in zip(row, [0, *stops], stops)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Serialized ids of each text; a few at a time, so that their pieces stay at hand."""
        return [ids for at in range(0, len(texts), _TEXTS)
                for ids in self._encode(texts[at:at + _TEXTS])]

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > CACHE_PIECES // 2:
            self.known, self.older = {"": b""}, self.known
        cuts, whole = [], {}
        for n, text in enumerate(texts):
            if text and any(t in text for t in self.added):     # rare; the library has its rules
                whole[n] = array(self.code, self.tokenizer.encode(
                    text, add_special_tokens=False).ids).tobytes()
                text = None
            cuts.append(pieces(text or ""))
        every = list(chain.from_iterable(cuts))
        ids = list(map(self.known.get, every))
        unknown = [i for i, x in enumerate(ids) if x is None]
        self._learn({every[i] for i in unknown})
        for i in unknown:
            ids[i] = self.known[every[i]]
        stops = list(accumulate(map(len, cuts)))
        return [whole[n] if n in whole else b"".join(ids[a:b])
                for n, (a, b) in enumerate(zip([0, *stops], stops))]

    def _learn(self, unknown: set[str]) -> None:
        """Make the pieces known: from the generation before, or by encoding them."""
        known, older = self.known, self.older
        new = []
        for piece in unknown:
            ids = older.get(piece)
            if ids is None:
                new.append(piece)
            else:
                known[piece] = ids
        # Pieces that white space begins and something else ends may stand in a row.
        rows, rest = [], []
        for p in new:
            (rows if p[0] in " \n\t" and not p[-1].isspace() else rest).append(p)
        for start in range(0, len(rows), _ROW_PIECES):
            row = rows[start:start + _ROW_PIECES]
            found = self._in_a_row(row)
            known.update(found)
            if not found:
                rest += row
        for start in range(0, len(rest), 10_000):
            part = rest[start:start + 10_000]
            for piece, e in zip(part, self.tokenizer.encode_batch_fast(
                    part, add_special_tokens=False)):
                known[piece] = array(self.code, e.ids).tobytes()


def encoder(path: str) -> Encoder:
    return worker_state("encoder " + path, lambda: Encoder(path))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from serialized arrays; too few of them become the dictionary themselves."""
    whole = b"".join(samples)
    if len(whole) >= 8 * DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return whole[-DICTIONARY_BYTES:]


def _codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if len(dictionary) > 8 else {}


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                      text: str = "text", id_column: str = "doc_id") -> dict:
    """Write the shards below ``folder`` and return the manifest, which is written too."""
    spark = docs.sparkSession
    small_batches(spark)
    chosen = (docs.where(f"length({text}) between 1 and {SAMPLE_CHARS}")
              .select(crc_mod(id_column, 1 << 32).alias("_c"), F.col(id_column).alias("_i"))
              .orderBy("_c", "_i").limit(SAMPLE_DOCUMENTS).distinct())

    def sample_ids(iterator) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            yield pa.RecordBatch.from_arrays([pa.array(encoder(tokenizer).encode(
                batch.column(0).to_pylist()), pa.binary())], names=["ids"])

    # The chosen ids are at most SAMPLE_DOCUMENTS rows.
    sample = (docs.join(F.broadcast(chosen), F.col(id_column) == F.col("_i"), "left_semi")
              .where(f"length({text}) between 1 and {SAMPLE_CHARS}").select(text)
              .limit(SAMPLE_DOCUMENTS).mapInArrow(sample_ids, "ids binary"))
    dictionary = train_dictionary([r["ids"] for r in sample.collect()])
    digest = hashlib.sha256(dictionary).hexdigest()
    write_file(f"{folder}/dictionary-{digest[:16]}", dictionary)

    def write(iterator) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.width).tobytes()
        # The size of a text is known before it is compressed, so frames carry it.
        frames = zstandard.ZstdCompressor(level=LEVEL, **_codec(dictionary))
        head = json.dumps({"width": enc.width.itemsize, "end_id": end_id,
                           "dictionary": digest}).encode()
        store, path = opened(f"{folder}/shard-{shard:06d}")
        parent = path.rpartition("/")[0]
        store.create_dir(parent, recursive=True)
        attempt = f"{parent}/.shard-{shard:06d}-{uuid.uuid4().hex}"
        ids, places, sizes, counts = [], [], [], []
        with store.open_output_stream(attempt) as out:
            out.write(MAGIC + len(head).to_bytes(4, "little") + head)
            place = len(MAGIC) + 4 + len(head)
            for batch in iterator:
                ids.append(batch.column(0))
                buffer = []
                for data in enc.encode(batch.column(1).to_pylist()):
                    data += end
                    frame = frames.compress(data)
                    buffer.append(frame)
                    places.append(place)
                    sizes.append(len(frame))
                    counts.append(len(data) // enc.width.itemsize)
                    place += len(frame)
                out.write(b"".join(buffer))
            if ids:
                index = pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(ids), pa.array(places, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                    names=["id", "place", "size", "n_ids"])
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, index.schema) as stream:
                    stream.write_batch(index)
                out.write(sink.getvalue() + place.to_bytes(8, "little") + MAGIC)
        if ids:
            store.move(attempt, path)
        else:
            store.delete_file(attempt)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([len(counts)], pa.int64()),
             pa.array([sum(counts)], pa.int64())], names=["shard", "n_docs", "n_ids"])

    n = max(1, docs.rdd.getNumPartitions())
    ordered = (docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"),
                           F.xxhash64(text).alias("_h"))
               .repartitionByRange(n, "_id", "_h").sortWithinPartitions("_id", "_h")
               .select("_id", "_text"))
    rows = stored(ordered.mapInArrow(write, "shard int, n_docs long, n_ids long"),
                  "shards").where("n_docs > 0").orderBy("shard").collect()
    before, shards = 0, []
    for r in rows:
        shards.append({"file": f"shard-{r['shard']:06d}", "n_docs": r["n_docs"],
                       "n_ids": r["n_ids"], "start": before})
        before += r["n_ids"]
    manifest = {"dictionary": digest, "shards": shards, "n_ids": before}
    write_file(f"{folder}/manifest.json", json.dumps(manifest).encode())
    return manifest


class Shard:
    """Random access to the documents of one shard."""

    def __init__(self, folder: str, file: str) -> None:
        store, path = opened(f"{folder}/{file}")
        self.source = store.open_input_file(path)
        size = self.source.size()
        head = self.source.read_at(len(MAGIC) + 4, 0)
        tail = self.source.read_at(len(MAGIC) + 8, size - len(MAGIC) - 8)
        if head[:len(MAGIC)] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{file} is not a whole shard")
        self.header = json.loads(self.source.read_at(
            int.from_bytes(head[len(MAGIC):], "little"), len(head)))
        at = int.from_bytes(tail[:8], "little")
        raw = self.source.read_at(size - len(tail) - at, at)
        self.index = pa.ipc.open_stream(raw).read_all().combine_chunks()
        digest = self.header["dictionary"]
        dictionary = read_file(f"{folder}/dictionary-{digest[:16]}")
        if hashlib.sha256(dictionary).hexdigest() != digest:
            raise ValueError(f"the dictionary beside {file} is not the one it was written with")
        self.width = np.dtype(f"<u{self.header['width']}")
        self.frames = zstandard.ZstdDecompressor(**_codec(dictionary))

    def documents(self, rows_at_once: int = 1000) -> Iterator[tuple[int, np.ndarray]]:
        """(row of the index, ids) of all documents, read in few requests."""
        places, sizes = (self.index.column(c).to_numpy() for c in ("place", "size"))
        for low in range(0, len(places), rows_at_once):
            high = min(low + rows_at_once, len(places))
            first = int(places[low])
            data = self.source.read_at(int(places[high - 1] + sizes[high - 1]) - first, first)
            for i in range(low, high):
                at = int(places[i]) - first
                yield i, np.frombuffer(self.frames.decompress(
                    data[at:at + int(sizes[i])]), self.width)

    def document(self, row: int) -> np.ndarray:
        """Ids of one document, reading nothing else."""
        place, size = (self.index.column(c)[row].as_py() for c in ("place", "size"))
        return np.frombuffer(self.frames.decompress(self.source.read_at(size, place)), self.width)


def read_token_files(spark: SparkSession, folder: str, id_type: str = "bigint",
                     id_column: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document: id, start, n_tokens, ids_crc32 and, if asked for, the ids themselves."""
    shards = json.loads(read_file(f"{folder}/manifest.json"))["shards"]

    def read(iterator) -> Iterator[pa.RecordBatch]:
        for batch in iterator:
            for file, before in zip(*(c.to_pylist() for c in batch.columns)):
                shard = Shard(folder, file)
                ids = shard.index.column("id").combine_chunks()
                low, counts, crcs, arrays = 0, [], [], []

                def flush(high: int) -> pa.RecordBatch:
                    starts = before + np.cumsum([0, *counts[:-1]])
                    columns = [ids.slice(low, high - low), pa.array(starts, pa.int64()),
                               pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]
                    if with_ids:
                        columns.append(pa.array(arrays, pa.list_(pa.int64())))
                    return pa.RecordBatch.from_arrays(columns, names=names)

                for i, document in shard.documents():
                    counts.append(len(document))
                    crcs.append(zlib.crc32(document.astype("<u4").tobytes()))
                    if with_ids:
                        arrays.append(document.astype(np.int64))
                    if len(counts) == 1000:
                        yield flush(i + 1)
                        before += sum(counts)
                        low, counts, crcs, arrays = i + 1, [], [], []
                if counts:
                    yield flush(low + len(counts))

    names = [id_column, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = (f"`{id_column}` {id_type}, start long, n_tokens long, ids_crc32 long"
              + ", ids array<long>" * with_ids)
    listed = spark.createDataFrame([(s["file"], s["start"]) for s in shards],
                                   "file string, start long")
    return listed.repartition(max(1, len(shards))).mapInArrow(read, schema)


def round_trip(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text"
               ) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and read the digests back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_token_files(docs, folder, tokenizer, text=text, id_column=id_column)
    return read_token_files(spark, folder, dict(docs.dtypes)[id_column], id_column)
