"""Token ids as files: frequency-ranked ids, variable-length bytes, control bytes apart.

Format. A folder with two Parquet tables. ``ranks`` (rank, id, count): the vocabulary in use, most frequent id first. ``blocks`` (part, block,
doc_ids, lengths, control, data): documents in ascending id order, blocks in order of (part, block). An id is written as its rank, in
1 to 4 little-endian bytes in ``data``; ``control`` holds the byte counts less one, two bits each, four ids to a byte, lowest bits
first. Half of all ids thus take a byte, and a block is decoded without branches: a table gives for each control byte which of 16 bytes are
present. Parquet holds the bytes because Spark's commit protocol then covers lost and repeated tasks on any store.

Texts are tokenized once. Pieces between ASCII white space never influence each other in the vocabulary used, so distinct pieces are
encoded by the library in bulk and kept in a bounded cache; ids of a text are then gathered with numpy. The vocabulary used also parts a Latin
letter or digit from the ASCII signs that follow it, so such signs at a piece's end are a piece of their own, and pieces of Latin letters only are words,
each of which ends with an id of its own kind: these are encoded in one text with spaces. Counting, ranking and writing read the ids back from a table in the shared folder.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, keep_until_exit, materialize, release, shared_dir, slices, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 18
CACHED_BYTES = 48 << 20  # of a worker's cached pieces and their ids
#: What a vocabulary must do for pieces to be parted further: its steps before the merges, and the mark at the end of words.
PARTING = {
    "normalizer": ["NFC", r"\s+", "Lowercase"], "pre_tokenizer": [r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", "ByteLevel"], "end_of_word_suffix": "</w>",
}
LATIN = "a-zA-ZÀ-ÖØ-öø-įı-ɏ"  # letters for every reader of Unicode; İ becomes two characters in lower case
WORDS = f"^[{LATIN}]+$"
SIGNED = f"([0-9{LATIN}])[!-&(-/:-@\\[-`{{-~]+$"  # without the apostrophe, which can begin an ending
SIGNS = f"(?s)^.*[0-9{LATIN}]"
#: Which of the 4 x 4 bytes of a group of four ids are present, for each control byte.
PRESENT = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)[:, :, None] >= np.arange(4)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit numbers."""
    v = ranks.astype("<u4")
    codes = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    four[: len(v)] = codes
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    present = PRESENT[np.frombuffer(control, dtype=np.uint8)].reshape(-1, 4)[:n]
    out = np.zeros((n, 4), dtype=np.uint8)
    out[present] = np.frombuffer(data, dtype=np.uint8)
    return out.view("<u4").ravel()


def _parting(vocabulary: dict) -> bool:
    steps = {k: [x.get("pattern", {}).get("Regex", x["type"]) for x in (vocabulary[k] or {}).get(f"{k}s".replace("_", ""), [])] for k in ("normalizer", "pre_tokenizer")}
    return steps | {"end_of_word_suffix": vocabulary["model"].get("end_of_word_suffix")} == PARTING


def _gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of ``flat`` one after the other, and where each ends."""
    n = counts[which]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[which] - ends + n, n) + np.arange(ends[-1] if len(n) else 0)], ends


class PieceEncoder:
    """Ids of many texts through a cache of pieces between white space.

    Between slices the cache is emptied once it holds over ``CACHED_BYTES``, whatever the length of its pieces; inside, it grows by what one slice adds.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.mark_id = (next(((t.content, i) for i, t in sorted(special.items(), reverse=True)), ("", -1))) if special else ("", -1)
        self.opening = self.mark[:2]
        self.size = self.tokenizer.get_vocab_size()
        self.parts = _parting(json.loads(self.tokenizer.to_str()))
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for x, i in vocabulary.items() if x.endswith(PARTING["end_of_word_suffix"])]] = True
        self.clear()

    def clear(self):
        self.known = pa.array([], pa.string())  # pieces; starts and counts of their ids in flat stand at the same places
        self.starts = self.counts = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _add(self, pieces: pa.Array) -> np.ndarray:
        """Encodes new pieces; their places among the known ones."""
        words = pc.match_substring_regex(pieces, WORDS) if self.parts else pa.array(np.zeros(len(pieces), bool))
        # a special token that no piece holds keeps pieces apart in one long text, which the library encodes faster than each alone
        odd = pc.and_not(pc.match_substring(pieces, self.opening) if self.mark else pa.array(np.ones(len(pieces), bool)), words)
        kinds = np.where(words, 0, np.where(odd, 2, 1))
        order = np.argsort(kinds, kind="stable")
        told = pieces.take(pa.array(order))
        some = told.to_pylist()
        n_words, n_plain = np.count_nonzero(kinds == 0), np.count_nonzero(kinds == 1)
        groups = [some[i : min(i + 128, until)] for start, until in ((0, n_words), (n_words, n_words + n_plain)) for i in range(start, until, 128)]
        joined = [(" " if k * 128 < n_words else self.mark).join(g) for k, g in enumerate(groups)]
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        done = 0
        for e, g in zip(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), groups, strict=True):
            x = np.array(e.ids, dtype=np.uint32)
            if done < n_words:
                counts.append(np.diff(np.flatnonzero(self.last[x]), prepend=-1))
            else:
                counts.append(np.diff(np.concatenate([[-1], np.flatnonzero(x == self.mark_id), [len(x)]])) - 1)
                x = x[x != self.mark_id]
            ids.append(x)
            assert len(counts[-1]) == len(g)
            done += len(g)
        for e in self.tokenizer.encode_batch_fast(some[done:], add_special_tokens=False):
            ids.append(np.array(e.ids, dtype=np.uint32))
            counts.append(np.array([len(e.ids)]))
        n = np.concatenate(counts)
        places = np.empty(len(order), np.int64)
        places[order] = len(self.known) + np.arange(len(order))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(n) - n])
        self.counts = np.concatenate([self.counts, n])
        self.flat = np.concatenate([self.flat, *ids])
        self.known = pa.concat_arrays([self.known, told])
        return places

    def _parted(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces without the signs at their end, then those signs; and which pieces have some."""
        stems = pc.replace_substring_regex(pieces, SIGNED, r"\1")
        signed = pc.not_equal(pc.binary_length(stems), pc.binary_length(pieces))
        if self.mark:
            signed = pc.and_not(signed, pc.match_substring(pieces, self.opening))
        return pa.concat_arrays([pc.if_else(signed, stems, pieces), pc.replace_substring_regex(pieces.filter(signed), SIGNS, "")]), signed.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text); a null text has none."""
        held = self.known.nbytes + self.starts.nbytes + self.counts.nbytes + self.flat.nbytes
        if held > CACHED_BYTES or held + texts.nbytes >= 1 << 31:  # places of characters in an array are 32-bit numbers
            self.clear()
        texts = pc.fill_null(texts, "")
        if not self.mark or not pc.any(pc.match_substring(texts, self.opening)).as_py():
            texts = pc.ascii_lower(texts) if self._lowers() else texts
        pieces = pc.ascii_split_whitespace(texts)
        coded = pieces.values.dictionary_encode()
        some = coded.dictionary
        parts, signed = self._parted(some) if self.parts else (some, np.zeros(len(some), bool))
        parted = parts.dictionary_encode()
        found = pc.index_in(parted.dictionary, value_set=self.known)
        place = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if found.null_count:
            place[place < 0] = self._add(parted.dictionary.filter(pc.is_null(found)))
        at = place[parted.indices.to_numpy()]
        # the ids of each piece: of its stem, then of its signs
        flat, _ = _gathered(self.flat, self.starts, self.counts, np.insert(at[: len(some)], np.flatnonzero(signed) + 1, at[len(some) :]))
        counts = self.counts[at[: len(some)]]
        counts[signed] += self.counts[at[len(some) :]]
        ids, ends = _gathered(flat, np.cumsum(counts) - counts, counts, coded.indices.to_numpy())
        upto = np.concatenate([[0], ends])[pieces.offsets.to_numpy()]
        return ids, np.diff(upto)

    def _lowers(self) -> bool:
        """Whether the vocabulary lower-cases by itself, so that lower-casing first changes nothing but the number of pieces."""
        if not hasattr(self, "lowers"):
            one = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
            self.lowers = one("QWERTY Uiop ASDF") == one("qwerty uiop asdf")
        return self.lowers


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(vocabulary: str) -> PieceEncoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = PieceEncoder(vocabulary)
    return _ENCODERS[vocabulary]



def _tokenized(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, block = encoder(vocabulary), TaskContext.get().partitionId(), 0
        kind = "<u2" if max(enc.size, end_id + 1) <= 1 << 16 else "<u4"
        docs, lengths, held = [], [], []
        kinds: list[pa.DataType] = []  # of the ids

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([docs], pa.list_(kinds[0])), pa.array([lengths], pa.list_(pa.int64())), pa.array([np.concatenate(held).tobytes()], pa.binary())],
                names=["part", "block", "doc_ids", "lengths", "ids"],
            )

        total = 0
        for b in slices(batches, "text"):
            kinds[:] = [b.column(0).type]
            ids, counts = enc.encode(b.column(1))
            ends = np.cumsum(counts)
            all_ids = np.insert(ids, ends, end_id).astype(kind)
            sizes = counts + 1
            stops = np.cumsum(sizes)
            ids_of = b.column(0).to_pylist()
            at = done = 0
            for i in range(len(sizes)):
                if total and total + (stops[i] - done) > BLOCK_IDS:
                    if i > at:
                        held.append(all_ids[done : stops[i - 1]])
                        docs += ids_of[at:i]
                        lengths += sizes[at:i].tolist()
                        at, done = i, stops[i - 1]
                    yield out()
                    block, total, docs, lengths, held = block + 1, 0, [], [], []
                if i + 1 == len(sizes) or total + (stops[i] - done) >= BLOCK_IDS:
                    held.append(all_ids[done : stops[i]])
                    docs += ids_of[at : i + 1]
                    lengths += sizes[at : i + 1].tolist()
                    total += int(stops[i] - done)
                    at, done = i + 1, stops[i]
        if docs:
            yield out()

    return run


def _counted(width: int):
    def run(batches):
        sums = np.zeros(0, dtype=np.int64)
        for b in batches:
            for x in b.column(0):
                got = np.bincount(np.frombuffer(x.as_py(), dtype=f"<u{width}"))
                if len(got) > len(sums):
                    got, sums = sums, got
                sums[: len(got)] += got
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(sums[used])], names=["id", "n"])

    return run


def _encoded(rank_of: np.ndarray, width: int):
    def run(batches):
        for b in batches:
            got = [encode_ranks(rank_of[np.frombuffer(x.as_py(), dtype=f"<u{width}")]) for x in b.column(4)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([x for x, _ in got], pa.binary()), pa.array([x for _, x in got], pa.binary())], names=["part", "block", "doc_ids", "lengths", "control", "data"])

    return run


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> str:
    """Writes the ids of every text of ``docs`` (doc_id, text used) with ``end_id`` after each, in ascending order of doc_id, to ``path``.

    Null and empty texts have only the end id; null ids come first; rows that agree in doc_id are in order of text, so that reruns give the
    same files; an empty table gives empty tables; other columns are ignored. The ranks are bounded by the vocabulary.
    """
    spark = docs.sparkSession
    width = 2 if max(encoder(vocabulary).size, end_id + 1) <= 1 << 16 else 4
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    head = f"part int, block int, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>, lengths array<long>"
    tokens = materialize(arrow(ordered, _tokenized(vocabulary, end_id), f"{head}, ids binary"), "token-ids")
    counts = arrow(tokens.select("ids"), _counted(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.collect()  # at most one row for each id of the vocabulary
    ranked = sorted(((r.id, r.n) for r in found), key=lambda x: (-x[1], x[0]))
    spark.createDataFrame([(k, i, n) for k, (i, n) in enumerate(ranked)], "rank long, id long, count long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max([i for i, _ in ranked], default=0) + 1, dtype=np.uint32)
    rank_of[[i for i, _ in ranked]] = np.arange(len(ranked), dtype=np.uint32)
    arrow(tokens, _encoded(rank_of, width), f"{head}, control binary, data binary").write.option("compression", "none").parquet(f"{path}/blocks")
    release(tokens)
    return path


def _decoded(id_of: np.ndarray, with_ids: bool):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                lengths = np.array(b.column(3)[k].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                ids = id_of[decode_ranks(b.column(4)[k].as_py(), b.column(5)[k].as_py(), int(ends[-1]))]
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                n = len(lengths)
                cols = [pa.array([b.column(0)[k].as_py()] * n, pa.int32()), pa.array([b.column(1)[k].as_py()] * n, pa.int32()), b.column(2)[k].values, pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())]
                names = ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def read_ids(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Reads files of ``write_ids``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and the ids if asked for.

    A row for each document that was written, null ids and repeated rows included; files of an empty table give no rows; a very long
    document is one row, decoded with its block.
    """
    ranks = spark.read.schema("rank long, id long, count long").parquet(f"{path}/ranks").collect()  # bounded by the vocabulary
    id_of = np.zeros(len(ranks), dtype=np.uint32)
    for r in ranks:
        id_of[r.rank] = r.id
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = blocks.select("part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each task of the writer
    earlier = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(earlier, "part").select("part", "block", (F.col("before") + F.col("earlier")).alias("offset"))
    extra = ", ids array<long>" if with_ids else ""
    docs = arrow(blocks, _decoded(id_of, with_ids), f"part int, block int, doc_id {kind}, inside long, n_tokens long, ids_crc32 long{extra}")
    return docs.join(offsets, ["part", "block"]).select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_and_read(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``write_ids`` to a new folder of the shared place, kept until the driver ends, then ``read_ids``; nulls, ties and empty tables as there."""
    spark = docs.sparkSession
    path = write_ids(docs, f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}", vocabulary or vocabulary_path(), end_id)
    keep_until_exit(spark, path)
    return read_ids(spark, path)


def op3_token_ids(spark, sf_dir):
    return encode_and_read(table(spark, sf_dir, "documents"))
