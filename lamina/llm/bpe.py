"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

A text is cut into the matches of the vocabulary's pattern and each match is encoded on its own.
The cut runs on the bytes of a whole batch at once where a text has Latin letters and ASCII signs
only, and through a regular expression elsewhere; both give the same pieces. Equal pieces of a batch
are encoded once, and a worker remembers a bounded number of pieces.

Null and empty texts have no tokens. Texts of any length are encoded whole. Rows are independent, so
ties, repeated rows and extra columns don't matter; input columns other than those named are dropped
unless listed in `keep`, which refuses the names of the results. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm import _common as C

DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces in each of a worker's two generations of remembered pieces; the older one is dropped when
#: the newer is full. Bounds the worker's memory, not what is encoded.
REMEMBERED = 80_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@functools.lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    return Coder(path)


class Coder:
    """Encodes and decodes by a rank file. One for each worker and file."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @functools.cached_property
    def tokenizer(self):
        """Built for encoding only: workers that decode do without."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, shown = self.ranks, byte_characters()
        spell = lambda token: "".join(shown[b] for b in token)
        # ranks decide by the merged token alone, so every split of it into two tokens is a merge
        merges = [(spell(t[:i]), spell(t[i:])) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        made = Tokenizer(models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0))
        made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return made

    @functools.cached_property
    def pattern(self):
        import public_tokenizers

        # \s in the rank file's library is the White_Space property
        return regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and how many each has."""
        if len(self.newer) > REMEMBERED:
            self.older, self.newer = self.newer, {}
        newer, older = self.newer, self.older
        own = [newer.get(p) or older.get(p) for p in pieces]
        missing = [i for i, ids in enumerate(own) if ids is None]
        for i, found in zip(missing, self.tokenizer.encode_batch_fast([pieces[i].decode() for i in missing], add_special_tokens=False), strict=True):
            own[i] = np.array(found.ids, np.int32).tobytes()
        newer.update(zip(pieces, own, strict=True))
        return np.frombuffer(b"".join(own), np.int32), np.fromiter(map(len, own), np.int64, len(own)) // 4

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and n + 1 offsets into them, for texts given as bytes and n + 1 offsets."""
        cuts = self.cut(data, ends)
        if not len(cuts):
            return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
        offsets = np.append(cuts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        ids, counts = self.encode_pieces(pieces.dictionary.to_pylist())
        which = pieces.indices.to_numpy()
        starts, own = (np.cumsum(counts) - counts)[which], counts[which]
        total = np.append(0, np.cumsum(own))
        return C.gather(ids, starts, own), total[np.searchsorted(cuts, ends)]

    def cut(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each piece begins."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64)
        sort = _SORT[data]
        wide = np.flatnonzero(data == 0xC3)
        signs = wide[np.isin(data[np.minimum(wide + 1, n - 1)], (0x97, 0xB7))]
        sort[signs] = sort[signs + 1] = _OTHER
        begins = ends[:-1][np.diff(ends) > 0]
        first = np.zeros(n, bool)
        first[begins] = True
        start = np.empty(n, bool)
        start[0] = True
        np.not_equal(sort[1:], sort[:-1], out=start[1:])
        start |= first
        # the last white space before a sign of the same text stands alone, or leads it if a space
        space = sort == _SPACE
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:])
        start[last] = True
        start[last[data[last] == 32] + 1] = False
        # a lone apostrophe takes the letters of a contraction
        marks = np.flatnonzero((data == 39) & start)
        padded = np.concatenate([data, np.zeros(4, np.uint8)])
        inside = np.concatenate([~first, np.zeros(4, bool)])
        for letters in (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll"):
            k = len(letters)
            hit = np.ones(len(marks), bool)
            for j, b in enumerate(letters, 1):
                hit &= (padded[marks + j] == b) & inside[marks + j]
            at = marks[hit]
            start[at + 1] = False
            after = at + k + 1
            start[after[after < n]] = True
        # texts with other letters
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(sort == _ODD), "right") - 1)
        for text in odd:
            a, b = ends[text], ends[text + 1]
            start[a:b] = False
            found = self.pattern.findall(data[a:b].tobytes().decode())
            sizes = np.fromiter((len(p.encode()) for p in found), np.int64, len(found))
            start[a + np.cumsum(sizes) - sizes] = True
        return np.flatnonzero(start)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and n + 1 offsets into them."""
        lengths = self.lengths[ids]
        total = np.append(0, np.cumsum(lengths))
        return C.gather(self.bytes, self.starts[ids], lengths), total[ends]

    def spans(self, data: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of the characters that each token touches, over the whole batch.
        Tokens that share a split character both touch it."""
        character = np.append(np.cumsum((data & 0xC0) != 0x80), 0)  # of each byte, from 1
        ends = np.cumsum(self.lengths[ids])
        return character[ends - self.lengths[ids]] - 1, character[ends - 1]


_LETTER, _DIGIT, _SPACE, _OTHER, _ODD = range(5)
_SORT = np.full(256, _ODD, np.uint8)
_SORT[:128] = _OTHER
_SORT[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_SORT[48:58] = _DIGIT
_SORT[[9, 10, 11, 12, 13, 32]] = _SPACE


def encode(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), offsets: bool = False, vocabulary: str | None = None, decoded: bool = False) -> DataFrame:
    """The columns of `keep` and ids array<int>; with offsets also starts and ends array<int>, the
    characters (code points) that each token touches, end exclusive; with decoded also decoded
    binary, what the ids give by decode(), made in the same pass."""
    C.prepare(df.sparkSession)
    path = vocabulary or default_vocabulary()
    kept = C.kept(df, keep, "ids", "starts", "ends", "decoded")
    ints = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*kept, T.StructField("ids", ints)] + [T.StructField(c, ints) for c in ("starts", "ends") if offsets] + [T.StructField("decoded", T.BinaryType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in C.slices(batches):
            data, ends = C.flat(batch.column(batch.num_columns - 1))
            ids, at = own.encode(data, ends)
            columns = [*batch.columns[:-1], C.lists(ids, at)]
            if offsets and len(ids):
                a, b = own.spans(data, ids)
                before = np.repeat(np.append(0, np.cumsum((data & 0xC0) != 0x80))[ends[:-1]], np.diff(at))
                columns += [C.lists((a - before).astype(np.int32), at), C.lists((b - before).astype(np.int32), at)]
            elif offsets:
                columns += [C.lists(ids, at)] * 2
            if decoded:
                columns.append(_binary(*own.decode(ids, at)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), vocabulary: str | None = None) -> DataFrame:
    """The columns of `keep` and decoded, the bytes that the ids stand for. Tokens may split a
    character: only whole sequences need be UTF-8. Null ids decode to no bytes; an id outside the
    vocabulary is an error."""
    C.prepare(df.sparkSession)
    path = vocabulary or default_vocabulary()
    schema = T.StructType([*C.kept(df, keep, "decoded"), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in C.slices(batches):
            column = batch.column(batch.num_columns - 1)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            if len(values) and not (0 <= values.min() and values.max() < len(own.lengths)):
                raise ValueError("an id is outside the vocabulary")
            made = _binary(*own.decode(values, np.append(0, np.cumsum(counts))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=schema.names)

    return df.select(*keep, F.col(ids).alias("__ids")).mapInArrow(run, schema)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every text; the counts and digests of both."""
    both = encode(df, text, (key,), decoded=True)
    return both.select(key, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(C.table(spark, sf_dir, "documents"))
