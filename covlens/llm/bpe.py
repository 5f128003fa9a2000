"""Byte-level BPE encoding and decoding with a published vocabulary.

A short word is held as a contiguous list of part ids and a parallel list of the merge ranks of adjacent parts.  The
smallest rank is found by scanning, its boundary is deleted, and the ranks on both sides are refreshed, until no
adjacent pair merges.  Words of more than `SHORT` bytes, where scanning would be quadratic, keep the same part list
as a linked list with a heap of ranks; both give the same ids.

The vocabulary (a JSON of `vocab` and `merges`, about 1.5 MB, checked against `MAX_VOCAB_BYTES`) is read on the driver
from a path given as a parameter and broadcast.  Texts stay in their partition: no shuffle.

Defined results: null text encodes like the empty text, to no ids; special tokens' strings in a text become their ids;
ids that are not in the vocabulary are an error on decoding; bytes that are not UTF-8 decode to U+FFFD.  Repeated
rows are encoded alike; an empty table gives an empty table; all other columns pass through or are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from covlens.llm.batches import bounded, slices

MAX_VOCAB_BYTES = 64 << 20
SHORT = 128
CACHED_WORDS = 400_000
CACHED_LENGTH = 64
_NONE = 1 << 60

#: The pattern that splits a text into words, as the byte-level vocabulary defines it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters and numbers assigned after Unicode 16, which the vocabulary's splitter treats as neither.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)

# Texts of ASCII and European letters only split with `re`, three times as fast and equal there; all others with
# the full Unicode pattern, and with the reduced classes where a text holds one of the later characters.
_BEYOND = re.compile("[^\x00-\x7e\xc0-ɏ‐-‧€]")
_LETTERS, _SPACES = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ", " \t-\r"
_EUROPEAN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_SPACES}{_LETTERS}0-9]+"
                       rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
_UNICODE = regex.compile(PATTERN)
_LATER_CLASS = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in LATER)
_HAS_LATER = regex.compile(f"[{_LATER_CLASS}]")
_L, _N = f"[\\p{{L}}--[{_LATER_CLASS}]]", f"[\\p{{N}}--[{_LATER_CLASS}]]"
_REDUCED = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{_L}+| ?{_N}+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+", regex.V1)


def split_words(text: str) -> list[str]:
    if not _BEYOND.search(text):
        return _EUROPEAN.findall(text)
    return (_REDUCED if _HAS_LATER.search(text) else _UNICODE).findall(text)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: printable Latin-1 bytes stand for
    themselves, the others in order for the characters from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file's text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: bytes([b]) for b, c in enumerate(letters)}
        self.first = [vocab[c] for c in letters]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.token_bytes = {i: b"".join(map(byte_of.__getitem__, t)) for t, i in vocab.items()}
        self.token_bytes.update({i: t.encode() for t, i in self.special.items()})
        self.token_text = {i: str(i) for i in self.token_bytes}
        self.split_special = (re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
                                         + ")") if self.special else None)
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word."""
        ids = [self.first[b] for b in word]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        merges = self.merges
        none = (_NONE, -1)
        steps = [merges.get(pair, none) for pair in zip(ids, ids[1:])]
        ranks = [s[0] for s in steps]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            ids[i] = merges[ids[i], ids[i + 1]][1]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = merges.get((ids[i - 1], ids[i]), none)[0]
            if i < len(ranks):
                ranks[i] = merges.get((ids[i], ids[i + 1]), none)[0]
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m[0], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (m := merges.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:  # a part has changed since
                continue
            ids[i], ids[j] = merges[a, b][1], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get((ids[i], ids[k])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], ids[i]))):
                heapq.heappush(heap, (m[0], h, ids[h], ids[i]))
        return tuple(x for x in ids if x >= 0)

    def encode(self, text: str) -> list[int]:
        parts = self.split_special.split(text) if self.split_special else [text]
        out, cache = [], self.cache
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
                continue
            for word in split_words(part):
                ids = cache.get(word)
                if ids is None:
                    ids = self.merge(word.encode())
                    if len(word) <= CACHED_LENGTH:
                        if len(cache) >= CACHED_WORDS:
                            cache.clear()
                        cache[word] = ids
                out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def ids_text(self, ids: Iterable[int]) -> str:
        return ",".join(map(self.token_text.__getitem__, ids))


_CODECS: dict[str, Codec] = {}  # one per Python worker and vocabulary


def _codec(source: str) -> Codec:
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(source)
    return _CODECS[key]


def _ship(df: DataFrame, vocab_path: str):
    with open(vocab_path, encoding="utf-8") as f:
        source = f.read(MAX_VOCAB_BYTES + 1)
    if len(source) > MAX_VOCAB_BYTES:
        raise ValueError(f"the vocabulary is larger than {MAX_VOCAB_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(source)


def encode(df: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """`key`, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the text decoded from the
    ids again) and, if asked for, the ids themselves, for each row of `df`."""
    bounded(df.sparkSession)
    shipped = _ship(df, vocab_path)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                n, digest, decoded, ids_out = [], [], [], []
                for t in part.column("_text").to_pylist():
                    ids = codec.encode(t or "")
                    n.append(len(ids))
                    digest.append(hashlib.sha256(codec.ids_text(ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                    if with_ids:
                        ids_out.append(pa.array(ids, pa.int32()))
                cols = [part.column("_key"), pa.array(n, pa.int64()), pa.array(digest, pa.string()),
                        pa.array(decoded, pa.string())]
                names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    offsets = pa.array([0, *(x for x in _running(n))], pa.int32())
                    flat = pa.concat_arrays(ids_out) if ids_out else pa.array([], pa.int32())
                    cols.append(pa.ListArray.from_arrays(offsets, flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return df.select(df[key].alias("_key"), df[text].alias("_text")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))


def _running(counts: list[int]) -> Iterator[int]:
    total = 0
    for c in counts:
        total += c
        yield total


def decode(df: DataFrame, vocab_path: str, ids: str = "ids", key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and the text that `ids` decode to; null ids decode to null."""
    shipped = _ship(df, vocab_path)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value)
        for batch in batches:
            texts = [None if x is None else codec.decode(x) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(texts, pa.string())], [key, text])

    return df.select(df[key].alias("_key"), df[ids].alias("_ids")).mapInArrow(run, f"`{key}` {kind}, `{text}` string")
