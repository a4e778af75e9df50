"""Packing of documents into token sequences by sum-of-squares online placement.

A document is cut at every full sequence. What is left over goes, as it comes, into the partly filled
window whose new fill level makes the sum of the squared counts of windows per level smallest, or into
a new window where that is smaller. The counts are kept in an array by level. When a task ends, and
whenever too many windows are open, the emptiest windows are cut up to fill the fullest ones, so that
at most one window of a task stays partly filled.

Every task packs the rows that it reads, in their order, and shuffles nothing. A retried task gives the
same pieces if it reads the same rows in the same order, as a scan of files does.
"""

from __future__ import annotations

import json
import operator
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.words import slices

SEQUENCE_TOKENS = 4096
OPEN_WINDOWS = 1024
#: Words whose ids a Python worker remembers, twice over, and the longest of them in bytes.
CACHED_WORDS, CACHED_BYTES = 500_000, 64
JOINED_WORDS = 2000
#: Runs of marks whose ids a worker remembers.
CACHED_MARKS = 4096
ID_BYTES = 4
#: ASCII letters and those from U+00C0 to U+017F that have one lower-case letter, then ASCII marks, in UTF-8. None of
#: these letters changes under NFC.
_LETTERS_AND_MARKS = re.compile(
    rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\x88\x8a-\xbe])++)"
    rb"([!-/:-@\[-`{-~]*+)")
#: The characters that byte-level tokenizers write for the bytes of letters: Latin-1's own, or one from U+0100 on.
_BYTE_CHARACTERS = {byte: 0xA2 + byte for byte in range(0x7F, 0xA1)} | {0xAD: 0x143}

_tokenizers: dict[str, WordIds] = {}


class WordIds:
    """Token ids of texts, looked up by white-space separated parts.

    Neither the normaliser nor the pre-tokeniser of a tokenizer that drops white space looks across
    it, so the ids of a text are those of its parts, and a part seen before needs no second look. A part of
    Latin letters, with or without marks behind it, is one word to the tokenizer and goes to its
    model directly, lower-cased; everything else takes the tokenizer's whole way. Texts of a tokenizer that is built otherwise
    are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._by_parts = _drops_white_space(json.loads(self._tokenizer.to_str()))
        ids = range(1 + max(self._tokenizer.get_vocab().values(), default=-1))
        self._id_bytes = [number.to_bytes(ID_BYTES, "little") for number in ids]
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._marks: dict[bytes, bytes] = {}

    def _word(self, letters: bytes) -> bytes:
        if letters.isascii():
            word = letters.lower().decode()
        else:
            word = letters.decode().lower().encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        id_bytes = self._id_bytes
        return b"".join([id_bytes[token.id] for token in self._model.tokenize(word)])

    def _behind(self, marks: bytes) -> bytes:
        ids = self._marks.get(marks)
        if ids is None:
            ids = self._whole_way([marks])[marks]
            if len(self._marks) < CACHED_MARKS and len(marks) <= CACHED_BYTES:
                self._marks[marks] = ids
        return ids

    def _whole_way(self, parts: list[bytes]) -> dict[bytes, bytes]:
        found = {}
        for i in range(0, len(parts), JOINED_WORDS):
            some = parts[i: i + JOINED_WORDS]
            texts = [part.decode() for part in some]
            starts = np.cumsum([0] + [len(text) + 1 for text in texts])
            encoded = self._tokenizer.encode(" ".join(texts), add_special_tokens=False)
            at = np.array([offset[0] for offset in encoded.offsets], np.int64)
            cuts = np.searchsorted(at, starts) * ID_BYTES
            raw = np.array(encoded.ids, "<u4").tobytes()
            found.update((part, raw[cuts[k]: cuts[k + 1]]) for k, part in enumerate(some))
        return found

    def _encode(self, parts: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of parts that are not known, which are then known if they are short."""
        found, others = {}, []
        known, older = self._known, self._older
        for part in parts:
            ids = older.get(part)
            if ids is None:
                if part.isalpha():
                    ids = self._word(part)
                elif plain := _LETTERS_AND_MARKS.fullmatch(part):
                    letters, marks = plain.groups()
                    ids = known.get(letters) or older.get(letters) or self._word(letters)
                    if marks:
                        ids += self._behind(marks)
                else:
                    others.append(part)
                    continue
            found[part] = ids
            if len(part) <= CACHED_BYTES:
                known[part] = ids
        if others:
            found |= (ids_of_others := self._whole_way(others))
            known.update((part, ids) for part, ids in ids_of_others.items() if len(part) <= CACHED_BYTES)
        return found

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self._by_parts:
            for text in texts:
                ids = self._tokenizer.encode(text.decode(), add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes()
            return
        split = [text.split() for text in texts]
        found = [list(map(self._known.get, parts)) for parts in split]
        places = [list(compress(range(len(ids)), map(operator.is_, ids, repeat(None)))) for ids in found]
        new = {parts[k] for parts, unknown in zip(split, places) for k in unknown}
        if len(self._known) + len(new) > CACHED_WORDS:
            self._older, self._known = self._known, {}
        fresh = self._encode(new)
        for parts, ids, unknown in zip(split, found, places):
            for k in unknown:
                ids[k] = fresh[parts[k]]
            yield b"".join(ids)


def _drops_white_space(parts: dict) -> bool:
    """Whether a tokenizer lower-cases texts and cuts them into runs of letters, single digits and marks, without
    the white space between them, by its own normaliser and pre-tokeniser."""
    steps = (parts["normalizer"] or {}).get("normalizers", [])
    cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and cuts[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
    )


def word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Packer:
    """Windows of one task. A piece is (document, its tokens, start, ids); ids are packed bytes."""

    def __init__(self, length: int, open_windows: int, first_sequence: int):
        self.length, self.open_windows = length, open_windows
        self.counts = np.zeros(length + 1, np.int64)
        self.windows: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0
        self.sequence = first_sequence
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for document, tokens, start, ids in pieces:
            self.done.append((document, tokens, start, ids, self.sequence, offset))
            offset += len(ids) // ID_BYTES
        self.sequence += 1

    def level_for(self, size: int) -> int:
        """The level whose window takes a piece of ``size``; 0 opens a new window."""
        counts = self.counts
        levels = np.flatnonzero(counts[1: self.length - size + 1]) + 1
        after = counts[levels + size]
        change = np.where(levels + size < self.length, 2 * after + 1, 0) - (2 * counts[levels] - 1)
        best, least = 0, 2 * counts[size] + 1
        if len(levels):
            k = len(levels) - 1 - int(np.argmin(change[::-1]))  # of equal ones the fullest
            if change[k] <= least:
                best = int(levels[k])
        return best

    def _put(self, level: int, pieces: list) -> None:
        if level == self.length:
            self._close(pieces)
        else:
            self.windows[level].append(pieces)
            self.counts[level] += 1
            self.n_open += 1

    def _take(self, level: int) -> list:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.windows[level].pop()

    def add(self, document, ids: bytes) -> None:
        tokens = len(ids) // ID_BYTES
        whole = tokens - tokens % self.length
        for start in range(0, whole, self.length):
            cut = ids[start * ID_BYTES: (start + self.length) * ID_BYTES]
            self._close([(document, tokens, start, cut)])
        if whole < tokens:
            level = self.level_for(tokens - whole)
            pieces = self._take(level) if level else []
            pieces.append((document, tokens, whole, ids[whole * ID_BYTES:]))
            self._put(level + tokens - whole, pieces)
        if self.n_open > self.open_windows:
            self.fill(self.open_windows // 2)

    def fill(self, keep: int) -> None:
        """Cuts up the emptiest windows to fill the fullest until ``keep`` are open."""
        while self.n_open > keep and self.n_open > 1:
            low, *_, high = np.flatnonzero(self.counts)[[0, -1]]
            target, donor = self._take(int(high)), self._take(int(low))
            gap, level = self.length - int(high), int(low)
            while gap and donor:
                document, tokens, start, ids = donor.pop()
                size = len(ids) // ID_BYTES
                if size > gap:
                    donor.append((document, tokens, start, ids[: (size - gap) * ID_BYTES]))
                    start, ids, size = start + size - gap, ids[(size - gap) * ID_BYTES:], gap
                target.append((document, tokens, start, ids))
                gap, level = gap - size, level - size
            self._put(self.length - gap, target)
            if donor:
                self._put(level, donor)

    def finish(self) -> None:
        self.fill(1)
        for level in np.flatnonzero(self.counts):
            self._close(self._take(int(level)))

    def flush(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def pack(
    documents: DataFrame, tokenizer: str, end_id: int, *, id_column: str = "doc_id",
    text_column: str = "text", length: int = SEQUENCE_TOKENS, open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pieces of all documents: the id column, doc_tokens, start, ids (binary, little-endian unsigned
    32-bit), sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor has. A text's ids are followed
    by ``end_id``. A null text is empty and gives one piece with that id; a null document id stays null.
    Repeated rows are packed as often as they occur. No documents give no pieces. A sequence never
    holds more than ``length`` ids and every id lies in one piece. Equal choices go to the fullest
    window. Other columns are not read. A task holds at most ``open_windows`` partly filled windows.
    """
    id_type = documents.schema[id_column].dataType
    fields = [
        T.StructField(id_column, id_type), T.StructField("doc_tokens", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(length, open_windows, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").fill_null("").cast(pa.binary()).to_pylist()
                for document, ids in zip(part.column("id").to_pylist(), encoder.of(texts)):
                    packer.add(document, ids + end)
                yield from pieces(packer.flush(), part.schema.field("id").type)
        packer.finish()
        if packer.done:
            yield from pieces(packer.flush(), id_arrow_type)

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow_type = to_arrow_type(id_type)
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def pieces(done: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    if done:
        names = ["id", "doc_tokens", "start", "ids", "sequence_id", "offset"]
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*done), types)]
        yield pa.RecordBatch.from_arrays(columns, names)


def with_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with their length and the unsigned crc32 of their ids."""
    length = (F.octet_length("ids") / ID_BYTES).cast("long")
    return pieces.withColumns({"length": length, "ids_crc32": F.crc32("ids")})
