"""Byte-level BPE by backtracking over longest token matches, and decoding by an offset table.

The encoder reads a piece from left to right. An Aho-Corasick automaton over the tokens gives the longest token that starts at a
place; it is accepted if it is compatible with the token before it, else the next shorter token that is a prefix of it is tried,
and where none is left the token before is taken back and shortened. A place from which no encoding leads on is marked once, so
the work is linear in the piece. Two neighbouring tokens are compatible when merging their joined bytes by rank would
leave exactly these two; then any chain of compatible neighbours is what merging by rank makes of the whole piece.

Texts are cut into pieces by the tokenizer's pattern first. Words between single blanks or line ends are looked up in a
per-worker memory of words seen before (bounded: it is emptied when full), only new words are cut and encoded.

The vocabulary file is read on the driver and broadcast: its size is fixed and does not depend on the data. Null texts count
as empty: no ids, empty decoded text. Strings of special tokens in a text become their id, as the tokenizers library has it
by default. Each row is encoded by itself: repeated rows, extra columns and empty tables need no care.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import WordTable, kept_by_worker, pieces, ragged, starts_of, tidy

#: How byte-level tokenizers cut texts (fixed value of the file format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words one worker remembers, and bytes of text it works on at a time.
MEMORY, BATCH_BYTES = 800_000, 4_000_000


def byte_letters() -> dict[str, int]:
    """The letter by which the file writes each byte: printable ones as themselves, the others from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Tokens by id, the merge behind each token, and the automaton; made from the text of a tokenizer file."""

    def __init__(self, text: str):
        file = json.loads(text)
        letter = byte_letters()
        model = file["model"]
        raw = {i: bytes(letter[c] for c in token) for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        raw |= {i: content.encode() for content, i in self.special.items()}
        self.tokens = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.sizes = self.lengths.tolist()
        self.starts = starts_of(self.lengths)
        self.bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.names = [str(i) for i in range(len(self.tokens))]
        ids = {t: i for t, i in model["vocab"].items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.rank.setdefault(pair, rank)
            if whole not in self.halves:
                self.halves[whole], self.born[whole] = pair, rank
        self.never = len(model["merges"])
        self.automaton = ahocorasick.Automaton()
        by_bytes = {}
        for token, i in model["vocab"].items():
            if len(token) == 1 or i in self.halves:
                by_bytes[raw[i].decode("latin-1")] = i
        for token, i in by_bytes.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, tuple[int, int] | None] = {}
        for token, i in by_bytes.items():
            self.shorter[i] = next(((by_bytes[token[:k]], k) for k in range(len(token) - 1, 0, -1) if token[:k] in by_bytes), None)
        #: Token pairs, packed into one number, that were looked at before.
        self.compatible: dict[int, bool] = {}
        self.cut = regex.compile(PATTERN).findall
        self.parting = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of a token that stand at its right (1) or left (0) end while it is merged, each with the rank that ends it."""
        out, end = [(token, self.never)], self.never
        while token in self.halves:
            end, token = self.born[token], self.halves[token][side]
            out.append((token, end))
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether the two stay apart: no merge across the seam comes before both of its parts are merged elsewhere."""
        pair = left << 32 | right
        known = self.compatible.get(pair)
        if known is None:
            known = True
            for x, x_ends in self._edge(left, 1):
                for y, y_ends in self._edge(right, 0):
                    rank = self.rank.get((x, y))
                    # Of equal pairs in a row the left one is merged first.
                    if rank is not None and rank < x_ends and rank <= y_ends:
                        known = False
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            self.compatible[pair] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        text = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        matches = self.automaton.iter_long
        # The way that takes the longest token everywhere comes first; often it is the answer.
        out = [token for _, token in matches(text)]
        seen, before = self.compatible.get, -1
        for token in out:
            if before >= 0:
                known = seen(before << 32 | token)
                if not (self.fits(before, token) if known is None else known):
                    break
            before = token
        else:
            return out
        first, sizes, at, end, dead = out[0], [], 0, len(text), bytearray(len(text) + 1)
        out, sizes_of = [], self.sizes
        step = (first, sizes_of[first])
        while at < end:
            token, size = step
            if not dead[at + size] and (not out or self.fits(out[-1], token)):
                out.append(token)
                sizes.append(size)
                at += size
                if at < end:
                    token = next(matches(text, at))[1]
                    step = (token, sizes_of[token])
                continue
            step = self.shorter[token]
            if step is None:
                dead[at] = 1
                token, size = out.pop(), sizes.pop()
                at -= size
                step = (token, size)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        return self.bytes[ragged(self.starts[ids], lengths)].tobytes()


class _Words(dict):
    """Number of a word in a coder's table, encoded when first met."""

    def __init__(self, coder: Coder, blank: str):
        self.coder, self.blank = coder, blank

    def __missing__(self, word: str) -> int:
        number = self[word] = self.coder.add(self.blank, word)
        return number


class Coder:
    """Encodes texts with a memory of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.forget()

    def forget(self) -> None:
        self.first, self.later = _Words(self, ""), _Words(self, " ")
        self.table = WordTable()
        #: Words met since the table was last filled up: ids one after the other, how many each has, and marks.
        self.new_ids: list[int] = []
        self.new_sizes: list[int] = []
        self.new_marks: list[bool] = []
        #: Signs and short pieces, which come again in many words.
        self.parts: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        ids = self.parts.get(piece)
        if ids is None:
            known = self.later.get(piece[1:]) if piece[:1] == " " else self.first.get(piece)
            ids = self.v.encode_piece(piece) if known is None or known >= self.table.count else self.table.ids(known)
            if len(piece) < 4:
                self.parts[piece] = ids
        return ids

    def add(self, blank: str, word: str) -> int:
        pieces_ = self.v.cut(blank + word)
        ids = self.v.encode_piece(pieces_[0]) if len(pieces_) == 1 else [i for piece in pieces_ for i in self._piece(piece)]
        # Beside another white space, white space at a word's edge could belong to another piece.
        self.new_ids += ids
        self.new_sizes.append(len(ids))
        self.new_marks.append(not word or word[0].isspace() or word[-1].isspace())
        return self.table.count + len(self.new_sizes) - 1

    def _settle(self) -> None:
        """New words go into the table together."""
        if self.new_sizes:
            self.table.add_flat(self.new_ids, np.array(self.new_sizes, dtype=np.int64), self.new_marks)
            self.new_ids, self.new_sizes, self.new_marks = [], [], []

    def _numbers(self, text: str) -> list[int]:
        """Numbers of the words between single blanks and line ends."""
        out: list[int] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.first["\n"])
            words = line.split(" ")
            out.append(self.first[words[0]])
            out += map(self.later.__getitem__, words[1:])
        return out

    def _plain(self, text: str) -> np.ndarray:
        """Ids of a text without special tokens."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        line_end, numbers = self.first["\n"], np.array(self._numbers(text), dtype=np.int64)
        self._settle()
        # Where white spaces meet, words do not part pieces for sure, and the whole text is cut by the pattern. The line end is a word too.
        unsure = self.table.marks[numbers] & (numbers != line_end)
        if unsure.any():
            numbers = np.array([self.first[piece] for piece in self.v.cut(text)], dtype=np.int64)
            self._settle()
        return self.table.gather(numbers)[0]

    def encode(self, text: str | None) -> np.ndarray:
        if self.table.count > MEMORY:
            self.forget()
        text = text or ""
        if not any(s in text for s in self.v.special):
            return self._plain(text)
        parts = self.v.parting.split(text)
        return np.concatenate([np.array([self.v.special[p]], dtype=np.int32) if i % 2 else self._plain(p) for i, p in enumerate(parts)])


def coder_of(text: str) -> Coder:
    """One coder per worker and vocabulary."""
    key = hashlib.sha256(text.encode()).hexdigest()
    return kept_by_worker(("bpe", key), lambda: Coder(Vocabulary(text)))


def _file(df: DataFrame, path: str | os.PathLike):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str | os.PathLike) -> DataFrame:
    """doc_id, ids (array<int>) of every row."""
    file = _file(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(file.value)
        for batch in batches:
            for part in pieces(iter([batch]), BATCH_BYTES):
                ids = [coder.encode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run, keeps=True), "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str | os.PathLike) -> DataFrame:
    """doc_id, text of every row of (doc_id, ids); bytes that are no UTF-8 become the replacement sign, null ids an empty text."""
    file = _file(coded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = coder_of(file.value).v
        for batch in batches:
            texts = [v.decode(np.asarray(x.values, dtype=np.int64) if x.is_valid else np.zeros(0, np.int64)).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(tidy(run, keeps=True), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | os.PathLike) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded in one pass."""
    file = _file(docs, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(file.value)
        name = coder.v.names.__getitem__
        for batch in batches:
            sizes, coded, back = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py())
                sizes.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(name, ids.tolist())).encode()).hexdigest())
                back.append(hashlib.sha256(coder.v.decode(ids).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(coded), pa.array(back)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        tidy(run, keeps=True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
