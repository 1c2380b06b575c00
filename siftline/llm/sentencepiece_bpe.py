"""Exact SentencePiece encoding (merge type) by backtracking, and decoding.

A text is valid under the merge rules only as one sequence of pieces, and a sequence is valid exactly if each pair of
neighbours is: merging the two pieces' characters again must give the same two pieces. So the encoder never merges
whole texts. It takes the longest piece at a place (an Aho-Corasick automaton over reversed pieces, run over the reversed
text, lists all pieces that begin at each place), checks it against the piece before it, tries shorter ones where that
fails, and steps back where none is left; a bitfield remembers places from which no valid rest exists, so each place
fails once.

No piece has a space mark after another character, so no piece crosses from a word into the space before the next one:
words are encoded apart and remembered in a bounded table. Inside a word, the same holds between a letter and those
marks that follow a letter in no piece, so a new word is looked up in such parts. These properties, and that every
character of a piece is a piece, are checked or derived when a model is loaded.

Edge cases: null and empty texts give no ids and an empty text; characters without a piece become their UTF-8 bytes;
very long words are encoded like others, only not remembered; other columns are kept, and an input column named ``ids``
or ``decoded`` is replaced. Memory: a batch of texts, and ``REMEMBERED`` words.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounded_batches, column_at, table

SPACE = "▁"
#: Words in each of a worker's two tables (when the newer is full, it becomes the older), and the longest in them.
REMEMBERED, LONGEST_REMEMBERED = 250_000, 64
#: Characters of text after which a batch of results is handed on.
HANDED_ON = 2_000_000
#: Numbers of fields and kinds of pieces in the model's file format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGE_TYPE = 2


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer; bytes for strings, messages and fixed sizes."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = number() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class Codec:
    """Encodes and decodes with one model."""

    def __init__(self, model: bytes):
        import struct

        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: dict[str, float] = {}
        normalizer: dict = {}
        for field, value in _fields(model):
            if field == _PIECES:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                self.kinds.append(own.get(3, _NORMAL))
                if self.kinds[-1] == _NORMAL:
                    self.scores[self.pieces[-1]] = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            elif field == _TRAINER and dict(_fields(value)).get(3, 1) != _MERGE_TYPE:
                raise ValueError("not a merge-type model")
            elif field == _NORMALIZER:
                normalizer = dict(_fields(value))
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models without normalization, with a dummy prefix and escaped spaces are supported")
        if set(self.kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("the model has pieces of kinds that aren't supported")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL}
        self.characters = {p for p in self.ids if len(p) == 1}
        if any(c not in self.characters for p in self.ids for c in p):
            raise ValueError("a character of a piece is no piece itself")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece crosses from a word into the next space")
        self.bytes = [0] * 256
        for i, (p, k) in enumerate(zip(self.pieces, self.kinds)):
            if k == _BYTE:
                self.bytes[int(p[3:5], 16)] = i
        apart = "" if "\n" in self.characters else r"\n"
        self.words = re.compile(rf"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (r"|\n" if apart else "")).findall
        after_letter = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}
        marks = sorted(c for c in self.characters - after_letter if not c.isalpha() and c != SPACE)
        no_letters = "".join(c for c in map(chr, range(0x110000)) if re.match(r"[^\W\d_]", c) and not c.isalpha())
        self.cuts = re.compile(rf"(?<=[^\W\d_{re.escape(no_letters)}])(?=[{re.escape(''.join(marks))}])").split if marks else lambda word: [word]
        self.plain = [p.replace(SPACE, " ") if k == _NORMAL else "" if k == _CONTROL else " ⁇ " for p, k in zip(self.pieces, self.kinds)]
        self.byte_ids = frozenset(i for i, k in enumerate(self.kinds) if k == _BYTE)
        self.lengths = [len(p) for p in self.pieces]
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}  # words that don't decode to themselves, if a model has any
        self._automaton = self._reversed_automaton()

    def _reversed_automaton(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            if self._merged(piece) == [piece]:  # others are never a result of merging
                automaton.add_word(piece[::-1], number)
        automaton.make_automaton()
        return automaton

    def _merged(self, text: str) -> list[str]:
        """The merge rules themselves, for a few characters: best score first, leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of two neighbours again gives the same two pieces."""
        key = left << 32 | right
        out = self.pairs.get(key)
        if out is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            a, b = self.pieces[left], self.pieces[right]
            out = self.pairs[key] = self._merged(a + b) == [a, b]
        return out

    def _split(self, word: str) -> list[int]:
        """Ids of a word whose characters are all pieces."""
        starting: list[list[int]] = [[] for _ in word]
        for end, number in self._automaton.iter(word[::-1]):
            starting[~end].append(number)  # matches that end at one place come longest first
        n, lengths, pairs = len(word), self.lengths, self.pairs
        taken: list[int] = []
        tried: list[int] = []  # for each piece taken, how many at its place have been tried, itself included
        failed = None  # a bitfield over places, made when the first one fails
        at = last = k = 0
        while at < n:
            options = starting[at]
            for k in range(k, len(options)):
                number = options[k]
                if failed is not None and failed[(at + lengths[number]) >> 3] >> (at + lengths[number] & 7) & 1:
                    continue
                if not taken or (pairs[last | number] if last | number in pairs else self.compatible(last >> 32, number)):
                    taken.append(number)
                    tried.append(k + 1)
                    at += lengths[number]
                    last = number << 32
                    k = 0
                    break
            else:
                if not taken:
                    raise ValueError(f"no valid pieces for {word[:50]!r}")
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= lengths[taken.pop()]
                k = tried.pop()
                last = taken[-1] << 32 if taken else 0
        return taken

    def _part(self, word: str) -> list[int]:
        if self.characters.issuperset(word):
            return self._split(word)
        ids: list[int] = []
        start = 0
        for i, c in enumerate(word):
            if c not in self.characters:
                if start < i:
                    ids += self._split(word[start:i])
                ids += [self.bytes[b] for b in c.encode()]
                start = i + 1
        if start < len(word):
            ids += self._split(word[start:])
        return ids

    def word(self, word: str) -> bytes:
        """Ids of a word, as native 32-bit integers. What they decode to is compared with the word when it is new."""
        found = self.known.get(word)
        if found is not None:
            return found
        found = self.older.get(word)
        if found is None:
            parts = [word] if word.lstrip(SPACE).isalpha() else self.cuts(word)
            if len(parts) > 1:
                found = b"".join([self.word(p) for p in parts])
                plain = "".join([self.odd.get(p, p.replace(SPACE, " ")) for p in parts])
            else:
                ids = self._part(word)
                found, plain = array("i", ids).tobytes(), self._plain(ids)
            if plain != word.replace(SPACE, " "):
                self.odd[word] = plain
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[word] = found
        return found

    def _plain(self, ids) -> str:
        kinds = self.kinds
        if self.byte_ids.isdisjoint(ids):
            return "".join([self.plain[i] for i in ids])
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if kinds[i] == _BYTE:
                run.append(int(self.pieces[i][3:5], 16))
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.plain[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def both(self, text: str | None) -> tuple[bytes, str]:
        """Ids of a text, as native 32-bit integers, and the text that they decode to."""
        if not text:
            return b"", ""
        if len(self.odd) > REMEMBERED:
            self.known, self.older, self.odd = {}, {}, {}
        words = self.words(SPACE + text.replace(" ", SPACE))
        ids = b"".join(map(self.word, words))
        odd = self.odd
        plain = "".join([odd.get(w, w) for w in words] if odd else words).replace(SPACE, " ")
        return ids, plain.removeprefix(" ")

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        out.frombytes(self.both(text)[0])
        return out.tolist()

    def decode(self, ids) -> str:
        return self._plain(ids).removeprefix(" ")


_LOADED: dict[str, Codec] = {}


def codec(model: bytes) -> Codec:
    """The codec of a model, loaded once per process."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Codec(model)
    return _LOADED[key]


def encode_decode(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` with ids array<int>, and decoded, the text that those ids stand for. One pass without a shuffle.

    The driver reads the model (a file of at most a few MB, checked) and ships it; executors need no copy.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    if len(model) > 64 << 20:
        raise ValueError("a model of over 64 MB isn't shipped")
    df = df.drop(*[c for c in df.columns if c.lower() in {"ids", "decoded"}])
    bounded_batches(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches):
        own = codec(shipped.value)
        for batch in batches:
            values = column_at(batch, text)
            offsets, numbers, plain, total, size, first = [0], [], [], 0, 0, 0
            for row in range(batch.num_rows):
                value = values[row].as_py() or ""
                joined, decoded = own.both(value)
                numbers.append(joined)
                total += len(joined) // 4
                offsets.append(total)
                plain.append(decoded)
                size += len(value)
                if size > HANDED_ON or row + 1 == batch.num_rows:
                    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(b"".join(numbers))]))
                    kept = batch.slice(first, row + 1 - first).columns
                    yield pa.RecordBatch.from_arrays([*kept, ids, pa.array(plain, pa.string())], names=[*batch.schema.names, "ids", "decoded"])
                    offsets, numbers, plain, total, size, first = [0], [], [], 0, 0, row + 1

    return df.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_decode(docs, default_model())
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
