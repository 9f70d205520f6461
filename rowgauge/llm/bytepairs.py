"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string its encoding has one last token, and the encoding of
the prefix before that token ends in the token before it. So one number per prefix, its
last token, holds the encodings of all prefixes: they are read by walking back. The
last token of a prefix is the only one of the vocabulary that ends there and stays apart from the last
token before it, which undoing the two tokens' merges, latest first, tells exactly.

Appending goes on from the last prefix. After an edit, prefixes before it stand, and behind it
work ends once as many prefixes in a row as the longest token has bytes have the tokens they had.
The pieces that a pattern splits a text into are encoded on their own, each distinct one once
per table of a process; the table is emptied when it holds ``TABLE_BYTES``, which costs repeated work but no result.
"""

from __future__ import annotations

import base64
import functools
import unicodedata
from array import array
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import map_batches, text_slices

TABLE_BYTES = 8_000_000
PAIRS = 1_000_000  # remembered at once
#: Characters that a match of the pattern may look at beyond its end.
LOOK_AHEAD = 3


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ranks, from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Vocabulary:
    """Tokens, the two tokens that each is merged from, and which tokens stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.ids = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int]] = {}  # of tokens that merges make; none for single bytes
        self.joined: dict[tuple[int, int], int] = {}
        self.ending: dict[bytes, int] = {}  # every end of a token: its id, or -1
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                halves = merged(token, ranks, rank)
                if len(halves) != 2:
                    continue  # no merges lead to it: a token only as a whole piece
                self.parts[rank] = (ranks[halves[0]], ranks[halves[1]])
                self.joined[self.parts[rank]] = rank
            for k in range(1, len(token)):
                self.ending.setdefault(token[k:], -1)
            self.ending[token] = rank
        self.known: dict[tuple[int, int], bool] = {}

    def apart(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, one after the other, are encoded as these two."""
        pair = (left, right)
        found = self.known.get(pair)
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            found = self.known[pair] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        # back in time: the two tokens at the border were side by side until the later of the tokens
        # that hold them was made; of equal merges the one further left comes first
        until = None
        while True:
            both = self.joined.get((left, right))
            if both is not None and (until is None or both < until):
                return False
            made_left = left if left in self.parts else -1
            made_right = right if right in self.parts else -1
            if made_left > made_right:
                until, left = made_left, self.parts[left][1]
            elif made_right >= 0:
                until, right = made_right + 1, self.parts[right][0]
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        """The ids of a piece; one that is a token is that token."""
        whole = self.ids.get(piece)
        return [whole] if whole is not None else PrefixTokens(self, piece).tokens()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def merged(data: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """``data`` after all merges of a rank less than ``below``: of the least rank first, and further left first."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class PrefixTokens:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, data
        self.last = array("q", [-1])
        self.worked = 0  # prefixes worked out so far
        self._extend(len(data))

    def _token_at(self, end: int) -> int:
        vocabulary, data, last = self.vocabulary, self.data, self.last
        ending, known = vocabulary.ending.get, vocabulary.known.get
        fitting = []
        start = end - 1
        while start >= 0 and (token := ending(data[start:end])) is not None:
            if token >= 0:
                fitting.append((start, token))
            start -= 1
        for start, token in reversed(fitting):
            if start == 0:
                return token
            stays = known((last[start], token))
            if stays or (stays is None and vocabulary.apart(last[start], token)):
                return token
        raise AssertionError("every prefix has a last token")

    def _extend(self, till: int) -> None:
        first = len(self.last)
        for end in range(first, till + 1):
            self.last.append(self._token_at(end))
        self.worked += max(0, till + 1 - first)

    def turn_to(self, data: bytes) -> None:
        """Become ``data``: what it begins with in common stands, the rest is appended."""
        head = len(commonprefix((self.data, data)))
        self.data = data
        del self.last[head + 1 :]
        self._extend(len(data))

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of the bytes from ``start`` to ``stop``; the ends behind it are kept where they hold."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[: start + 1]
        same = 0
        for end in range(start + 1, len(self.data) + 1):
            token = self._token_at(end)
            self.last.append(token)
            self.worked += 1
            # a last token follows from the bytes it may span and the last tokens of the prefixes among them
            same = same + 1 if end - shift > stop and old[end - shift] == token else 0
            if same >= self.vocabulary.longest:
                self.last.extend(old[end - shift + 1 :])
                break

    def tokens(self, end: int | None = None) -> list[int]:
        """The ids of the prefix that ends at ``end``, the whole if none is given."""
        at = len(self.data) if end is None else end
        back = []
        while at:
            back.append(self.last[at])
            at -= len(self.vocabulary.token[back[-1]])
        return back[::-1]


# A letter, a number and another character that stand in for code points of the same class.
STAND_IN = {"letter": "é", "number": "٣", "other": "☃"}


@functools.cache
def engine_class(char: str) -> str:
    """The class that the tokenizer library's own pattern engine gives a code point."""
    import tiktoken

    for name, mate in (("letter", "a"), ("number", "1")):
        ranks = {bytes([b]): b for b in range(256)}
        both = (mate + char).encode()
        for k in range(2, len(both) + 1):
            ranks[both[:k]] = 254 + k
        probe = tiktoken.Encoding("probe", pat_str=r"\p{L}+|\p{N}+|.", mergeable_ranks=ranks, special_tokens={})
        if len(probe.encode_ordinary(mate + char)) == 1:
            return name
    return "other"


class Splitter:
    """Splits texts by a pattern as the tokenizer library does.

    Its engine and the one here follow different versions of Unicode. They agree on code points that Python's
    own tables know; any other is asked of the library, and is read as a stand-in of the class it tells.
    """

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.known: set[str] = set()
        self.odd: dict[int, str] = {}

    def read_as(self, text: str) -> str:
        if text.isascii():
            return text
        met = set(text)
        for char in met - self.known:
            self.known.add(char)
            if unicodedata.category(char) == "Cn":
                self.odd[ord(char)] = STAND_IN[engine_class(char)]
        return text.translate(self.odd) if self.odd and any(ord(c) in self.odd for c in met) else text

    def split(self, text: str) -> list[str]:
        read = self.read_as(text)
        if read is text:
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(read)]

    def ends(self, text: str, start: int = 0) -> Iterator[int]:
        """Where the pieces from ``start`` on end, one after the other."""
        return (m.end() for m in self.pattern.finditer(self.read_as(text), start))


class EditableText:
    """A text with its pieces and their prefixes' tokens."""

    def __init__(self, vocabulary: Vocabulary, splitter: Splitter, text: str = ""):
        self.vocabulary, self.splitter, self.text = vocabulary, splitter, text
        self.ends = list(splitter.ends(text))
        starts = [0, *self.ends[:-1]]
        self.pieces = [PrefixTokens(vocabulary, text[a:b].encode()) for a, b in zip(starts, self.ends)]

    @property
    def worked(self) -> int:
        """Prefixes worked out so far, of the pieces that are there."""
        return sum(p.worked for p in self.pieces)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``stop``; only pieces near them are encoded again."""
        old_text, old_ends, old_pieces = self.text, self.ends, self.pieces
        self.text = text = old_text[:start] + new + old_text[stop:]
        shift = len(text) - len(old_text)
        first = int(np.searchsorted(np.array(old_ends, np.int64) + LOOK_AHEAD, start, "right"))
        at = old_ends[first - 1] if first else 0
        places = {e: i for i, e in enumerate(old_ends)}
        ends, pieces = old_ends[:first], old_pieces[:first]
        for end in self.splitter.ends(text, at):
            piece = text[at:end].encode()
            if len(pieces) == first and first < len(old_pieces):
                pieces.append(_turned(old_pieces[first], piece))
            else:
                pieces.append(PrefixTokens(self.vocabulary, piece))
            ends.append(end)
            at = end
            if end - shift >= stop and (known := places.get(end - shift)) is not None:
                ends.extend(e + shift for e in old_ends[known + 1 :])
                pieces.extend(old_pieces[known + 1 :])
                break
        self.ends, self.pieces = ends, pieces

    def tokens(self) -> list[int]:
        ids = self.vocabulary.ids
        return [t for p in self.pieces for t in ([ids[p.data]] if p.data in ids else p.tokens())]


def _turned(old: PrefixTokens, data: bytes) -> PrefixTokens:
    """The prefixes of ``data``, from those of a string that begins and ends like it."""
    a, b = np.frombuffer(old.data, np.uint8), np.frombuffer(data, np.uint8)
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if differ.size else n
    differ = np.flatnonzero(a[len(a) - n + head :][::-1] != b[len(b) - n + head :][::-1])
    tail = int(differ[0]) if differ.size else n - head
    done = PrefixTokens(old.vocabulary)
    done.data, done.last = old.data, old.last
    done.replace(head, len(a) - tail, data[head : len(b) - tail])
    return done


class PieceTable:
    """Distinct pieces to rows, rows to ids."""

    def __init__(self, vocabulary: Vocabulary, limit: int = TABLE_BYTES):
        self.vocabulary, self.limit = vocabulary, limit
        self.empty()

    def empty(self) -> None:
        self.rows: dict[str, int] = {}
        self.held = 0
        self.ends = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def add(self, pieces: list[str]) -> None:
        """``pieces`` in order: neighbours begin alike, so each is appended to what it shares with the one before."""
        data = [p.encode() for p in pieces]
        state, ids, found = PrefixTokens(self.vocabulary), self.vocabulary.ids, []
        for d in data:
            whole = ids.get(d)
            if whole is None:
                state.turn_to(d)
            found.append(state.tokens() if whole is None else [whole])
        n = len(self.rows)
        self.rows.update((p, n + i) for i, p in enumerate(pieces))
        self.held += sum(map(len, data))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, np.fromiter((x for ids in found for x in ids), np.int32, int(lengths.sum()))])

    def encode(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts, given as their pieces, one after the other, and where each text's end."""
        if self.held > self.limit:
            self.empty()
        rows = self.rows
        if new := {p for pieces in split for p in pieces if p not in rows}:
            self.add(sorted(new))
        row = np.fromiter((rows[p] for pieces in split for p in pieces), np.int64)
        start = self.ends[row]
        size = self.ends[row + 1] - start
        till = np.concatenate([[0], np.cumsum(size)])
        out = self.ids[np.repeat(start - till[:-1], size) + np.arange(till[-1])]
        return out, till[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]


@functools.lru_cache(maxsize=2)
def vocabulary_of(data: bytes) -> Vocabulary:
    """One per process and file of ranks."""
    return Vocabulary(read_ranks(data))


@functools.lru_cache(maxsize=2)
def table_of(data: bytes) -> PieceTable:
    return PieceTable(vocabulary_of(data))


def encode_texts(
    docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """The columns in ``keep``, ``ids`` and, if asked for, ``decoded`` (the bytes of the ids).

    ``ranks`` is a file of base64 tokens and ranks. Ids are exactly the tokenizer library's, without special tokens.
    A null or empty text has no ids. Columns not kept are left behind, so that no name can clash.
    """
    vocabulary_of(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary file: fixed size
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
        + [T.StructField("decoded", T.BinaryType(), False)] * decoded
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, splitter = table_of(shared.value), Splitter(pattern)
        vocabulary = table.vocabulary
        for part, texts in text_slices(batches, len(keep)):
            ids, ends = table.encode([splitter.split(t) if t else [] for t in texts])
            offsets = np.concatenate([[0], ends])
            columns = [part.column(i) for i in range(len(keep))]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))
            if decoded:
                columns.append(pa.array([vocabulary.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs.select(*keep, docs[text].alias("_text")), encode, schema)


def decode_texts(encoded: DataFrame, ranks: bytes, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and ``decoded``, the bytes of the ids; null ids decode to none."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType(), False)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value)
        for batch in batches:
            found = [vocabulary.decode(x or ()) for x in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names=schema.names)

    return map_batches(encoded.select(*keep, encoded[ids].alias("_ids")), decode, schema)


def encode_edited(
    docs: DataFrame, ranks: bytes, pattern: str, edits: str = "edits", text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns in ``keep``, ``ids`` and ``edited_ids``: of each text, and after its edits one after the other.

    ``edits`` is an array of structs ``start, stop, new`` (characters, end exclusive, of the text as it is by then; places
    beyond it mean its end, a null ``new`` the empty text). ``n_again`` counts the prefixes that the edits made the task work out.
    Null texts are empty, null edits none; a null edit is left out.
    """
    vocabulary_of(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    numbers = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("ids", numbers, False), T.StructField("edited_ids", numbers, False), T.StructField("n_again", T.LongType(), False)]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, splitter = vocabulary_of(shared.value), Splitter(pattern)
        for part, texts in text_slices(batches, len(keep)):
            before, after, again = [], [], []
            for t, changes in zip(texts, part.column(len(keep) + 1).to_pylist()):
                state = EditableText(vocabulary, splitter, t or "")
                before.append(state.tokens())
                had = {id(p): p.worked for p in state.pieces}
                held = list(state.pieces)  # so that no id is given twice
                n = 0
                for change in changes or ():
                    if change is None:
                        continue
                    size = len(state.text)
                    start = min(max(change["start"] or 0, 0), size)
                    stop = min(max(start if change["stop"] is None else change["stop"], start), size)
                    state.replace(start, stop, change["new"] or "")
                    fresh = [p for p in state.pieces if id(p) not in had]
                    n += sum(p.worked for p in fresh)
                    had.update((id(p), p.worked) for p in fresh)
                    held += fresh
                after.append(state.tokens())
                again.append(n)
            columns = [part.column(i) for i in range(len(keep))]
            columns += [pa.array(before, pa.list_(pa.int32())), pa.array(after, pa.list_(pa.int32())), pa.array(again, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs.select(*keep, docs[text].alias("_text"), docs[edits].alias("_edits")), encode, schema)
