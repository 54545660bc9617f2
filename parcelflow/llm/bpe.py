"""Byte-level BPE as a lazily determinised transducer, and streaming decode.

Encoding. The canonical tokens of a text have a local property: a sequence of tokens is what the merges
give exactly when each two neighbours, merged on their own, come out unchanged. So the encoding of a
prefix is the encoding of a shorter prefix and one more token, and of all tokens that end at a place just
one fits. A state of the transducer is the part of the past that can still matter: the longest end of
what was read that may yet grow into a token, and for each place in it the tokens of the prefix up to
there. Tokens on which all these prefixes agree are emitted, so the lookahead is bounded by the longest
token. States and their transitions are made when a byte first asks for them, and are dropped
together when they number ``MAX_STATES``.

Texts are parted by the pattern of the rank file into pieces, each encoded from the start state. Pieces
repeat, so a worker keeps the ids of up to ``MAX_PIECES`` short ones; they and the states stay until a task of
another kind begins in it.

Decoding. Ids give bytes; ``Utf8Stream`` turns bytes into text as they come and holds back at most three
bytes of an unfinished character.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.common import released

MAX_STATES = 400_000
MAX_PAIRS = 500_000
MAX_PIECES = 600_000
#: Characters of the longest piece that is kept, and of a text that is taken at a time.
LONGEST_KEPT = 48
SEGMENT = 1 << 22
START, PAST = -1, -2

# The characters that count as white space in the pattern of the rank files.
BLANKS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Latin letters, with a space before them or not, up to a sign that always parts pieces.
LATIN = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
#: Chunks that begin and end where pieces do: a Latin word, or all up to the next blank, or blanks.
CHUNK = re.compile(
    f" ?[{LATIN}]+(?=[\\x00-&(-@\\[-`{{-\\x7f]|\\Z)| ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Transducer:
    """Bytes to token ids, for one set of ranks.

    A state is a number. Its key holds, in few bytes, what was read and may grow into a token, and for each place in
    it the tokens up to there from the last common one on; none where no token can begin.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.starts = {token[:n] for token in ranks for n in range(1, len(token))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.next: dict[int, int] = {}  # 256 * state + byte -> state
        self.out: dict[int, tuple[int, ...]] = {}  # the same -> ids, where there are some
        self.shapes: dict[bytes, tuple] = {}
        self.start = self._state(b"", [(START,)])

    def _state(self, tail: bytes, ends: list[tuple[int, ...]]) -> int:
        key = bytes((len(tail),)) + tail + array("i", [n for end in ends for n in (*end, len(end))]).tobytes()
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.keys)
            self.keys.append(key)
        return number

    def _read(self, state: int) -> tuple[bytes, list[tuple[int, ...]]]:
        key = self.keys[state]
        flat, ends = array("i", key[key[0] + 1 :]), []
        at = len(flat)
        while at:
            n = flat[at - 1]
            ends.append(tuple(flat[at - 1 - n : at - 1]))
            at -= n + 1
        return key[1 : key[0] + 1], ends[::-1]

    def _last(self, state: int) -> array:
        """The ids that are left when a piece ends here."""
        key = self.keys[state]
        n = int.from_bytes(key[-4:], "little")
        return array("i", key[-4 * n : -4])

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging, lowest rank first and leftmost among equals; used on one or two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
            if rank == 1 << 62:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are beside each other."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            b = self.bytes_of[right]
            a = b"" if left == START else self.bytes_of[left]
            found = self.merged(a + b) == ([a, b] if a else [b])
            self.pairs[left, right] = found
        return found

    def _shape(self, grown: bytes) -> tuple[list[tuple[int, int]], list[int]]:
        """Of what was read: the tokens that end here with their places, longest first; the places that stay open."""
        found = self.shapes.get(grown)
        if found is None:
            places = range(len(grown))
            tokens = [(at, self.ranks[grown[at:]]) for at in places if grown[at:] in self.ranks]
            found = self.shapes[grown] = tokens, [at for at in places if grown[at:] in self.starts]
        return found

    def _step(self, state: int, byte: int) -> int:
        tail, before = self._read(state)
        grown = tail + bytes((byte,))
        tokens, places = self._shape(grown)
        for at, token in tokens:
            if before[at] and self.fits(before[at][-1], token):
                now = (*before[at], token)
                break
        else:
            raise ValueError(f"the ranks hold no token for byte {byte}")
        open_ends = [*(before[at] for at in places), now]
        shortest, common = min(map(len, open_ends)), 1
        while common < shortest and all(e[common] == now[common] for e in open_ends):
            common += 1
        # The last common token counts only where it is the end of an open place.
        if shortest > common:
            open_ends = [(PAST, *e[common:]) for e in open_ends]
        else:
            open_ends = [e[common - 1 :] for e in open_ends]
        first = places[0] if places else len(grown)
        ends: list[tuple[int, ...]] = [()] * (len(grown) - first + 1)
        for at, end in zip(places, open_ends, strict=False):
            ends[at - first] = end
        ends[-1] = open_ends[-1]
        after = self._state(grown[first:], ends)
        self.next[state << 8 | byte] = after
        if common > 1:
            self.out[state << 8 | byte] = now[1:common]
        return after

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece. A piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.keys) > MAX_STATES:
            self.reset()
        state, follow, emitted, ids = self.start, self.next, self.out, []
        for byte in piece:
            at = state << 8 | byte
            state = follow.get(at)
            if state is None:
                state = self._step(at >> 8, byte)
            if at in emitted:
                ids += emitted[at]
        ids += self._last(state)
        return ids

    def stream(self, piece: Iterable[int]) -> Iterator[tuple[int, ...]]:
        """Ids as soon as no later byte can change them."""
        if len(self.keys) > MAX_STATES:
            self.reset()
        state, follow, out = self.start, self.next, self.out
        for byte in piece:
            at = state << 8 | byte
            state = follow.get(at)
            if state is None:
                state = self._step(at >> 8, byte)
            ids = out.get(at)
            if ids is not None:
                yield ids
        yield tuple(self._last(state))


class Pieces(dict):
    """Chunk of text to its ids as little-endian 32-bit whole numbers."""

    def __init__(self, transducer: Transducer, pattern: str):
        super().__init__()
        self.transducer = transducer
        # \\s and \\S by the property White_Space, as the tokenizer's own engine reads them.
        self.find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def __missing__(self, chunk: str) -> bytes:
        encode = self.transducer.encode
        ids = [i for piece in self.find(chunk) for i in encode(piece.encode())]
        data = np.array(ids, "<u4").tobytes()
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[chunk] = data
        return data


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Pieces:
    return Pieces(Transducer(read_ranks(path)), pattern)


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """A long text in parts that begin where a piece always does: at a space before a character that is not blank."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


_BOUNDARY = re.compile(f" [^{BLANKS}]")


def encode_text(text: str, pieces: Pieces) -> Iterator[bytes]:
    """The ids of a text, part by part."""
    for part in segments(text):
        yield b"".join(map(pieces.__getitem__, CHUNK.findall(part)))


# How many bytes follow a lead byte of UTF-8, by its leading bits.
def _follow(lead: int) -> int:
    return 0 if lead < 0xC2 else 1 if lead < 0xE0 else 2 if lead < 0xF0 else 3 if lead < 0xF5 else 0


class Utf8Stream:
    """UTF-8 to text, piece by piece; an unfinished character waits for the next piece."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        end = len(data)
        for back in range(1, min(3, end) + 1):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                end -= back if _follow(lead) >= back else 0
                break
        self.held = data[end:]
        return data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8", "replace")


def decode_bytes(ids: bytes, table: list[bytes]) -> bytes:
    """The bytes of ids that are given as little-endian 32-bit whole numbers."""
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode_text(parts: Iterable[bytes], table: list[bytes]) -> Iterator[str]:
    """The text of ids that come in parts; parts may cut characters."""
    stream = Utf8Stream()
    for part in parts:
        yield stream.feed(decode_bytes(part, table))
    yield stream.finish()


@lru_cache(maxsize=2)
def token_table(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _forget() -> None:
    encoder.cache_clear()
    token_table.cache_clear()


def _encoded(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table = encoder(path, pattern), token_table(path)
        for batch in batches:
            n, ids_sha, text_sha, held = [], [], [], []
            for text in batch.column("text"):
                ids_hash, text_hash, count, kept, stream = hashlib.sha256(), hashlib.sha256(), 0, [], Utf8Stream()
                for ids in encode_text(text.as_py() or "", pieces):
                    ids_hash.update(ids)
                    text_hash.update(stream.feed(decode_bytes(ids, table)).encode())
                    count += len(ids) // 4
                    kept.append(ids if with_ids else b"")
                text_hash.update(stream.finish().encode())
                n.append(count)
                ids_sha.append(ids_hash.hexdigest())
                text_sha.append(text_hash.hexdigest())
                held.append(b"".join(kept))
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                       "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if with_ids:
                columns["ids"] = pa.array(held, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return released(run, "bpe", _forget)


def encoded(docs: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text",
            with_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) for every row, and ``ids`` on request.

    ``path`` is a rank file that every executor can open, ``pattern`` the one that parts its texts. ``ids``
    holds the token ids as little-endian 32-bit whole numbers. A null text counts as empty: no
    token, and the digest of nothing. Rows keep their number; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return rows.mapInArrow(_encoded(path, pattern or default_pattern(), with_ids), schema).withColumnRenamed("doc_id", id_col)


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)
        for batch in batches:
            texts = ["".join(decode_text([ids.as_py() or b""], table)) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of token ids as ``encoded`` gives them; null ids give an empty text."""
    rows = tokens.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(_decoded(path), "doc_id bigint, text string").withColumnRenamed("doc_id", id_col)
