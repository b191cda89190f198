"""Byte-level BPE encoding and decoding by prefix dynamic programming, with exact appends and edits.

Cut a piece of bytes anywhere: its BPE encoding up to the cut ends in exactly one token, and two tokens
may stand beside each other exactly if encoding their joined bytes gives these two. So for every prefix
of a piece one number is stored, the last token of the prefix's encoding, found among the tokens that
end there as the one that may follow the last token of what is before it (``Prefixes``). The encoding is
read from the end. Work is linear in the piece, whatever its length; an append only adds entries; after a
change entries are computed anew until as many agree with the old ones as the longest token has bytes.

``Codec.splits`` cuts texts into pieces by the vocabulary's pattern. Which pieces a longer or changed
text can alter follows from how far the pattern looks ahead (``_AHEAD``, ``_SHORT``), so long texts are
split stretch by stretch and ``Encoded`` re-splits only near an edit.

A token that is a piece by itself is the piece's encoding even if no merge leads to it; elsewhere only
tokens reachable by merges occur.

Defined cases: null and empty texts have no tokens; strings of special tokens are ordinary text; invalid
ids raise; repeated rows are encoded each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from occspark.llm.store import bound_batches

#: Code points behind a piece that the pattern may look at, and code points it looks at from a piece's first on.
_AHEAD, _SHORT = 2, 3
#: Code points of a text that are split at once.
STRETCH = 1 << 20
#: Pieces whose tokens a worker remembers, and the longest such piece in code points.
MEMO, MEMO_POINTS = 400_000, 64
_KEPT = "byte_bpe_codecs_of_this_worker"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """A vocabulary of (token, rank) with what encoding by prefixes needs; pure Python, built in under a second."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest, self.never = max(map(len, ranks)), max(ranks.values()) + 1
        self.ends = {t[i:] for t in ranks for i in range(len(t))}
        self.edges: dict[int, tuple[list[int], list[int]]] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    # Which tokens may stand side by side

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte and for a token no merge leads to."""
        if token not in self.parts:
            data = self.tokens[token]
            found = merged(data, self.ranks, token) if len(data) > 1 else ()
            fits = len(found) == 2 and max(found) < token and None not in map(self.spines, found)
            self.parts[token] = (found[0], found[1]) if fits else None
        return self.parts[token]

    def spines(self, token: int) -> tuple[list[int], list[int]] | None:
        """Tokens at a token's right and left edge from its outer byte to itself, in the order merges make them."""
        if token not in self.edges:
            if len(self.tokens[token]) == 1:
                self.edges[token] = ([token], [token])
            elif halves := self.halves(token):
                self.edges[token] = (self.spines(halves[1])[0] + [token], self.spines(halves[0])[1] + [token])
            else:
                self.edges[token] = None
        return self.edges[token]

    def fits(self, left: int, right: int) -> bool:
        """Does encoding the two tokens' joined bytes give these two?

        Merges happen in the order of their ranks, the leftmost first. While both tokens grow, the
        tokens at their seam must never merge before one of them is merged away.
        """
        key = left * self.never + right
        known = self.pairs.get(key)
        if known is None:
            known = self.spines(right) is not None and self._seam_holds(left, right)
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        a, b = self.spines(left)[0], self.spines(right)[1]
        i = j = 0
        never = self.never
        while True:
            next_a = a[i + 1] if i + 1 < len(a) else never
            next_b = b[j + 1] if j + 1 < len(b) else never
            across = self.ranks.get(self.tokens[a[i]] + self.tokens[b[j]])
            if across is not None and across < next_a and across <= next_b:
                return False
            if next_a == next_b == never:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    # Encoding

    def extend(self, data: bytes, last: array, first: int, past: int) -> None:
        """Append to ``last`` the entries of the prefixes of ``first`` to ``past`` - 1 bytes."""
        token_of, pairs, ends, base = self.ranks.get, self.pairs.get, self.ends, self.never
        for end in range(first, past):
            begin = end
            while begin:
                begin -= 1
                part = data[begin:end]
                token = token_of(part)
                if token is None:
                    if part not in ends:
                        begin = -1
                        break
                elif not begin:
                    if self.spines(token) is not None:
                        break
                else:
                    before = last[begin]
                    fits = pairs(before * base + token)
                    if fits or fits is None and self.fits(before, token):
                        break
            else:
                begin = -1
            if begin < 0:
                raise ValueError("The vocabulary lacks a byte of the text.")
            last.append(token)

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        return (whole,) if whole is not None else Prefixes(self, piece).ids()

    def stable(self, text: str, first: int, final: bool) -> tuple[list[str], int]:
        """Pieces of the text from a piece's start on that no more text can change, and where the next one starts."""
        pieces = self.pattern.findall(text, first)
        if final:
            return pieces, len(text)
        at, kept = first, 0
        for piece in pieces:
            if max(at + len(piece) + _AHEAD, at + _SHORT) > len(text):
                break
            at, kept = at + len(piece), kept + 1
        return pieces[:kept], at

    def splits(self, text: str, stretch: int = STRETCH) -> Iterator[list[str]]:
        """The pieces of a text, a stretch at a time."""
        first, size = 0, stretch
        while first < len(text):
            final = first + size >= len(text)
            pieces, to = self.stable(text if final else text[: first + size], first, final)
            if not pieces:
                size *= 2
                continue
            yield pieces
            first, size = to, stretch

    def pieces_ids(self, pieces: list[str]) -> list[int]:
        """The tokens of pieces in sequence."""
        memo, ids = self.memo, []
        for piece in pieces:
            found = memo.get(piece)
            if found is None:
                found = self.older.get(piece) or self.encode_piece(piece.encode())
                if len(piece) <= MEMO_POINTS:
                    if len(memo) >= MEMO:
                        # The full one steps back; what is asked for again returns from it.
                        self.older, self.memo = memo, {}
                        memo = self.memo
                    memo[piece] = found
            ids += found
        return ids

    def stretches(self, text: str | None) -> Iterator[list[int]]:
        for pieces in self.splits(text or ""):
            yield self.pieces_ids(pieces)

    def encode(self, text: str | None) -> list[int]:
        return [i for ids in self.stretches(text) for i in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def merged(data: bytes, ranks: dict[bytes, int], below: int) -> tuple[int, ...]:
    """Plain BPE with the merges of ranks under ``below``; for the short bytes of a token."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(ranks[p] for p in parts)


class Prefixes:
    """The last token of the encoding of every prefix of a piece."""

    def __init__(self, codec: Codec, piece: bytes = b"") -> None:
        self.codec, self.data, self.last = codec, b"", array("i", [-1])
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Make the piece longer; no entry changes."""
        known = len(self.data)
        self.data += more
        self.codec.extend(self.data, self.last, known + 1, len(self.data) + 1)

    def replace(self, first: int, past: int, new: bytes) -> int:
        """Put ``new`` for the bytes ``first`` to ``past``; returns how many entries had to be computed."""
        old, shift = self.last, len(new) - (past - first)
        data = self.data[:first] + new + self.data[past:]
        last, agree, end = old[: first + 1], 0, first + 1
        while end <= len(data) and agree < self.codec.longest:
            self.codec.extend(data, last, end, end + 1)
            agree = agree + 1 if end > first + len(new) and last[end] == old[end - shift] else 0
            end += 1
        computed = end - first - 1
        self.data, self.last = data, last + old[end - shift :]
        return computed

    def ids(self) -> tuple[int, ...]:
        """The encoding of the piece, read from its end."""
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end])
            end -= len(self.codec.tokens[self.last[end]])
        return tuple(reversed(found))


class Encoded:
    """A text with its pieces and their prefix tables, for appends and edits. Positions are code points."""

    def __init__(self, codec: Codec, text: str = "") -> None:
        self.codec, self.text = codec, ""
        self.starts: list[int] = []
        self.tables: list[Prefixes] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, first: int, past: int, new: str) -> int:
        """Put ``new`` for the code points ``first`` to ``past``; returns how many pieces had to be encoded."""
        text = self.text[:first] + new + self.text[past:]
        shift = len(new) - (past - first)
        kept, count = bisect_right(self.starts, first), len(self.starts)
        ends = [*self.starts[1:], len(self.text)]
        while kept and max(ends[kept - 1] + _AHEAD, self.starts[kept - 1] + _SHORT) > first:
            kept -= 1
        at = ends[kept - 1] if kept else 0
        old = {start: i for i, start in enumerate(self.starts[kept:], kept) if start >= past}
        starts, tables, tail = [], [], count
        for found in self.codec.pattern.finditer(text, at):
            start = found.start()
            # From here on the old pieces stand as they are, only further along.
            if start >= first + len(new) and start - shift in old:
                tail = old[start - shift]
                break
            starts.append(start)
            tables.append(self._table(kept + len(tables), found[0].encode()))
        computed = len(tables)
        self.text = text
        self.starts = self.starts[:kept] + starts + [s + shift for s in self.starts[tail:]]
        self.tables = self.tables[:kept] + tables + self.tables[tail:]
        return computed

    def _table(self, at: int, piece: bytes) -> Prefixes:
        """The table of a piece: the one that stood at its place, changed only where bytes differ."""
        if at < len(self.tables):
            old = self.tables[at].data
            same = next((i for i, (a, b) in enumerate(zip(old, piece, strict=False)) if a != b), min(len(old), len(piece)))
            if same:
                table = Prefixes(self.codec)
                table.data, table.last = old, self.tables[at].last[:]
                table.replace(same, len(old), piece[same:])
                return table
        return Prefixes(self.codec, piece)

    def ids(self) -> list[int]:
        ranks = self.codec.ranks
        return [i for t in self.tables for i in ((ranks[t.data],) if t.data in ranks else t.ids())]


# Documents


def _codec(path: str, pattern: str) -> Codec:
    """The codec of a worker process, with the pieces it remembers from earlier tasks.

    Functions that travel to a task bring their module's variables along anew, so it is kept beside
    the process's modules instead.
    """
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
    name = f"{path}|{pattern}"
    if name not in kept:
        kept[name] = Codec(read_ranks(path), pattern)
    return kept[name]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row's whole text."""
    bound_batches(docs.sparkSession)
    path, pattern = path or tokenizer_path("byte_bpe_50k.tiktoken"), pattern or default_pattern()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            ids = [codec.encode(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, data): the bytes of rows of ids."""
    path, pattern = path or tokenizer_path("byte_bpe_50k.tiktoken"), pattern or default_pattern()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            data = [codec.decode(ids.as_py() or ()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and its ids decoded, by stretches."""
    bound_batches(docs.sparkSession)
    path, pattern = path or tokenizer_path("byte_bpe_50k.tiktoken"), pattern or default_pattern()
    id_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.string()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        decimal = {i: str(i) for i in codec.tokens}
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text in batch.column("text"):
                n, numbers, data = 0, hashlib.sha256(), hashlib.sha256()
                for ids in codec.stretches(text.as_py()):
                    numbers.update(((" " if n else "") + " ".join(map(decimal.__getitem__, ids))).encode())
                    data.update(codec.decode(ids))
                    n += len(ids)
                for values, value in zip(out, (n, numbers.hexdigest(), data.hexdigest()), strict=True):
                    values.append(value)
            columns = [batch.column("doc_id"), *[pa.array(v, k) for v, k in zip(out, kinds[1:], strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {id_type.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(digest, schema)
