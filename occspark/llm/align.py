"""Alignment of two tokenizers over the same texts, by anchors at white space.

Both tokenizers encode space + text in full. Where a token of each ends and the next token of each
starts with a space, the text is cut: such places are taken from the space-marked tokens of the one
and verified by the byte offsets of the other. Between two cuts lies a window, a short run of ids of
both. The alignment of a window (groups between shared ends, links, text form) depends on its ids
alone, so it is worked out once and remembered by them.

Documents are gathered into shards. A shard stores its windows once, each document as numbers of
windows, and each id pair with the number of its documents. Pair counts of the corpus are sums over
shards; they return to each shard as two numbers per pair, from which every window's count and
best links follow, and every document's as sums over its windows. So what is shuffled is one row
per shard and different pair, and no text and no token.

Long texts are tokenised stretch by stretch, cut where a space follows something else: neither
tokenizer has a token across such a place, which is checked for both vocabularies.

Defined cases: texts that are null, empty, or whose tokens' bytes are not space + text for both
tokenizers have no tokens: zeros and an empty digest; repeated rows count as documents of their own;
strings of special tokens are ordinary text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from occspark.llm.bpe import default_pattern, tokenizer_path
from occspark.llm.shards import SHARD_ROWS, first_shard, gathered, joined, one_list
from occspark.llm.store import bound_batches, stored

#: A worker holds some 300 bytes per different window of a shard: 4 MB of text have about 150,000.
SHARD_BYTES = 1 << 22
#: Code points that are tokenised at once.
STRETCH = 1 << 18
#: Documents whose windows are found at once.
TOGETHER = 64
_MARK = "▁"
_CUT = re.compile(r"(?<=\S) ")
_COMMA, _BAR, _SEMICOLON = b",|;"


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def taken(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices first[i], first[i] + 1, ... (sizes[i] of them) of every i, in sequence."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Strings:
    """Many byte strings in one array."""

    def __init__(self, values: list[bytes]) -> None:
        self.sizes = np.array([len(v) for v in values], dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(values), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return self.data[taken(self.first[ids], self.sizes[ids])].tobytes()


class Side:
    """A tokenizer: ids of texts, and each id's bytes."""

    def __init__(self, tokens: list[bytes], encode: Callable[[list[str]], list[np.ndarray]]) -> None:
        if any(_CUT.search(t.decode(errors="replace")) for t in tokens):
            raise ValueError("A token reaches across a space, so texts can't be cut there.")
        self.encode, self.tokens = encode, Strings(tokens)
        self.sizes = self.tokens.sizes
        self.marked = np.array([t[:1] == b" " for t in tokens])


def byte_level_side(path: str, pattern: str | None = None) -> Side:
    """A byte-level BPE vocabulary of the ``tokenizers`` format; texts come with their space.

    Its merges are in the order of the ids they make, so ids are ranks and the faster ``tiktoken``
    encoder gives the same ids; another order is refused.
    """
    import tiktoken

    with open(path) as file:
        held = json.load(file)
    letters, vocab = byte_of_letter(), held["model"]["vocab"]
    special = {t["content"] for t in held["added_tokens"]}
    merges = [m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"]]
    made = [vocab["".join(m)] for m in merges]
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    if made != sorted(set(made)) or len(made) + 256 != len(ranks):
        raise ValueError("The vocabulary's ids don't follow its merges.")
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        tokens[i] = token.encode() if token in special else bytes(letters[c] for c in token)
    coder = tiktoken.Encoding(
        f"side-{uuid.uuid4().hex}", pat_str=pattern or default_pattern(), mergeable_ranks=ranks, special_tokens={}
    )

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [coder.encode_to_numpy(t, disallowed_special=()).astype(np.int32) for t in texts]

    return Side(tokens, encode)


def piece_side(path: str) -> Side:
    """A tokenizer of the ``sentencepiece`` library; it puts a space before each text, which is taken off first."""
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(coder.vocab_size()):
        piece = coder.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece) if coder.is_byte(i) else None
        tokens.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_MARK, " ").encode())

    def encode(texts: list[str]) -> list[np.ndarray]:
        # Of an empty text it makes no token, though a lone space is one.
        found = coder.encode([t[1:] for t in texts], num_threads=1)
        return [np.array(ids or [coder.piece_to_id(_MARK)], dtype=np.int32) for ids in found]

    return Side(tokens, encode)


def stretches(text: str, size: int = STRETCH) -> list[str]:
    """The text in parts of about ``size`` code points, each of which but the first starts with a space behind another letter."""
    parts, first = [], 0
    while first + size < len(text):
        cut = _CUT.search(text, first + size)
        if not cut:
            break
        parts.append(text[first : cut.start()])
        first = cut.start()
    return [*parts, text[first:]]


Ids = tuple[np.ndarray, np.ndarray]


def tokenised(texts: Iterable[str | None], a: Side, b: Side, size: int = STRETCH) -> Iterator[Ids | None]:
    """The ids of each text by both sides; None where there are none by definition."""

    def checked(parts: list[str], ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> Ids | None:
        whole_a, whole_b = np.concatenate(ids_a), np.concatenate(ids_b)
        plain = "".join(parts).encode()
        return (whole_a, whole_b) if a.tokens.joined(whole_a) == plain == b.tokens.joined(whole_b) else None

    waiting: list[list[str]] = []
    held = 0
    for text in (*texts, ...):
        if text is ... or held + len(text or "") > size:
            parts = [p for w in waiting for p in w]
            ids_a, ids_b = (a.encode(parts), b.encode(parts)) if parts else ([], [])
            at = 0
            for own in waiting:
                to = at + len(own)
                yield checked(own, ids_a[at:to], ids_b[at:to]) if own else None
                at = to
            waiting, held = [], 0
        if text is ...:
            return
        if text and len(text) > size:
            # A long text by itself, a stretch at a time.
            parts = stretches(f" {text}", size)
            yield checked(parts, [a.encode([p])[0] for p in parts], [b.encode([p])[0] for p in parts])
        else:
            waiting.append([f" {text}"] if text else [])
            held += len(text or "")


def cuts(ids_a: np.ndarray, ids_b: np.ndarray, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Where windows begin in the ids of both sides: shared ends before space-marked tokens, and the start."""
    starts_a = np.cumsum(a.sizes[ids_a]) - a.sizes[ids_a]
    starts_b = np.cumsum(b.sizes[ids_b]) - b.sizes[ids_b]
    marked_a, marked_b = np.flatnonzero(a.marked[ids_a]), np.flatnonzero(b.marked[ids_b])
    _, at_a, at_b = np.intersect1d(starts_a[marked_a], starts_b[marked_b], assume_unique=True, return_indices=True)
    return marked_a[at_a], marked_b[at_b]


class Windows:
    """The windows of a shard: their numbers by ids, and what follows from the ids alone."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        self.digits = Strings([str(i).encode() for i in range(max(len(a.sizes), len(b.sizes)))])
        #: Each key that is new gets the next number.
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.texts: list[bytes] = []
        self.groups, self.links = array("q"), array("q")
        #: Per window its pairs (one side's id above the other's) and how often it links each.
        self.starts, self.pairs, self.times = array("q", [0]), array("q"), array("q")

    def of(self, documents: list[Ids]) -> list[np.ndarray]:
        """The numbers of each document's windows, in order."""
        ids_a, ids_b = (np.concatenate([d[i] for d in documents]) for i in (0, 1))
        first_a, first_b = cuts(ids_a, ids_b, self.a, self.b)
        past_a, past_b = np.append(first_a[1:], len(ids_a)), np.append(first_b[1:], len(ids_b))
        data_a, data_b = ids_a.tobytes(), ids_b.tobytes()
        spans = ((x * 4).tolist() for x in (first_a, past_a, first_b, past_b))
        # No id has the number in between, so a key tells where one side's ids stop.
        keys = [data_a[s:e] + b"\xff\xff\xff\xff" + data_b[t:f] for s, e, t, f in zip(*spans, strict=True)]
        known = len(self.numbers)
        found = np.array(list(map(self.numbers.__getitem__, keys)), dtype=np.int64)
        if len(self.numbers) > known:
            later = np.flatnonzero(found >= known)
            new = later[np.unique(found[later], return_index=True)[1]]
            self._add(ids_a, ids_b, first_a[new], past_a[new] - first_a[new], first_b[new], past_b[new] - first_b[new])
        # Every document starts with a space, so a window begins with it.
        begins = np.cumsum([0, *(len(d[0]) for d in documents)])
        return np.split(found, np.searchsorted(first_a, begins[1:-1]))

    def _add(self, ids_a, ids_b, first_a, count_a, first_b, count_b) -> None:
        """Align new windows, all at once: both sides of each have the same bytes, so offsets run on over them."""
        x, y = ids_a[taken(first_a, count_a)].astype(np.int64), ids_b[taken(first_b, count_b)].astype(np.int64)
        ends_a, ends_b = np.cumsum(self.a.sizes[x]), np.cumsum(self.b.sizes[y])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        size_a, size_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        window = np.repeat(np.arange(len(count_a)), count_a)[np.cumsum(size_a) - 1]
        per_window = np.bincount(window, minlength=len(count_a))
        self.groups.extend(per_window.tolist())
        self.links.extend(np.bincount(window, weights=size_a * size_b, minlength=len(count_a)).astype(np.int64).tolist())
        # Pairs: every token of one side with every token of its group on the other.
        begin_b = np.cumsum(size_b) - size_b
        partners = size_b[group_a]
        pair = np.repeat(x, partners) << 32 | y[taken(begin_b[group_a], partners)]
        owner = np.repeat(window[group_a], partners)
        order = np.lexsort((pair, owner))
        pair, owner = pair[order], owner[order]
        head = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])))
        base = self.starts[-1]
        self.pairs.frombytes(pair[head].tobytes())
        self.times.frombytes(np.diff(np.append(head, len(pair))).astype(np.int64).tobytes())
        self.starts.extend((base + np.cumsum(np.bincount(owner[head], minlength=len(count_a)))).tolist())
        # Text form: ids of a group, one side before the other, each with the sign behind it.
        sign_a = np.where(np.append(group_a[1:] != group_a[:-1], True), _BAR, _COMMA)
        sign_b = np.where(np.append(group_b[1:] != group_b[:-1], True), _SEMICOLON, _COMMA)
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        ids, signs = np.concatenate((x, y))[order], np.concatenate((sign_a, sign_b))[order]
        sizes = self.digits.sizes[ids] + 1
        behind = np.cumsum(sizes)
        text = np.empty(int(behind[-1]), dtype=np.uint8)
        digit = np.ones(len(text), dtype=bool)
        digit[behind - 1] = False
        text[behind - 1] = signs
        text[digit] = self.digits.data[taken(self.digits.first[ids], sizes - 1)]
        last = behind[np.cumsum(count_a + count_b) - 1].tolist()
        data = text.tobytes()
        self.texts += [data[s : e - 1] for s, e in zip([0, *last], last, strict=False)]

    def different_pairs(self, own: np.ndarray) -> np.ndarray:
        """The different pairs of a document with these windows."""
        starts, pairs = np.frombuffer(self.starts, dtype=np.int64), np.frombuffer(self.pairs, dtype=np.int64)
        own = np.unique(own)
        return np.unique(pairs[taken(starts[own], starts[own + 1] - starts[own])])

    def summary(self, own: np.ndarray) -> tuple[int, int, str]:
        """Groups, links and the digest of the text form of a document with these windows."""
        groups, links = np.frombuffer(self.groups, dtype=np.int64), np.frombuffer(self.links, dtype=np.int64)
        text = b";".join(map(self.texts.__getitem__, own.tolist()))
        return int(groups[own].sum()), int(links[own].sum()), hashlib.sha256(text).hexdigest()


_DOC = {"doc_id": None, "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string"}
_REST = {
    **{"runs": "long", "windows": "int", "starts": "long", "linked": "int", "times": "int"},
    **{"id_a": "int", "id_b": "int", "held_by": "long"},
}
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def aligned_shards(
    docs: DataFrame, path_a: str, path_b: str, shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """A row per shard: its documents' columns, their windows, the windows' links and the shard's id pairs. Stored.

    ``windows`` has the numbers of all documents' windows, ``runs`` where each document's begin; ``linked`` the
    numbers of each window's pairs, ``times`` how often the window links them, ``starts`` where each window's
    begin; ``id_a``, ``id_b`` the pairs and ``held_by`` how many of the shard's documents link each.
    """
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    kinds = {c: _ARROW.get(k) or to_arrow_type(id_type) for c, k in (_DOC | _REST).items()}

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level_side(path_a), piece_side(path_b)
        shard = first_shard()
        for slices in gathered(batches, shard_bytes, shard_rows):
            seen = Windows(a, b)
            rows: list[tuple] = []
            windows: list[np.ndarray] = []
            pairs: list[np.ndarray] = []
            ids = tokenised((t for s in slices for t in s.column("text").to_pylist()), a, b)
            while together := list(islice(ids, TOGETHER)):
                found = iter(seen.of([d for d in together if d]) if any(together) else ())
                for document in together:
                    own = next(found) if document else np.zeros(0, dtype=np.int64)
                    rows.append((*map(len, document), *seen.summary(own)) if document else (0, 0, 0, 0, ""))
                    windows.append(own)
                    pairs.append(seen.different_pairs(own))
            pair, held_by = np.unique(np.concatenate(pairs), return_counts=True)
            values = dict(zip(list(_DOC)[1:], map(list, zip(*rows, strict=True)), strict=True)) | {
                "doc_id": joined(slices, "doc_id"),
                "runs": np.cumsum([0, *map(len, windows)]),
                "windows": np.concatenate(windows),
                "starts": np.array(seen.starts),
                "linked": np.searchsorted(pair, np.array(seen.pairs, dtype=np.int64)),
                "times": np.array(seen.times, dtype=np.int64),
                "id_a": pair >> 32,
                "id_b": pair & 0xFFFFFFFF,
                "held_by": held_by,
            }
            lists = [one_list(values[c], k) for c, k in kinds.items()]
            yield pa.RecordBatch.from_arrays([pa.array([shard]), *lists], ["shard", *kinds])
            shard += 1

    names = {"doc_id": id_type.simpleString()} | {c: k for c, k in (_DOC | _REST).items() if k}
    schema = ", ".join(["shard long", *[f"{c} array<{k}>" for c, k in names.items()]])
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return stored(texts.mapInArrow(align, schema), rows_together=1)


def pair_counts(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id_a, id_b, documents, best) of the corpus, and (shard, pair, id_a, id_b) of every shard's pairs.

    Both tokenizers' ids bound how many different pairs an id has; a shard gives one row per pair.
    """
    pairs = shards.select("shard", F.posexplode(F.arrays_zip("id_a", "id_b", "held_by")).alias("pair", "p"))
    pairs = pairs.select("shard", "pair", "p.*")
    counts = pairs.groupBy("id_a", "id_b").agg(F.sum("held_by").alias("documents"))
    counts = stored(counts)
    most = counts.groupBy("id_a").agg(F.max("documents").alias("most"))
    counts = counts.join(most, "id_a").select("id_a", "id_b", "documents", (F.col("documents") == F.col("most")).alias("best"))
    return counts, pairs.drop("held_by")


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: tokens of both sides, groups, links, links that are their id's best, and the sum of their counts."""
    shards = aligned_shards(
        docs, path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")
    )
    counts, pairs = pair_counts(shards)
    known = pairs.join(counts, ["id_a", "id_b"]).select(F.col("shard").alias("of"), "pair", "documents", "best")
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    fields = {c: k or id_kind for c, k in _DOC.items()} | {"n_best": "long", "count_sum": "long"}

    def scored(own: pa.Table, numbers: pa.Table) -> pa.Table:
        row = own.combine_chunks()
        lists = {c: row.column(c).chunk(0).flatten() for c in row.column_names if c != "shard"}
        pair = numbers.column("pair").to_numpy()
        runs, windows, starts, linked, times = (
            lists[c].to_numpy() for c in ("runs", "windows", "starts", "linked", "times")
        )

        def of_documents(values: np.ndarray) -> np.ndarray:
            by_pair = np.zeros(len(pair), dtype=np.int64)
            by_pair[pair] = values
            total = np.concatenate(([0], np.cumsum(by_pair[linked] * times)))
            by_window = (total[starts[1:]] - total[starts[:-1]])[windows]
            total = np.concatenate(([0], np.cumsum(by_window)))
            return total[runs[1:]] - total[runs[:-1]]

        best = of_documents(numbers.column("best").to_numpy().astype(np.int64))
        counted = of_documents(numbers.column("documents").to_numpy())
        return pa.table({c: lists[c] for c in _DOC} | {"n_best": best, "count_sum": counted})

    own = shards.select("shard", *_DOC, "runs", "windows", "starts", "linked", "times").groupBy("shard")
    return own.cogroup(known.groupBy("of")).applyInArrow(scored, ", ".join(f"{c} {k}" for c, k in fields.items()))
