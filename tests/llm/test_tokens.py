"""Filter audit, byte-level BPE and tokenizer alignment against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from occspark.llm import align, bpe, filter_audit, shards

DOCS = "doc_id long, text string, source string, words string, ids array<int>, shard int"
LARGE = (1 << 53) + 1


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(bpe.tokenizer_path("byte_bpe_50k.tiktoken")), bpe.default_pattern())


@pytest.fixture(scope="module")
def library(codec):
    import tiktoken

    return tiktoken.Encoding("test", pat_str=bpe.default_pattern(), mergeable_ranks=codec.ranks, special_tokens={})


def table(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)


def odd_texts(count: int, seed: int = 3) -> list[str | None]:
    draw = random.Random(seed)
    parts = ["the", "The", " ", "  ", "\n", "\t", "'s", "'", "é", "漢字", "🎉", "12", "$", "▁", "<|endoftext|>", "\x00", " ", "ABC", "ing"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randrange(60))) for _ in range(count)]
    return [None, "", " ", "x", *made]


# Shards


def test_shards_are_bounded_and_keep_every_row():
    texts = ["a" * n for n in (5, 0, 40, 3, 3, 3, 9, 1)] + [None]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + 4], pa.string())}) for i in range(0, len(texts), 4)]
    found = [shards.joined(s, "text").to_pylist() for s in shards.gathered(iter(batches), 10, 3)]
    assert [t for f in found for t in f] == texts
    assert all(len(f) <= 3 and (sum(len(t or "") for t in f) <= 10 or len(f) == 1) for f in found)


# Filter audit


def brute_audit(rows, labels):
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    texts: dict[str, list] = {}
    for i, text, _ in rows:
        texts.setdefault(text or "", []).append(i)
    failed = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        fails += "E" * (i is not None and any(j is not None and j < i for j in texts[text]))
        failed.append((i, source or "", fails))
    out = {}
    for part in {p for _, p, _ in failed}:
        own = [(i, f) for i, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                all_failing = [i for i, f in own if letter in f]
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), len(all_failing) - len(gone), sum(f == letter for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
    shapley = Counter()
    for (part, order, step), values in out.items():
        shapley[part, order[step - 1]] += values[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    draw = random.Random(1)
    bags = [[f"w{i}" for i in range(n)] for n in (5, 60, 500)] + [["W", "a$", "b#", "é"]]
    texts = [" ".join(draw.choice(draw.choice(bags)) for _ in range(draw.randrange(90))) for _ in range(60)]
    rows = [(LARGE + 2 * i, draw.choice(texts), draw.choice(["s", "t", "", None])) for i in range(150)]
    rows += [(None, texts[0], "s"), (None, texts[0], "s"), (LARGE, texts[0], "s"), (3, None, "t"), (1, "", "t"), (2, "\t \n", "u")]
    rows.append((5, " ".join(f"W{i}" for i in range(70)), "u"))
    labels = [(LARGE + 2 * i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 150, 2)]
    labels += [(LARGE, 1, 0), (LARGE, 0, 0), (None, 1, 1)]
    found = filter_audit.audit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in found.collect()}
    assert got == brute_audit(rows, labels)


def test_audit_of_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(table(spark, []), labels).count() == 0


def test_matrix_holds_every_word_count_under_one_number(spark):
    texts = ["b a b", None, "c  a", "a a a d", "é b", ""]
    docs = table(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(3)
    local = filter_audit.local_shards(docs, shard_bytes=6, shard_rows=2)
    terms, dictionary = filter_audit.term_numbers(local)
    word = {r["term"]: r["word"] for r in dictionary.collect()}
    assert sorted(word) == list(range(5)) and sorted(word.values()) == sorted("abcdé")
    seen = {}
    for row in filter_audit.matrix(local, terms).collect():
        for at, doc in enumerate(row["doc_id"]):
            span = slice(row["starts"][at], row["starts"][at + 1])
            assert row["terms"][span] == sorted(row["terms"][span])
            seen[doc] = {word[t]: n for t, n in zip(row["terms"][span], row["counts"][span], strict=True)}
    assert seen == {i: dict(Counter((t or "").split())) for i, t in enumerate(texts)}


def test_words_of_a_long_text_are_counted_by_stretches():
    text = " ".join(f"w{i % 37}" for i in range(500)).encode() + b"x" * 300 + b"\x0b y"
    assert filter_audit.word_counts(text, 50) == Counter(text.split())


# Byte-level BPE


def test_encoding_equals_the_library(codec, library):
    for text in odd_texts(400):
        wanted = library.encode_ordinary(text or "")
        assert codec.encode(text) == wanted
        assert [i for p in codec.splits(text or "", 4) for i in codec.pieces_ids(p)] == wanted
        assert codec.decode(wanted) == (text or "").encode()


def test_every_prefix_has_the_last_token_of_its_encoding(codec):
    piece = "thequickbrownfoxantidisestablishment".encode()
    table = bpe.Prefixes(codec, piece)
    for end in range(1, len(piece) + 1):
        assert table.last[end] == bpe.merged(piece[:end], codec.ranks, codec.never)[-1]


def test_appends_and_edits_give_the_encoding_of_the_new_text(codec, library):
    draw = random.Random(2)
    letters = "abc  '\n\t sr1é漢🎉dl.,t"
    for _ in range(150):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(60)))
        state = bpe.Encoded(codec, text)
        for _ in range(6):
            first = draw.randrange(len(text) + 1)
            past = min(len(text), first + draw.randrange(5))
            new = "".join(draw.choice(letters) for _ in range(draw.randrange(6)))
            if draw.random() < 0.3:
                state.append(new)
                text += new
            else:
                state.replace(first, past, new)
                text = text[:first] + new + text[past:]
            assert state.text == text and state.ids() == library.encode_ordinary(text)


def test_an_edit_computes_only_what_is_near_it(codec, library):
    words = [f"word{i}" for i in range(3_000)]
    state = bpe.Encoded(codec, " ".join(words))
    assert state.replace(9_000, 9_003, "new text") < 12
    assert state.ids() == library.encode_ordinary(state.text)
    piece = bpe.Prefixes(codec, b"abcdefghij" * 2_000)
    assert piece.replace(5_000, 5_001, b"xyz") < 3 * codec.longest
    assert list(piece.ids()) == library.encode_ordinary(piece.data.decode())


def test_round_trip_of_documents(spark, library):
    texts = [*odd_texts(80), "a" * 3_000 + " b" * 3_000]
    rows = [(None if i == 5 else LARGE + 2 * i, t, "s") for i, t in enumerate(texts)]
    rows.append(rows[-1])
    docs = table(spark, rows)
    ids = [library.encode_ordinary(t or "") for _, t, _ in rows]
    digest = lambda data: hashlib.sha256(data).hexdigest()
    wanted = Counter(
        (i, len(x), digest(" ".join(map(str, x)).encode()), digest((t or "").encode())) for (i, t, _), x in zip(rows, ids, strict=True)
    )
    assert Counter(tuple(r) for r in bpe.round_trip(docs).collect()) == wanted
    encoded = bpe.encode_documents(docs)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == Counter(
        (i, tuple(x)) for (i, _, _), x in zip(rows, ids, strict=True)
    )
    back = Counter((r["doc_id"], bytes(r["data"])) for r in bpe.decode_documents(encoded).collect())
    assert back == Counter((i, (t or "").encode()) for i, t, _ in rows)
    assert bpe.round_trip(table(spark, [])).count() == 0


# Alignment


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(bpe.tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=bpe.tokenizer_path("piece_bpe_32k.model"))
    letter = align.byte_of_letter()

    def ends(tokens):
        at, out = 0, []
        for t in tokens:
            at += len(t)
            out.append(at)
        return out

    docs, held = [], Counter()
    for i, text, _ in rows:
        links, groups = [], []
        ids_a = ids_b = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(letter[c] for c in a.id_to_token(x)) for x in ids_a]
            bytes_b = [
                bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b
            ]
            if b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
                ends_a, ends_b = ends(bytes_a), ends(bytes_b)
                shared = sorted(set(ends_a) & set(ends_b))
                for low, high in zip([0, *shared], shared, strict=False):
                    own_a = [x for x, e in zip(ids_a, ends_a, strict=True) if low < e <= high]
                    own_b = [x for x, e in zip(ids_b, ends_b, strict=True) if low < e <= high]
                    groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
                    links += [(x, y) for x in own_a for y in own_b]
            else:
                ids_a = ids_b = []
        held.update(set(links))
        docs.append((i, len(ids_a), len(ids_b), groups, links))
    most: dict[int, int] = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    return Counter(
        (
            i, n_a, n_b, len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
        )
        for i, n_a, n_b, groups, links in docs
    )


def test_alignment_equals_brute_force(spark):
    texts = [*odd_texts(120, 8), "plain words of the text", "plain words of the text", "antidisestablishmentarianism " * 40]
    rows = [(None if i == 7 else LARGE + 2 * i, t, "s") for i, t in enumerate(texts)]
    found = align.alignments(table(spark, rows).repartition(3))
    assert found.columns == [*align._DOC, "n_best", "count_sum"]
    assert Counter(tuple(r) for r in found.collect()) == brute_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    assert align.alignments(table(spark, [])).count() == 0


def test_a_long_text_is_tokenised_as_a_whole():
    a, b = align.byte_level_side(bpe.tokenizer_path("byte_bpe_50k.json")), align.piece_side(bpe.tokenizer_path("piece_bpe_32k.model"))
    text = "".join(t for t in odd_texts(300, 4) if t and "▁" not in t) + "end of it   "
    assert "".join(align.stretches(" " + text, 20)) == " " + text
    (whole,), (parts,) = list(align.tokenised([text], a, b)), list(align.tokenised([text], a, b, size=20))
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]
    both = [text, None, "▁", "short", text + "▁"]
    assert [x is None for x in align.tokenised(both, a, b, size=20)] == [False, True, True, False, True]


def test_windows_are_remembered_by_their_ids():
    a, b = align.byte_level_side(bpe.tokenizer_path("byte_bpe_50k.json")), align.piece_side(bpe.tokenizer_path("piece_bpe_32k.model"))
    seen = align.Windows(a, b)
    ((first, second, third),) = seen.of(list(align.tokenised(["haingthon thntble haingthon"], a, b)))
    assert first == third != second and len(seen.texts) == 2


def row_groups(frame):
    """Rows of each row group of the frame's files."""
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in frame.inputFiles()]
    return [f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]


def test_stored_alignment_shards_are_written_and_read_one_at_a_time(spark):
    docs = table(spark, [(i, f"some words {i}", "web") for i in range(7)]).coalesce(1)
    paths = [align.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    held = align.aligned_shards(docs, *paths, shard_rows=2)
    assert row_groups(held) == [1] * held.count() == [1] * 4


def test_stored_matrix_shards_are_written_and_read_one_at_a_time(spark):
    docs = table(spark, [(i, f"some words {i}", "web") for i in range(7)]).coalesce(1)
    held = filter_audit.local_shards(docs, shard_rows=2)
    assert row_groups(held) == [1] * held.count() == [1] * 4
