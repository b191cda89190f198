"""Each operator against a brute-force version, and its defined cases: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from occspark.llm import (
    buckets,
    chat_tree,
    decontaminate,
    embedding_dedup,
    graph,
    langid,
    mixing,
    secrets,
    simhash,
    token_files,
    toxicity,
    warc,
    words,
)
from occspark.llm.store import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")


def documents(spark, rows):
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
    return spark.createDataFrame(rows, DOCS)


def prose(seed: int, length: int, vocabulary: int = 500) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(length))


# Words


def test_blocks_keep_every_run_of_words_of_a_long_text():
    text = " ".join(f"w{i}" for i in range(3_000)) + "  \n end"
    offsets, data = words.utf8(pa.array(["short one", text, None, ""]))
    found = []
    for block in words.blocks(offsets, data, words.SPACES, 2, limit=700):
        w = words.words(block, words.SPACES)
        heads, rows = w.shingles(3)
        joined = w.data.tobytes()
        found += [(int(block.rows[r]), joined[w.starts[h] : w.ends[h + 2]].decode()) for h, r in zip(heads, rows, strict=True)]
    split = text.split()
    assert found == [(1, " ".join(split[i : i + 3])) for i in range(len(split) - 2)]


def test_hashes_of_words_depend_on_the_word_alone():
    offsets, data = words.utf8(pa.array(["ab  cd", "cd ab", "ab"]))
    (block,) = words.blocks(offsets, data, words.SPACES, 0)
    h = words.words(block, words.SPACES).hashes()
    assert h[0] == h[3] == h[4] and h[1] == h[2] and h[0] != h[1]


# Components


def test_components_of_a_chain_a_star_and_noise(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame(chain + star + star + [(5, 5), (140, 7)], "a long, b long")
    found = {r["vertex"]: r["root"] for r in graph.components(edges).collect()}
    assert set(found.values()) == {7} and len(found) == 41 + 60 + 1


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_buckets_meet_every_pair_once(spark):
    rows = spark.range(60).selectExpr("if(id < 45, 1, id) AS bucket", "id AS item")

    def pairs(batches):
        for frame, group in buckets.runs(batches, 10):
            for _, own in frame.groupby(group):
                within = (own["part_a"] == own["part_b"]).iloc[0]
                items = list(zip(own["item"], own["part"], strict=True))
                found = [(a, b) for k, (a, p) in enumerate(items) for b, q in items[k + 1 :] if within or p != q]
                yield pd.DataFrame(found, columns=["a", "b"])

    found = buckets.bucketed(rows, "item", part_rows=10).select("bucket", "part_a", "part_b", "part", "item")
    met = sorted(tuple(sorted((r["a"], r["b"]))) for r in found.mapInPandas(pairs, "a long, b long").collect())
    assert met == [(a, b) for a in range(45) for b in range(a + 1, 45)]


# 1 Toxicity


def test_toxicity_learns_and_gives_exact_neighbours(spark):
    draw = random.Random(1)
    rows = []
    for i in range(400):
        own = [f"w{draw.randrange(400)}" for _ in range(30)]
        if i % 4 == 0:
            own[3:3] = ["Vile", draw.choice(["vilest", "grim"])]
        rows.append((i, " ".join(own), "en", "s"))
    rows += [(900, None, None, None), (901, "", "en", None), (902, "vile grim " * 3, None, "s"), (902, "vile grim " * 3, None, "s")]
    docs = documents(spark, rows).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (5, 1, None), (77777, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    found = toxicity.score(docs, labels).toPandas()
    assert len(found) == len(rows)
    known = found[(found.doc_id < 400) & found.held_out]
    assert ((known.doc_id % 4 == 0).astype(int) == known.predicted).mean() > 0.95
    assert found[found.doc_id == 902].predicted.tolist() == [1, 1]
    assert (found[found.doc_id.isin([900, 901])].score < 0.5).all() and found.score.between(0, 1).all()


def test_block_max_search_equals_brute_force():
    draw = np.random.default_rng(4)
    examples, terms = 500, 60
    dense = draw.integers(1, 4, (examples, terms)) * (draw.random((examples, terms)) < 0.1)
    dense[7] = dense[3]
    row, term = np.nonzero(dense)
    toxic = draw.integers(0, 2, examples)
    index = toxicity.build(
        np.arange(terms, dtype=np.uint64), draw.integers(1, 50, terms).astype(float), 1_000,
        row, term, dense[row, term], np.arange(examples), toxic, 0.5,
    )
    weights = np.zeros((examples, terms))
    weights[row, term] = index.vectors(row, term, dense[row, term], examples)
    for at in range(0, examples, 9):
        t = np.flatnonzero(weights[at])
        best, cosines = index.nearest(t, weights[at, t])
        brute = weights @ weights[at]
        order = np.lexsort((np.arange(examples), -np.round(brute, 12)))[: len(best)]
        assert np.allclose(np.sort(brute[order])[::-1], cosines) and len(best) == min(toxicity.NEAREST, (brute > 0).sum())


def test_toxic_near_copies_are_found_by_words_no_label_depends_on(spark):
    rows = [(i, " ".join(f"r{i}x{k}" for k in range(40)) + " the", "en", "s") for i in range(200)]
    rows += [(1_000 + i, rows[i][1].replace("x3 ", "y3 "), "en", "s") for i in range(200)]
    rows += [(2_000, "the", "en", "s"), (2_001, "never seen", "en", "s")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    found = toxicity.score(documents(spark, rows), labels).toPandas().set_index("doc_id")
    learnt = [i for i in range(200) if not found.held_out[i]]
    assert learnt
    for i in learnt:
        first = found.evidence[1_000 + i][0]
        assert first["doc_id"] == i and first["toxic"] == int(i % 4 == 0) and 0.9 < first["cosine"] < 1
    assert len(found.evidence[2_000]) == 3 and len(found.evidence[2_001]) == 0


def test_search_over_rare_and_common_words_equals_brute_force():
    draw = np.random.default_rng(14)
    examples, terms = 400, 900
    dense = draw.integers(1, 4, (examples, terms)) * (draw.random((examples, terms)) < draw.choice([0.005, 0.03, 0.3], terms))
    dense[7] = dense[3]
    row, term = np.nonzero(dense)
    index = toxicity.build(
        np.arange(terms, dtype=np.uint64), draw.integers(1, 50, terms).astype(float), 1_000,
        row, term, dense[row, term], np.arange(examples), draw.integers(0, 2, examples), 0.5,
    )
    assert 0 < len(index.dense) < terms and len(index.examples)
    weights = np.zeros((examples, terms))
    weights[row, term] = index.vectors(row, term, dense[row, term], examples)
    for at in range(0, examples, 7):
        t = np.flatnonzero(weights[at])
        best, cosines = index.nearest(t, weights[at, t], without=at)
        brute = np.round(weights @ weights[at], 12)
        brute[at] = 0
        order = np.lexsort((np.arange(examples), -brute))[: toxicity.NEAREST]
        assert np.allclose(brute[order], cosines) and (np.diff(best)[np.diff(cosines) == 0] > 0).all()


def test_toxicity_without_labels(spark):
    docs = documents(spark, [(1, "a b", None, None)])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.score(docs, labels).collect()] == [(0.0, 0)]
    assert toxicity.score(docs.limit(0), labels).count() == 0


# 2 Embeddings


def test_embedding_links_equal_brute_force(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(150, 32))
    near = base[:60] + 0.08 * draw.normal(size=(60, 32))
    vectors = [*base.tolist(), *near.tolist(), *([base[0].tolist()] * 30)]
    rows = list(enumerate(vectors)) + [
        (500, None), (501, []), (502, [0.0] * 32), (503, [None] + [1.0] * 31), (504, [float("nan")] * 32),
        (505, [float("inf")] + [1.0] * 31), (506, base[0][:16].tolist()), (507, (2 * base[1]).tolist()),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS kept")
    found = embedding_dedup.near_duplicates(frame).toPandas().sort_values("vec_id").set_index("vec_id")
    usable = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows if i < 500 or i == 507}
    ids = list(usable)
    unit = np.stack([usable[i] / np.linalg.norm(usable[i]) for i in ids])
    linked = (unit @ unit.T >= 0.9) & ~np.eye(len(ids), dtype=bool)
    got = found.loc[ids]
    assert got.n_links.sum() >= 0.99 * linked.sum() and (got.n_links.to_numpy() <= linked.sum(axis=1)).all()
    assert (found.loc[[500, 501, 502, 503, 504, 505, 506]].n_links == 0).all()
    assert found.loc[500:506].kept.all() and found.loc[0].n_links >= 30 and found.loc[507].component_id == 1


def test_recall_at_the_threshold():
    draw = np.random.default_rng(3)
    a = embedding_dedup.units(draw.normal(size=(2_000, 64)))
    b = draw.normal(size=a.shape)
    b = embedding_dedup.units(b - np.einsum("ij,ij->i", a, b)[:, None] * a)
    keys = [embedding_dedup.probed_buckets(x) for x in (a, 0.9 * a + math.sqrt(0.19) * b)]
    assert np.mean([np.isin(x, y).any() for x, y in zip(*keys, strict=True)]) > 0.98


def test_no_embeddings(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# 3 SimHash


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition():
    texts = ["AaÉ b\tC d", None, "", " \n", "one", "One two", prose(1, 900), "a b c " * 700, " x y z w"]
    assert simhash.fingerprints_of(pa.array(texts)).tolist() == [plain_fingerprint(t) for t in texts]


def test_simhash_groups_equal_brute_force(spark):
    rows = []
    for i in range(60):
        text = prose(i % 30, 400)
        if i >= 30:
            text = text.replace("w1 ", "w1x ", 1)
        rows.append((i, text, "en", "s"))
    rows += [(70, None, None, None), (71, "", "en", "s"), (72, prose(3, 400), "en", "s"), (72, prose(3, 400), "en", "s")]
    rows += [(None, prose(1, 400), "en", "s"), (None, "alone", "en", "s")]
    docs = documents(spark, rows).selectExpr("*", "1 AS fp", "2 AS component_id")
    found = simhash.near_duplicates(docs.select("doc_id", "text")).toPandas()
    prints = [plain_fingerprint(t) for _, t, _, _ in rows]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(rows))]
    least = {}
    for (i, *_), root in zip(rows, label, strict=True):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    want = sorted((-1 if i is None else i, f"{p:016x}", least.get(r, -1)) for (i, *_), p, r in zip(rows, prints, label, strict=True))
    assert sorted(found.fillna(-1).itertuples(index=False, name=None)) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted([-1, *least.values()])


def test_one_row_of_each_group_stays_if_identifiers_name_different_texts(spark):
    x, y, z = (prose(100 + k, 300) for k in range(3))
    # Identifier 5 leads Y's group and is a follower in X's, which 3 leads; 6 leads nothing; null and 7 lead by themselves.
    rows = [(5, x), (3, x), (5, y), (6, y), (5, z), (5, z), (7, "alone"), (7, "other one"), (None, "no name"), (None, "no name")]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    kept = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["text"]) for r in simhash.keep_one(docs).collect())
    assert kept == sorted([(3, x), (5, y), (5, z), (7, "alone"), (7, "other one"), (-1, "no name")])


def test_pivot_filter_loses_no_pair():
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in draw.choice(64, k, replace=False)) for k in range(6) for _ in range(5)]
    fp = np.unique(np.concatenate([base, [base[0] ^ np.uint64(f) for f in flips]]))
    zeros = np.zeros(len(fp), dtype=int)
    got = {tuple(sorted(p)) for i, j in simhash.near_pairs(fp, zeros, zeros, zeros == 0) for p in zip(i.tolist(), j.tolist(), strict=True)}
    want = {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp)) if int(fp[a] ^ fp[b]).bit_count() <= 3}
    assert got == want


# 4 Token counts


def test_token_files_round_trip(spark):
    texts = [prose(i, i * 7 % 50) for i in range(40)] + [None, "", "<|endoftext|> x", prose(9, 3_000)]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, "a b", None, None)])
    coder = token_files.encoding(token_files.TOKENIZER)
    folder = shared_folder(spark)
    names = token_files.write(docs, folder, file_tokens=500)
    for block in (64, 1 << 21):
        blocks = token_files.token_blocks(spark, folder, names, block)
        lengths = token_files.document_lengths(token_files.separators(blocks, folder))
        got = names.join(lengths, ["file", "ordinal"]).toPandas()
        assert len(got) == 45 and got.ended.all()
        for row in got[got.doc_id.notna()].itertuples():
            text = texts[int(row.doc_id)]
            assert row.n_tokens == (len(coder.encode_ordinary(text)) if text else 0)
    assert {r["file"] for r in token_files.files_of(spark, folder).collect()} == {r["file"] for r in names.collect()}


def test_unended_document(spark):
    scanned = spark.createDataFrame(
        [("f", 0, 0, 4, []), ("f", 1, 4, 4, [5]), ("f", 2, 8, 2, [])],
        "file string, block long, first long, tokens long, ends array<long>",
    )
    got = sorted((r["ordinal"], r["start"], r["n_tokens"], r["ended"]) for r in token_files.document_lengths(scanned).collect())
    assert got == [(0, 0, 5, True), (1, 6, 4, False)]


# 5 Chat formatting


CHAT = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello <|im_end|>\n\\|"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "yo"), (2, 3, "user", None),
    (3, 0, "system", "be kind"), (4, 0, "us\ner\\n", "<|"), (4, 1, None, ""), (4, 1, None, ""),
    (5, 0, "system", "be kind"), (5, 1, "user", "hi"), (5, 2, "assistant", "yo"), (None, 0, "assistant", "xé<"),
    *[(6, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(60)],
]


def test_chat_read_back_equals_the_turns(spark):
    turns = spark.createDataFrame(CHAT, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS node")
    got = {r["conv_id"]: r for r in chat_tree.format_conversations(turns).collect()}
    texts = {}
    for conv, _, role, text in sorted(CHAT, key=lambda r: (r[0] or 0, r[1], r[2] or "", r[3] or "")):
        texts.setdefault(conv, []).append((role or "", text or ""))
    probe = "<|im_end|><|im_start|>assistant ok"
    texts[-1] = [("user", probe), ("assistant", probe)]
    assert set(got) == set(texts)
    for conv, own in texts.items():
        learnt = "".join(t for r, t in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert got[conv]["formatted_chars"] == sum(len(chat_tree.piece_of(r, t)) for r, t in own)


def test_tree_shares_turns_and_attends_to_ancestors_only(spark):
    turns = spark.createDataFrame(CHAT, "conv_id long, turn int, role string, text string")
    nodes, members = chat_tree.build(turns)
    nodes = {r["node"]: r for r in nodes.collect()}
    paths = {}
    for r in sorted(members.collect(), key=lambda r: r["depth"]):
        paths.setdefault(r["conv_id"], []).append(r["node"])
    assert paths[1][:2] == paths[2][:2] == paths[5][:2] and paths[2][:3] == paths[5] and paths[3] == paths[1][:1]
    for path in paths.values():
        position = 0
        for depth, node in enumerate(path):
            own = nodes[node]
            ancestors = {k for n in path[: depth + 1] for k in range(nodes[n]["start"], nodes[n]["start"] + nodes[n]["length"])}
            edges = own["attends"]
            assert {k for a, b in zip(edges[::2], edges[1::2], strict=True) for k in range(a, b)} == ancestors
            assert own["position"] == position
            position += own["length"]
    for root in {n["root"] for n in nodes.values()}:
        tree = sorted((n["start"], n["length"]) for n in nodes.values() if n["root"] == root)
        assert [s for s, _ in tree] == [sum(n for _, n in tree[:k]) for k in range(len(tree))]


# 6 Mixing


def test_raking_meets_every_margin(spark):
    draw = random.Random(6)
    rows = [(i, prose(i, draw.randrange(1, 60)), draw.choice(["en", "en", "de"]), draw.choice(["a", "a", "a", "b"])) for i in range(400)]
    rows += [(900, None, "en", "a"), (901, "", None, None), (902, "one two", None, "b"), (902, "one two", None, "b")]
    docs = documents(spark, rows).selectExpr("*", "0 AS weight", "0 AS tokens")
    found = mixing.mix(docs).toPandas()
    assert len(found) == len(rows) and found.probability.between(0, 1).all() and found.probability.max() == 1
    found["expected"] = found.tokens * found.probability
    for margin in ("source", "lang", "topic"):
        share = found.groupby(margin, dropna=False).tokens.sum() ** 0.7
        got = found.groupby(margin, dropna=False).expected.sum()
        assert np.allclose(share / share.sum(), got / got.sum(), atol=1e-5)
    sample = mixing.sample(docs)
    assert sample.columns == docs.columns
    assert sorted(r["doc_id"] for r in sample.collect()) == sorted(found[found.kept].doc_id)


def test_fitted_weights_equal_a_plain_loop(spark):
    cells = pd.DataFrame({"a": ["x", "x", "y", "y"], "b": ["p", "q", "p", "q"], "tokens": [40, 10, 20, 30]})
    targets = {
        "a": spark.createDataFrame([("x", 0.3), ("y", 0.7)], "a string, share double"),
        "b": spark.createDataFrame([("p", 0.5), ("q", 0.5)], "b string, share double"),
    }
    got = mixing.rake(spark.createDataFrame(cells), ["a", "b"], targets).toPandas().sort_values(["a", "b"]).weight
    table = np.array([[40.0, 10.0], [20.0, 30.0]])
    for _ in range(200):
        table *= (np.array([30, 70]) / table.sum(axis=1))[:, None]
        table *= np.array([50, 50]) / table.sum(axis=0)
    assert np.allclose(got, table.ravel(), rtol=1e-5)


def test_one_stray_document_drops_no_others(spark):
    # One topic each, so that only the language's margin is uneven.
    rows = [(i, f"plain words number {i % 7}", "en" if i % 5 else "de", "s") for i in range(1_000)] + [(5_000, "plain words number 3", "xx", "s")]
    docs = documents(spark, rows)
    found = mixing.mix(docs, budget=1.0).toPandas()
    tokens = found.tokens.sum()
    # A hash decides about fractions: within five standard deviations of the draw.
    assert abs((found.tokens * found.draws).sum() - tokens) < 5 * found.tokens.max() * len(found) ** 0.5 / 2
    share = found.groupby("lang").tokens.sum() ** 0.7
    got = (found.tokens * found.weight).groupby(found.lang).sum() / tokens
    assert np.allclose(share / share.sum(), got, atol=1e-5)
    assert found.draws[found.doc_id == 5_000].item() > 1 and (found.kept == (found.draws > 0)).all()
    drawn = mixing.sample(docs, budget=1.0)
    want = found.doc_id.repeat(found.draws)
    assert drawn.columns == docs.columns and sorted(r["doc_id"] for r in drawn.collect()) == sorted(want)
    # Without a budget, the stray document sets the size of the whole sample.
    assert mixing.mix(docs).where("kept").count() < 300 < (found.draws > 0).sum()


def test_mixing_nothing(spark):
    assert mixing.sample(documents(spark, [])).count() == 0


# 7 WARC


def test_archives_read_back(spark):
    big, small = "bé" * 800, "tiny"
    rows = [(1, "u1", big), (2, "u2", big), (9, None, big), (3, "u\r\n3", small), (4, "u4", small), (5, "u5", None), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert len(got) == 7
    for page_id, _, html in rows:
        payload = (html or "").encode()
        assert (got[page_id]["payload_bytes"], got[page_id]["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        kind = ("revisit", 9) if html == big and page_id != 9 else ("response", None)
        assert (got[page_id]["record_type"], got[page_id]["refers_to"]) == kind


def test_selected_records_over_small_files_and_reads(spark):
    pages = spark.createDataFrame([(i, f"u{i}", prose(i, 300)) for i in range(30)], "page_id long, url string, html string")
    folder = shared_folder(spark)
    index = warc.write(pages, folder, archive_bytes=4_000)
    some = index.where("page_id % 3 = 0")
    got = {r["page_id"]: r["payload"] for r in warc.read(some, folder, read_bytes=2_000, gap_bytes=100).collect()}
    assert got == {i: prose(i, 300).encode() for i in range(0, 30, 3)}


def test_reads_are_coalesced():
    offsets, lengths = np.array([0, 10, 25, 100]), np.array([10, 10, 5, 5])
    assert warc.ranges(offsets, lengths, 5, 1_000) == [(0, 3), (3, 4)]
    assert warc.ranges(offsets, lengths, 5, 20) == [(0, 2), (2, 3), (3, 4)]


# 8 Decontamination


def test_containment_equals_brute_force(spark):
    items = [(i, prose(1_000 + i, 8 + i)) for i in range(30)] + [(50, None), (51, "!!"), (52, "Solo words"), (53, "a b c d e")]
    draw = random.Random(8)
    texts = []
    for i in range(60):
        own = prose(i, 200).split()
        copy = items[i % 30][1].split()
        if i % 3 == 1:
            copy[len(copy) // 2] = "changed"
        elif i % 3 == 2:
            copy = copy[:-1]
        own[draw.randrange(190):0] = copy
        texts.append("; ".join(own).upper() if i % 2 else " ".join(own))
    texts += [None, "", "x solo, WORDS y", "a-b c.d\te", prose(3, 200) + " " + prose(1_004, 12)]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)] + [(7, texts[0], None, None)])
    items_frame = spark.createDataFrame(items, "item_id int, text string").selectExpr("*", "0 AS doc_id")

    def shingles(text, size=5):
        own = re.findall(r"[0-9a-z\u0080-￿]+", (text or "").lower())
        return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if len(own) >= size else ({tuple(own)} if own else set())

    want = set()
    rows = [*enumerate(texts), (7, texts[0])]
    for doc_id, text in rows:
        for item_id, item in items:
            own = shingles(item)
            sizes = {len(s) for s in own}
            there = set().union(*[shingles(text, k) for k in sizes]) if own else set()
            if own and len(own & there) >= 0.8 * len(own) - 1e-12:
                want.add((doc_id, item_id, round(len(own & there) / len(own), 9)))
    got = {(r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in decontaminate.find(docs, items_frame).collect()}
    assert got == want and len(want) > 30
    clean = decontaminate.keep_clean(docs, items_frame)
    assert clean.columns == docs.columns
    # One of the two rows named 7 is clean.
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {i for i, _, _ in want if i != 7}


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(i, 20)) for i in range(20)], "item_id long, text string")
    docs = documents(spark, [(i, prose(i, 20) + " tail", None, None) for i in range(25)])
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (50,))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, items).collect()} == {(i, i) for i in range(20)}


# 9 Secrets


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    assign = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    data, found = text.encode(), []
    rules = [(assign, lambda m: len(m[2]) >= 6), (re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), (re.compile(rb"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    for kind, (rule, good) in enumerate(rules):
        for m in rule.finditer(data):
            if good(m):
                found.append((len(data[: m.start()].decode()), kind, len(data[: m.end()].decode())))
    return sorted(found)


@pytest.mark.parametrize("piece", [1 << 22, 300])
def test_secret_spans_equal_regexes(monkeypatch, piece):
    monkeypatch.setattr(secrets, "_PIECE", piece)
    draw = random.Random(9)
    parts = ["password", "PassWD", "secret", "token", "api_key", "APIkey", "=", ":", " ", "  ", "'", '"', "abc", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "é", "\n", "x", "_", "0123456789abcdef"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(60))) for _ in range(600)] + ["", None, "token=token: abcdefgh", "ab" * 3_000]
    got = secrets.spans_of(*words.utf8(pa.array(texts)))
    assert [[s for s in own if s[1] < 3] for own in got] == [plain_spans(t or "") for t in texts]


def test_further_kinds_and_redaction(spark):
    forge, chat = "ghp_" + "a1B2" * 9, "xoxb-1234567890-abc"
    text = f"é {forge} and {chat}; password = 'hunter22' -----BEGIN RSA PRIVATE KEY----- end"
    docs = documents(spark, [(1, text, "en", "s"), (2, "clean", "en", "s"), (3, None, None, None), (1, text, "en", "s")])
    got = secrets.scan(docs).toPandas()
    assert got.spans.str.count("forge:|chat:|private_key:|assign:").tolist()[0] == 4 and got.n_assign.tolist() == [1, 0, 0, 1]
    assert got.base_sha256[1] == got.base_sha256[2] == hashlib.sha256(b"").hexdigest()
    red = secrets.redact(docs.selectExpr("*", "1 AS _redacted"))
    assert red.columns == [*docs.columns, "_redacted"]
    rows = red.collect()
    assert rows[0]["text"] == "é [forge] and [chat]; [assign]' [private_key] end" and rows[0]["n_chars"] == len(rows[0]["text"])
    assert rows[1]["text"] == "clean" and rows[2]["text"] is None


# 10 Languages


def test_languages_are_learnt_and_calibrated(spark):
    alphabets = {"aa": "abcdef", "bb": "ghijkl", "cc": "abghéñ"}
    draw = random.Random(10)
    rows = []
    for i in range(300):
        lang = draw.choice(list(alphabets))
        rows.append((i, " ".join("".join(draw.choices(alphabets[lang], k=draw.randrange(2, 7))) for _ in range(draw.randrange(3, 60))), lang, "s"))
    rows += [(900, None, "aa", None), (901, "", None, None), (902, "123 !?", "bb", "s"), (903, "abcdef " * 20, None, "s"), (None, "ghij kl", "bb", "s")]
    docs = documents(spark, rows).selectExpr("*", "'x' AS lang_pred", "'y' AS label")
    got = langid.identify(docs).toPandas()
    answers = {i: lang for i, _, lang, _ in rows}
    known = got[got.held_out & (got.doc_id < 300)]
    assert (known.lang_pred == known.doc_id.map(answers)).mean() > 0.95 and len(got) == len(rows)
    assert got[got.doc_id.isin([900, 901, 902])].lang_pred.eq("und").all() and got[got.doc_id == 903].lang_pred.tolist() == ["aa"]
    assert got.score.between(0, 1).all()
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and {900, 901, 902}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert kept.count() >= 290


def test_ngram_counts_do_not_depend_on_the_cut(monkeypatch):
    text = prose(5, 400) + " Éß"
    whole = langid.bucket_counts(text)
    monkeypatch.setattr(langid, "_CODE_POINTS", 100)
    assert np.array_equal(whole, langid.bucket_counts(text)) and whole.sum() == 3 * len(text) - 3


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "abc", None, None), (2, None, None, None)])
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()} == {("und", 0.0)}
    assert langid.identify(docs.limit(0)).count() == 0


# Identifiers, clashing names and other defined cases


LARGE = 1 << 53


def test_large_identifiers_stay_exact_beside_a_null(spark):
    ids = [LARGE + 1, LARGE + 3, None, LARGE + 2]
    docs = spark.createDataFrame([(i, "a b " * (n + 1)) for n, i in enumerate(ids)], "doc_id long, text string").coalesce(1)
    counted = {r["doc_id"] for r in token_files.count_tokens(docs).collect()}
    assert counted == set(ids)
    turns = spark.createDataFrame([(i, 0, "user", f"say {i}") for i in ids], "conv_id long, turn int, role string, text string")
    found = {r["conv_id"]: r["n_turns"] for r in chat_tree.format_conversations(turns.coalesce(1)).collect()}
    assert found == {-1: 2} | dict.fromkeys(ids, 1)
    html = "x" * 2_000
    pages = spark.createDataFrame([(i, "u", html) for i in ids] + [(LARGE + 9, "u", "y")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.round_trip(pages.coalesce(1)).collect()}
    revisit = ("revisit", LARGE + 3)
    assert got == {None: revisit, LARGE + 1: revisit, LARGE + 2: revisit, LARGE + 3: ("response", None), LARGE + 9: ("response", None)}


def test_identifiers_may_be_text(spark):
    docs = spark.createDataFrame([("a-1", "x y"), (None, "z")], "doc_id string, text string")
    assert {(r["doc_id"]) for r in token_files.count_tokens(docs).collect()} == {"a-1", None}
    pages = spark.createDataFrame([("p", "u", "h" * 1_500), ("q", "u", "h" * 1_500)], "page_id string, url string, html string")
    assert {(r["page_id"], r["refers_to"]) for r in warc.round_trip(pages).collect()} == {("p", "q"), ("q", None)}


def test_empty_tables(spark):
    docs = documents(spark, [])
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert token_files.count_tokens(docs).count() == 0
    assert simhash.near_duplicates(docs.select("doc_id", "text")).count() == 0
    assert secrets.scan(docs).count() == 0
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert decontaminate.find(docs, items).count() == 0
    assert decontaminate.find(documents(spark, [(1, "a b c d e f", "x", "y")]), items.limit(0)).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert [r["conv_id"] for r in chat_tree.format_conversations(turns).collect()] == [-1]


def test_columns_named_like_the_operators_own(spark):
    rows = [(i, prose(i % 3, 40), "de", "s") for i in range(6)]
    docs = documents(spark, rows)
    for name in ("_idl", "_fpl", "_root", "_first_id", "_first_fp", "_doc_idc", "_doc_id_drawn", "_draw", "_number", "_leak"):
        docs = docs.withColumn(name, F.lit(1))
    assert simhash.keep_one(docs).columns == docs.columns and simhash.keep_one(docs).count() == 3
    drawn = mixing.sample(docs, budget=1.0)
    assert drawn.columns == docs.columns and drawn.count() > 0
    items = spark.createDataFrame([(1, prose(0, 40))], "item_id long, text string")
    assert decontaminate.keep_clean(docs, items).columns == docs.columns


def test_more_labels_than_languages_are_learnt(spark):
    rows = [(i, f"wort und satz {i}", "de") for i in range(40)] + [(100 + i, f"word and line {i}", "en") for i in range(40)]
    rows += [(1_000 + i, f"zz{i} qq", f"dirt{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, max_languages=2)
    assert model.languages == ["de", "en"]
    with_all = langid.fit(docs)
    assert len(with_all.languages) == 32


def test_what_default_targets_miss_with_structural_zeros_is_returned(spark):
    rows = [("A", "de", 500), ("B", "de", 200), ("C", "en", 300)]
    cells = spark.createDataFrame(rows, "source string, lang string, tokens long")
    assert mixing.rake(cells, ["source", "lang"], sweeps=6).first()["deviation"] > 0.01
    full = spark.createDataFrame([*rows, ("A", "en", 400), ("B", "en", 300), ("C", "de", 350)], cells.schema)
    assert mixing.rake(full, ["source", "lang"]).first()["deviation"] <= mixing.TOLERANCE


def test_what_contradicting_targets_miss_is_returned(spark):
    cells = spark.createDataFrame([("A", "de", 500), ("C", "en", 500)], "source string, lang string, tokens long")
    targets = {
        "source": spark.createDataFrame([("A", 0.9), ("C", 0.1)], "source string, share double"),
        "lang": spark.createDataFrame([("de", 0.5), ("en", 0.5)], "lang string, share double"),
    }
    assert mixing.rake(cells, ["source", "lang"], targets, sweeps=4).first()["deviation"] > 0.1


def test_only_rows_with_a_signature_hash_are_verified():
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    texts = [f"{prose(i, 300)} {' '.join(item.split()[3:8])} {prose(i + 50, 300)}" for i in range(20)] + [f"a {item} b", None, ""]
    index = decontaminate.build([item], 0.8)
    column = pa.array(texts, pa.string())
    met = decontaminate.candidates(index, column)
    assert 20 in met and len(met) < len(texts)
    assert [(r, i) for r, i, _ in decontaminate.contained(index, column)] == [(20, 0)]


def test_copies_of_an_item_are_one_text_of_a_block(spark):
    item = "one two three four five six seven"
    items = spark.createDataFrame([(i, item) for i in range(50)] + [(99, None)], "item_id long, text string")
    assert list(decontaminate.item_blocks(items)) == [[item]]
    docs = documents(spark, [(1, f"x {item} y", "a", "b")])
    assert {r["item_id"] for r in decontaminate.find(docs, items).collect()} == set(range(50))
