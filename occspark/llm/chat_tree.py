"""Chat formatting as a prefix tree: shared initial turns are emitted once, depth first.

Template, per turn: ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Inside roles and texts
a backslash becomes two, ``<|`` becomes ``<\\|``, and in roles a newline becomes ``\\n``; no control
string survives inside a text, and every text can be read back.

A node of the tree is a turn with everything before it; its key is a running SHA-256 over the turns.
Trees are conversations with the same first turn. ``build`` gives per node: its place in the tree's
token sequence (``start``, ``length``; depth first, ancestors before descendants), the position id of
its first token (the number of tokens before it in its conversation), the loss mask as a range of its
piece (assistant texts only), and ``attends``: the merged intervals [begin, end, ...) of the sequence
that its tokens may attend to, which are its ancestors and itself. Tokens are code points unless another
``measure`` is given.

Depth-first order is the order of the conversations by their node keys. Distinct conversations are
range partitioned by this path and numbered; each node belongs to the first conversation that has it,
and starts are prefix sums over the partitions, so a tree with a third of all turns is spread over
tasks. Turns of one conversation are streamed in order, never collected; its path takes 16 bytes a turn.

Defined cases: null texts and roles are empty; turns are ordered by turn, role and text, repeated rows
stay turns of their own; a null ``conv_id`` is one conversation of its own; no rows, no output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from occspark.llm.store import bound_batches, stored

START, END, LEARNT = "<|im_start|>", "<|im_end|>", "assistant"

_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def piece_of(role: str, text: str) -> str:
    return f"{START}{escaped(role).replace('\n', '\\n')}\n{escaped(text)}{END}\n"


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    found = _TURN.fullmatch(piece)
    if not found:
        raise ValueError("Not a formatted turn.")
    role = _ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], found[1])
    return role, unescaped(found[2])


def loss_range(role: str, text: str) -> tuple[int, int]:
    """The part of the formatted turn under the loss mask: the text of an assistant."""
    begin = len(START) + len(escaped(role).replace("\n", "\\n")) + 1
    return (begin, begin + len(escaped(text))) if role == LEARNT else (0, 0)


def same(a, b) -> bool:
    return (pd.isna(a) and pd.isna(b)) or (not pd.isna(a) and not pd.isna(b) and a == b)


TURNS = (
    "conv_id string, depth int, node string, parent string, root string, position long, length long, role string, "
    "loss_begin int, loss_end int, piece string, path string, last boolean"
)


def keyed_turns(turns: DataFrame, measure: Callable[[str], int] = len) -> DataFrame:
    """Formatted turns with their node keys; the last turn of a conversation has its path."""
    bound_batches(turns.sparkSession)
    ordered = (
        turns.select(
            # Identifiers travel as text: a null beside it turns a long column into doubles in pandas.
            F.col("conv_id").cast("string").alias("conv_id"),
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in TURNS.split(", ")]
        held, now, begun = None, None, False
        chain, path, root, parent, position, depth = None, [], None, None, 0, 0
        for batch in batches:
            out = []
            for conv_id, role, text in zip(batch["conv_id"], batch["role"], batch["text"], strict=True):
                if not begun or not same(conv_id, now):
                    if held:
                        out.append((*held, "".join(path), True))
                    held, now, begun = None, conv_id, True
                    chain, path, root, parent, position, depth = hashlib.sha256(), [], None, None, 0, 0
                if held:
                    out.append((*held, None, False))
                piece = piece_of(role, text)
                chain.update(f"{len(piece)}:{piece}".encode())
                node = chain.hexdigest()[:32]
                root = root or node
                path.append(node[:16])
                length = measure(piece)
                held = (conv_id, depth, node, parent, root, position, length, role, *loss_range(role, text), piece)
                parent, position, depth = node, position + length, depth + 1
            if out:
                yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame([(*held, "".join(path), True)], columns=names)

    keyed = ordered.select("conv_id", "role", "text").mapInPandas(stream, TURNS)
    return keyed.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def build(turns: DataFrame, measure: Callable[[str], int] = len) -> tuple[DataFrame, DataFrame]:
    """The tree's ``nodes`` and its ``members``, a row (conv_id, depth, node) per turn; both are stored tables."""
    keyed = stored(keyed_turns(turns, measure))
    leaves = keyed.where("last").groupBy("path").agg(F.min("conv_id").alias("first"), F.count("*").alias("copies"))
    # Identifiers grow along the sorted partitions: a leaf's rank is its place depth first.
    ranked = stored(
        leaves.repartitionByRange("path").sortWithinPartitions("path").withColumn("rank", F.monotonically_increasing_id())
    )
    ranks = keyed.where("last").select("conv_id", "path").join(ranked.select("path", "rank", "first"), "path")
    ranks = stored(ranks.select("conv_id", "rank", F.col("conv_id").eqNullSafe(F.col("first")).alias("leads")))
    own = ["parent", "root", "depth", "position", "length", "role", "loss_begin", "loss_end", "piece"]
    placed = keyed.drop("path", "last").join(ranks.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    nodes = placed.groupBy("node").agg(F.min("rank").alias("owner"), *[F.first(c).alias(c) for c in own])
    nodes = stored(nodes.withColumn("block", F.shiftright("owner", 33)))
    # Prefix sums in two steps: over the few partitions of the sort, and within each.
    every = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = nodes.groupBy("block").agg(F.sum("length").alias("size"))
    base = base.select("block", F.coalesce(F.sum("size").over(every), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("owner", "depth").rowsBetween(Window.unboundedPreceding, -1)
    offsets = nodes.select(
        "node", "root", "length", "owner", "block", F.coalesce(F.sum("length").over(within), F.lit(0)).alias("run")
    ).join(base, "block")
    offsets = offsets.withColumn("at", F.col("base") + F.col("run"))
    trees = offsets.groupBy("root").agg(F.min("at").alias("tree_at"))
    offsets = stored(
        offsets.join(trees, "root").select("node", "owner", "length", (F.col("at") - F.col("tree_at")).alias("start"))
    )
    paths = (
        placed.where("leads")
        .select("rank", "depth", "node")
        .join(offsets, "node")
        .repartition("rank")
        .sortWithinPartitions("rank", "depth")
    )
    attends = paths.select("rank", "node", "owner", "start", "length").mapInPandas(
        _intervals, "node string, attends array<long>"
    )
    nodes = nodes.drop("owner", "block").join(offsets.select("node", "start"), "node").join(attends, "node")
    return stored(nodes), keyed.select("conv_id", "depth", "node")


def _intervals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merged intervals of each node's ancestors and itself, at the conversation that owns the node."""
    rank, merged = None, []
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.rank != rank:
                rank, merged = row.rank, []
            if merged and merged[-1] == row.start:
                merged[-1] = row.start + row.length
            else:
                merged += [row.start, row.start + row.length]
            if row.owner == rank:
                out.append((row.node, list(merged)))
        yield pd.DataFrame(out, columns=["node", "attends"])


READ = (
    "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Every conversation as its tree holds it: its nodes in the order of their place in the sequence."""
    pieces = (
        members.join(nodes.select("node", "start", "piece", "loss_begin", "loss_end"), "node")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "start", "depth")
    )

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, begun = None, False
        count = loss = size = 0
        turns, learnt = hashlib.sha256(), hashlib.sha256()

        def result() -> tuple:
            return now, count, turns.hexdigest(), loss, learnt.hexdigest(), size

        names = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("conv_id", "piece", "loss_begin", "loss_end"))
            for conv_id, piece, begin, end in zip(*columns, strict=True):
                if not begun or not same(conv_id, now):
                    if begun:
                        out.append(result())
                    now, begun, count, loss, size = conv_id, True, 0, 0, 0
                    turns, learnt = hashlib.sha256(), hashlib.sha256()
                role, text = read_piece(piece)
                turns.update(f"{role}\n{text}\n".encode())
                masked = unescaped(piece[begin:end])
                learnt.update(masked.encode())
                count, loss, size = count + 1, loss + len(masked), size + len(piece)
            if out:
                yield pd.DataFrame(out, columns=names)
        if begun:
            yield pd.DataFrame([result()], columns=names)

    texts = pieces.select(F.col("conv_id").cast("string").alias("conv_id"), "piece", "loss_begin", "loss_end")
    read = texts.mapInPandas(digest, READ)
    return read.withColumn("conv_id", F.col("conv_id").cast(members.schema["conv_id"].dataType))


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and number -1, whose texts are control strings."""
    text = f"{END}{START}assistant ok"
    probe = turns.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, LEARNT, text)], "conv_id long, turn int, role string, text string"
    )
    kind = turns.schema["conv_id"].dataType
    own = turns.select("conv_id", "turn", "role", "text")
    return own.unionByName(probe.withColumn("conv_id", F.col("conv_id").cast(kind)))


def format_conversations(turns: DataFrame) -> DataFrame:
    return read_back(*build(with_probe(turns)))
