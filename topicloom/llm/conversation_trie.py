"""The trie of shared openings of conversations, its totals by parallel tree contraction.

A node stands for the conversations that start with the same turns. Its identity is a
chain of SHA-256 digests over those turns, taken in chunks of bounded length, so a
conversation of any length is spread over tasks.

Totals of all subtrees come from rounds of joins, about log2(nodes) of them:

* compress: in every unary chain each node learns, by doubling its pointer, the node at
  the chain's end and the sum up to it. The end then hangs on the node above the chain;
* rake: all leaves give their totals to their parents and go.

No chain is left after a compress, so at least half of the nodes are leaves and go. When
only the root remains, the chains' nodes are expanded in reverse order: a node's total is
its chain's sum plus the total of the chain's end, known by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ordinal
from ..session import cut, cut_with

CHUNK = 64       # digests chained in one row
LISTED = 4096    # ids joined in one row
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def ordered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv, idx, digest, n_bytes): the turns of each conversation, numbered from 0.

    Turns go by their number, null first; of equal numbers by the digest of role and text.
    Null role and text are empty. Rows without conversation belong to none and are left
    out; rows that repeat are turns of their own; other columns are not read. ``n_bytes``
    is the length of the text in UTF-8. Long conversations are numbered by range
    partitions, not in one task.
    """
    said = F.coalesce(F.col(role).cast("string"), F.lit(""))
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.sha2(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, content), 256)
        .alias("digest"),
        F.octet_length(content).cast("bigint").alias("n_bytes"))
    numbered = ordinal(rows, ["conv", "turn", "digest"], "at")
    first = numbered.groupBy("conv").agg(F.min("at").alias("first"))
    return numbered.join(first, "conv").select(
        "conv", (F.col("at") - F.col("first")).alias("idx"), "digest", "n_bytes")


def _chained(turns: DataFrame, *more: str) -> DataFrame:
    """(conv, idx, prev, chain, more...): ``chain`` is a digest of the digests of turns 0 to
    idx, ``prev`` of those before idx, empty for none. Indexes run from 0 without gaps."""
    row = F.struct("idx", "digest", *more)
    kinds = dict(turns.dtypes)
    held = ", ".join(f"{c}: {kinds[c]}" for c in ("idx", *more))

    def add(acc, x):
        prev = F.coalesce(F.try_element_at(acc, F.lit(-1))["chain"], F.lit(""))
        return F.concat(acc, F.array(F.struct(
            x["idx"].alias("idx"), *[x[c].alias(c) for c in more], prev.alias("prev"),
            F.sha2(F.concat(prev, x["digest"]), 256).alias("chain"))))
    links = F.aggregate(F.array_sort(F.collect_list(row)),
                        F.array().cast(f"array<struct<{held}, prev: string, chain: string>>"), add)
    chunks, seen = cut_with(turns.withColumn("chunk", F.expr(f"idx div {CHUNK}"))
                            .groupBy("conv", "chunk").agg(links.alias("links")), "chunks",
                            last=F.max("chunk"))
    flat = chunks.select("conv", "chunk", F.inline("links"))
    if not seen["last"]:
        return flat.drop("chunk")
    last = F.element_at("links", -1)["chain"]
    above = _chained(chunks.select("conv", F.col("chunk").alias("idx"), last.alias("digest"),
                                   last.alias("own")), "own")
    # ``first`` is the chain of the last index of the chunk before.
    before = above.select("conv", (F.col("idx") + 1).alias("chunk"), F.col("chain").alias("top"),
                          F.when(F.col("prev") == "", F.col("own")).otherwise(
                              F.sha2(F.concat("prev", "own"), 256)).alias("first"))

    def under(c):
        return F.when(F.col("top").isNull(), F.col(c)).when(
            F.col(c) == "", F.col("first")).otherwise(F.sha2(F.concat("top", c), 256)).alias(c)
    return flat.join(before, ["conv", "chunk"], "left").select(
        "conv", "idx", *more, under("prev"), under("chain"))


def _nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, numbered, and (conv, chain): the node at which each conversation ends."""
    members = cut(_chained(turns, "n_bytes"), "members")
    found = members.groupBy("chain", (F.col("idx") + 1).alias("depth")).agg(
        F.first("prev").alias("prev"), F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0").select(F.lit("").alias("chain"), F.lit(0).cast("bigint").alias("depth"),
                              F.lit(None).cast("string").alias("prev"), "conv_id", "n_convs",
                              F.lit(0).cast("bigint").alias("n_bytes"))
    nodes = cut(found.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    last = members.groupBy("conv").agg(F.max_by("chain", "idx").alias("chain"))
    ends = convs.join(last, "conv", "left").select("conv", F.coalesce("chain", F.lit(""))
                                                   .alias("chain"))
    return nodes, ends


def _listed(ends: DataFrame) -> DataFrame:
    """(chain, ends_sha256): the conversations that end at a node, ascending, comma-joined.

    The text is made in rows of at most LISTED ids and hashed as a stream, so the task of a
    node at which very many end holds one such row at a time.
    """
    numbered = ordinal(ends, ["chain", "conv"], "at")
    rows = numbered.groupBy("chain", F.expr(f"at div {LISTED}").alias("piece")).agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")),
                                     lambda c: c.cast("string"))).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for chain, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if chain != held:
                    if held is not None:
                        done.append((held, state.hexdigest()))
                    held, state = chain, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist(
                [{"chain": c, "ends_sha256": h} for c, h in done],
                pa.schema([("chain", pa.string()), ("ends_sha256", pa.string())]))
        if held is not None:
            yield pa.RecordBatch.from_pydict({"chain": [held], "ends_sha256": [state.hexdigest()]})
    return (rows.repartition("chain").sortWithinPartitions("chain", "piece")
            .select("chain", "ids").mapInArrow(run, "chain string, ends_sha256 string"))


def _compress(live: DataFrame, sums: list[str]) -> tuple[DataFrame, DataFrame]:
    """Contract all unary chains of ``live``. Returns what is left, and (id, end, sums...) of the
    contracted nodes: a node's total is its sums plus the total of ``end``."""
    unary = live.where("kids = 1 AND parent IS NOT NULL")
    below = live.select(F.col("id").alias("end"), F.col("parent").alias("_p"),
                        (F.col("kids") == 1).alias("more"),
                        *[F.col(f"carry_{s}").alias(f"b_{s}") for s in sums])
    chain, seen = cut_with(
        unary.join(below, F.col("id") == F.col("_p")).select(
            "id", "parent", "end", "more", *[(F.col(s) + F.col(f"b_{s}")).alias(s) for s in sums],
            *[f"carry_{s}" for s in sums], "depth"), "chain",
        rows=F.count(F.lit(1)), more=F.count_if("more"))
    if not seen["rows"]:
        return live, None
    while seen["more"]:
        ahead = chain.select(F.col("id").alias("_id"), F.col("end").alias("_end"),
                             F.col("more").alias("_more"), *[F.col(s).alias(f"_{s}") for s in sums])
        chain, seen = cut_with(
            chain.join(ahead, F.col("more") & (F.col("end") == F.col("_id")), "left").select(
                "id", "parent", F.coalesce("_end", "end").alias("end"),
                F.coalesce("_more", F.lit(False)).alias("more"),
                *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums],
                *[f"carry_{s}" for s in sums], "depth"), "chain", more=F.count_if("more"))
    # The end of a chain takes the place of its top, and carries the chain's sums upwards.
    tops = chain.groupBy(F.col("end").alias("id")).agg(F.min_by(F.struct(
        F.col("parent").alias("above"),
        *[(F.col(s) + F.col(f"carry_{s}")).alias(f"c_{s}") for s in sums]), "depth").alias("top"))
    rest = live.join(unary.select("id"), "id", "left_anti").join(tops, "id", "left").select(
        "id", F.coalesce("top.above", "parent").alias("parent"), "depth", "kids", *sums,
        *[F.coalesce(f"top.c_{s}", f"carry_{s}").alias(f"carry_{s}") for s in sums])
    return rest, chain.select("id", "end", *sums)


def subtree_sums(nodes: DataFrame, sums: list[str]) -> tuple[DataFrame, int]:
    """(id, sums...) over each node's subtree, itself included, and the number of rounds.

    ``nodes``: id, parent (null for the one root), depth, kids (children), and the columns to
    add up. ``carry_x`` is what a node gives its parent beyond its own subtree: the sums of
    the chains contracted above it.
    """
    live = cut(nodes.select("id", "parent", "depth", "kids", *sums,
                            *[F.lit(0).cast("bigint").alias(f"carry_{s}") for s in sums]), "live")
    raked, chains = [], []
    while True:
        rest, chain = _compress(live, sums)
        chains.append(chain)
        if chain is not None:
            rest = cut(rest, "compressed")
        leaf = F.col("kids") == 0
        raked.append(rest.where(leaf).select("id", *sums))
        given = rest.where(leaf & F.col("parent").isNotNull()).groupBy(
            F.col("parent").alias("id")).agg(
            F.count("*").alias("gone"),
            *[F.sum(F.col(s) + F.col(f"carry_{s}")).alias(f"g_{s}") for s in sums])
        live, seen = cut_with(
            rest.where(~leaf).join(given, "id", "left").select(
                "id", "parent", "depth",
                (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
                *[(F.col(s) + F.coalesce(f"g_{s}", F.lit(0))).alias(s) for s in sums],
                *[f"carry_{s}" for s in sums]), "live", count=F.count(F.lit(1)))
        if not seen["count"]:
            break
    totals = reduce(DataFrame.unionByName, raked)
    for chain in reversed(chains):
        if chain is not None:
            known = totals.select(F.col("id").alias("end"), *[F.col(s).alias(f"t_{s}")
                                                              for s in sums])
            expanded = chain.join(known, "end").select(
                "id", *[(F.col(s) + F.col(f"t_{s}")).alias(s) for s in sums])
            totals = cut(totals.unionByName(expanded), "totals")
    return totals, len(chains)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv, idx from 0 without gaps, digest,
    n_bytes) of the conversations ``convs`` (conv, each once; some may have no turns).

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null for the
    root), n_convs (members), n_children, n_leaves (childless nodes in the subtree),
    saved_tokens (over the subtree, (n_convs - 1) * n_bytes of each node's last turn) and
    ends_sha256 (of the conversations that end here, ascending, in decimal, comma-joined).
    Without conversations there is no node.
    """
    nodes, ends = _nodes(turns, convs)
    above = nodes.select(F.col("chain").alias("prev"), F.col("id").alias("parent"),
                         F.col("conv_id").alias("parent_conv_id"))
    placed = cut(nodes.join(above, "prev", "left"), "placed")
    kids = placed.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
        F.count("*").alias("kids"))
    tree = cut(placed.join(kids, "id", "left").withColumn(
        "kids", F.coalesce("kids", F.lit(0).cast("bigint"))), "tree")
    own = tree.select("id", "parent", "depth", "kids",
                      (F.col("kids") == 0).cast("bigint").alias("n_leaves"),
                      ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    totals, _ = subtree_sums(own, ["n_leaves", "saved_tokens"])
    return (tree.join(totals, "id").join(_listed(ends), "chain", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")))
