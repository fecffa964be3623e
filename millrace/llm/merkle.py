"""A Merkle manifest of a dataset: a root over all rows, and for every row a proof that it belongs to it.

Rows of a group (a language) are leaves in order of their ids; leaves become a subroot, run by run of ``fanout`` nodes, and
the subroots of the groups, in order, become the root. A leaf's place is its exact rank in its group, from histograms of the
digits of the ids. A node is known by the digits of its rank in base ``fanout``: its parent is the prefix that lacks the last
digit. One task reduces all nodes under one longer prefix, some hundreds, to the node of that prefix; a table of these is
reduced in the same way, so that a group of any size takes a few rounds and no task sees more than its block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.ranks import byte_digits, hex_digits, id_digits, radix_ranks, row_digits
from millrace.plans.staging import Scratch, if_small

#: Nodes that a task reduces at once, at most.
BLOCK_NODES = 256
PROOF = "array<struct<place int, siblings array<string>>>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of values in a row, as lowercase hexadecimal text: each is its UTF-8 length, a colon and itself, or ``-`` for null."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _parent(run: Sequence[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def block_levels(nodes: list[str], fanout: int, height: int) -> list[list[str]]:
    """The nodes of a block and those of the levels above it, ``height`` of them."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([_parent(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def _depth(fanout: int) -> int:
    """Digits that a block takes off a rank."""
    return max(1, int(math.log(BLOCK_NODES, fanout) + 1e-9))


def _height(total: int, fanout: int, depth: int) -> int:
    """Levels that a block has: all of its digits, or as many as a group needs that is a single block."""
    height = 0
    while height < depth and fanout**height < total:
        height += 1
    return height


def _reduce(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """One round: (_g, _total, _rank, digest) of the prefixes that lack ``depth`` digits."""
    size = fanout**depth

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_rank")
        group, block = (k.as_py() for k in key)
        total = table.column("_total")[0].as_py()
        top = block_levels(table.column("digest").to_pylist(), fanout, _height(total, fanout, depth))[-1]
        return pa.table({"_g": pa.array([group]), "_total": pa.array([-(-total // size)]), "_rank": pa.array([block]), "digest": pa.array(top)})

    keyed = nodes.select("_g", "_total", "_rank", "digest", F.floor(F.col("_rank") / size).alias("_block"))
    return keyed.groupBy("_g", "_block").applyInArrow(run, "_g string, _total long, _rank long, digest string")


def _proofs(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """``nodes`` with _own: of each level of their block, the place in the run and the other nodes of the run, left to right."""
    size = fanout**depth
    schema = T.StructType([*nodes.schema.fields, T.StructField("_own", T._parse_datatype_string(PROOF))])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_rank").drop_columns(["_block"])
        rank = table.column("_rank").to_numpy() % size
        height = _height(table.column("_total")[0].as_py(), fanout, depth)
        levels = block_levels(table.column("digest").to_pylist(), fanout, height)
        places, counts, siblings = [], [], []
        for at in rank.tolist():
            for level in levels[:height]:
                first, place = at - at % fanout, at % fanout
                others = level[first : first + fanout]
                del others[place]
                places.append(place)
                counts.append(len(others))
                siblings += others
                at //= fanout
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        steps = pa.StructArray.from_arrays(
            [pa.array(places, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(siblings, pa.string()))], names=["place", "siblings"]
        )
        own = pa.ListArray.from_arrays(pa.array(np.arange(len(rank) + 1, dtype=np.int32) * height), steps)
        return table.append_column("_own", own)

    keyed = nodes.withColumn("_block", F.floor(F.col("_rank") / size))
    return keyed.groupBy("_g", "_block").applyInArrow(run, schema)


def _rounds(nodes: DataFrame, fanout: int, scratch: Scratch) -> list[DataFrame]:
    """The nodes of each round up to those that are one in their group."""
    rounds, depth = [nodes], _depth(fanout)
    most = nodes.agg(F.max("_total")).first()[0] or 1
    while True:
        rounds.append(scratch.write(_reduce(rounds[-1], fanout, depth), "nodes"))
        most = -(-most // fanout**depth)
        if most == 1:
            return rounds


def _climb(rounds: list[DataFrame], tops: DataFrame, fanout: int, scratch: Scratch) -> DataFrame:
    """The first nodes with the columns of ``tops`` (_g, _proof and more), _proof being that of each node up to the root."""
    depth = _depth(fanout)
    more = [c for c in tops.columns if c not in ("_g", "_proof")]
    above = rounds[-1].select("_g", "_rank").join(if_small(tops), "_g")
    for i in reversed(range(len(rounds) - 1)):
        higher = above.select("_g", F.col("_rank").alias("_up"), F.col("_proof").alias("_rest"), *more)
        up = F.floor(F.col("_rank") / fanout**depth)
        joined = rounds[i].withColumn("_up", up).join(if_small(higher), ["_g", "_up"]).drop("_up")
        found = _proofs(joined, fanout, depth)
        above = found.withColumn("_proof", F.concat("_own", "_rest")).drop("_own", "_rest")
        if i:
            above = scratch.write(above.select("_g", "_rank", "_proof", *more), "proofs")
    return above


def merkle_manifest(
    rows: DataFrame, group_col: str = "lang", id_col: str = "doc_id", leaf_col: str = "leaf", carry: Sequence[str] = (), fanout: int = 2,
    most: int | None = None,
) -> DataFrame:
    """One row per row of ``rows``: id, group, the columns to ``carry``, leaf, rank, subroot, root and proof.

    ``leaf_col`` holds digests as hexadecimal text, as ``leaf_digest`` makes them, ids are 64-bit numbers, groups texts. ``proof``
    has a step for each level up to the root: the node's place in its run, and the digests of the other nodes of the
    run, left to right; a node that is alone in its run has none and is hashed alone. Null ids come first, a null group is
    one of its own and the first; rows that repeat an id go by their leaves, and rows that repeat both are interchangeable
    and take neighbouring places. A group of one row has its leaf for its subroot, one group its subroot for the root. An
    empty table gives no rows. Columns not named are ignored. ``most``: see ``radix_ranks``.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    limit = {"most": most} if most else {}
    names = [f"_c{i}" for i in range(len(carry))]
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    plain = rows.select(
        F.col(id_col).cast("long").alias("_id"), group.alias("_g"), F.col(leaf_col).alias("digest"),
        *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)], F.monotonically_increasing_id().alias("_row"),
    )
    plain = scratch.write(plain, "leaves")
    ids, digest = id_digits(F.col("_id")), F.col("digest")
    chunks = [
        ids[:4],
        [ids[4], hex_digits(digest, 1, 4), hex_digits(digest, 5, 4)],
        [hex_digits(digest, 9, 4), hex_digits(digest, 13, 4), *row_digits(F.col("_row"))],
    ]
    totals = scratch.write(plain.groupBy("_g").agg(F.count(F.lit(1)).alias("_total")), "totals")
    ranked = radix_ranks(plain, ["_g"], chunks, ["_id", "digest", "_row"], scratch, **limit)
    leaves = scratch.write(ranked.join(if_small(totals), "_g").drop("_row"), "ranked")
    rounds = _rounds(leaves, fanout, scratch)

    # the subroots are the leaves of one more tree
    subroots = rounds[-1].select(F.lit("all").alias("_g"), F.col("_g").alias("_name"), "digest")
    longest = subroots.agg(F.max(F.octet_length("_name"))).first()[0] or 1
    by_name = [[byte_digits(F.col("_name"), at + i) for i in (0, 2, 4)] for at in range(1, longest + 1, 6)]
    # names start with = or -, so that null, -, comes before all others
    subroots = scratch.write(subroots.withColumn("_total", F.lit(totals.count()).cast("long")), "subroots")
    ordered = scratch.write(radix_ranks(subroots, ["_g"], by_name, [F.col("_name").cast("binary")], scratch, **limit), "groups")
    upper = _rounds(ordered, fanout, scratch)
    root = upper[-1].select("_g", F.array().cast(PROOF).alias("_proof"), F.col("digest").alias("root"))
    climbed = _climb(upper, root, fanout, scratch)
    tops = scratch.write(climbed.select(F.col("_name").alias("_g"), F.col("digest").alias("subroot"), "root", "_proof"), "tops")

    found = _climb(rounds, tops, fanout, scratch)
    return found.select(
        F.col("_id").alias(id_col), F.when(F.col("_g") != "-", F.substr(F.col("_g"), F.lit(2))).alias(group_col),
        *[F.col(n).alias(c) for c, n in zip(carry, names, strict=True)],
        F.col("digest").alias(leaf_col), F.col("_rank").alias("rank"), "subroot", "root", F.col("_proof").alias("proof"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def step(node: Column, level: Column) -> Column:
        others, place = level["siblings"], level["place"]
        before = F.array_join(F.slice(others, F.lit(1), place), "")
        after = F.array_join(F.slice(others, place + 1, F.size(others)), "")
        return F.sha2(F.concat(before, node, after).cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the leaf's run to the root's."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda level: level["siblings"])), "").cast("binary"), 256)
