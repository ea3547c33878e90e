"""Repair of a conversation's structure: the cheapest edits that let user and assistant take turns.

Each turn has at most one fault: it is blank, repeats an earlier turn, or ends without a full stop. Blank and
repeated turns are deleted; others are kept, given another role, or deleted; empty turns may be inserted. What
the edits cost and how the cheapest are found says ``repair_grammar``.

Turns are numbered without their texts, and a conversation of any length is cut into blocks of ``BLOCK`` turns. A
block is a string of letters that becomes a matrix, with one grammar for all blocks of an Arrow batch; matrices of
one conversation are multiplied block group by block group, until one is left. Texts are shuffled once, to go past the
audit of their conversation in order, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import repair_grammar as rg
from rivulet.llm.common import slices
from rivulet.operators.rank import sliced_rank
from rivulet.session import settle

BLOCK = 4096
FACTORS = 32  # matrices of one conversation that are multiplied in one step
HEAD = 64
SPACES = " \t\n\x0b\x0c\r"

_PARTS = (
    "conv_id bigint, block bigint, costs array<int>, audits array<string>, first int, last int, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)
_WHOLE = "conv_id bigint, cost bigint, audit string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def _order() -> list[Column]:
    """The order of turns. Texts are compared by their heads and digests, so that no long text becomes a sort key."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]


def _lettered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, place, letter) of every turn; ``place`` counts from 1."""
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    role = F.coalesce(*[F.when(F.col("role").startswith(c), F.lit(k)) for k, c in enumerate(rg.ROLES)], F.lit(3))
    narrow = turns.select(
        "conv_id", "turn", "role", "head", "digest", role.alias("kind"),
        (last == "").alias("is_blank"), (~last.isin(".", "!", "?")).alias("is_cut"),
    )
    placed = settle(sliced_rank(narrow, ["conv_id"], _order(), "place"), "places")
    firsts = placed.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min("place").alias("earliest")
    )
    same = placed["conv_id"].eqNullSafe(F.col("c")) & (placed["role"] == F.col("r")) & (placed["digest"] == F.col("d"))
    fault = (
        F.when(F.col("is_blank"), rg.BLANK)
        .when(F.col("place") > F.col("earliest"), rg.DUPLICATE)
        .when(F.col("is_cut"), rg.TRUNCATED).otherwise(rg.FINE)
    )
    return placed.join(firsts, same).select(
        "conv_id", "turn", "place", F.char(F.lit(65) + 4 * F.col("kind") + fault).alias("letter")
    )


def _counts(string: str) -> list[int]:
    """First and last role, turns with each fault, and neighbours that may not follow each other."""
    roles, faults = zip(*(divmod(ord(c) - 65, 4) for c in string))
    illegal = sum(pair not in _LEGAL for pair in zip(roles, roles[1:]))
    return [roles[0], roles[-1], *(faults.count(f) for f in (rg.BLANK, rg.DUPLICATE, rg.TRUNCATED)), illegal]


_LEGAL = {(rg.ROLES.index(x), rg.ROLES.index(y)) for x, y in ("su", "ua", "au")}


def _evaluate(batches: Iterator[pa.RecordBatch], size: int):
    """A row for each block of up to ``size`` turns. One that is a whole conversation has its cost and audit as single entries."""
    for batch in batches:
        for part in slices(batch, 5000):
            strings = part.column("letters").to_pylist()
            blocks = part.column("block").to_pylist()
            found = rg.Evaluated(strings)
            whole = {x: found.whole(x) for x in {x for x, b in zip(strings, blocks) if b == 0 and len(x) < size}}
            rows = []
            for conv, block, x in zip(part.column("conv_id").to_pylist(), blocks, strings):
                if block == 0 and x in whole:
                    costs, audits = [whole[x][0]], [whole[x][1]]
                else:
                    costs, audits = rg.packed(found.part(x))
                rows.append((conv, block, costs, audits, *_counts(x)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS_SCHEMA)], schema=_PARTS_SCHEMA)


_PARTS_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("costs", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
        ("first", pa.int32()), ("last", pa.int32()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()),
    ]
)


def _multiplied(parts: pd.DataFrame, factors: int) -> pd.DataFrame:
    parts = parts.sort_values("block")
    matrices = [rg.unpacked([None if pd.isna(x) else x for x in c], a) for c, a in zip(parts["costs"], parts["audits"])]
    costs, audits = rg.packed(rg.product(matrices))
    rims = zip(parts["last"].tolist(), parts["first"].tolist()[1:])
    sums = {c: parts[c].sum() for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += sum(pair not in _LEGAL for pair in rims)
    head = parts.iloc[0]
    return pd.DataFrame(
        [{"conv_id": head["conv_id"], "block": head["block"] // factors, "costs": costs, "audits": audits,
          "first": head["first"], "last": parts.iloc[-1]["last"], **sums}]
    ).astype({"conv_id": "Int64"})


def _finished(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            single = len(r["costs"]) == 1
            cost, audit = (r["costs"][0], r["audits"][0]) if single else rg.finished(rg.unpacked(r["costs"], r["audits"])[rg.START])
            rows.append({**{k: r[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal")}, "cost": cost, "audit": audit})
        yield pa.RecordBatch.from_pylist(rows, schema=_WHOLE_SCHEMA)


_WHOLE_SCHEMA = pa.schema(
    [(c, pa.string() if c == "audit" else pa.int64()) for c in ("conv_id", "cost", "audit", "blank", "duplicate", "truncated", "illegal")]
)


def _judged(lettered: DataFrame, size: int, factors: int) -> DataFrame:
    """Cost, audit and counts of every conversation that has turns."""
    strings = lettered.groupBy("conv_id", F.expr(f"(place - 1) div {size}").alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "letter"))), lambda x: x["letter"]), "").alias("letters")
    )
    parts = settle(strings.mapInArrow(lambda batches: _evaluate(batches, size), _PARTS), "parts")
    single = parts.where("size(costs) = 1")
    many = parts.where("size(costs) > 1")
    # a round multiplies ``factors`` neighbours each; a conversation is done when its only block is number 0
    left = many.agg(F.max("block")).first()[0]
    while left:
        groups = many.groupBy("conv_id", F.expr(f"block div {factors}"))
        many = settle(groups.applyInPandas(lambda parts: _multiplied(parts, factors), _PARTS), "parts")
        left //= factors
    return single.unionByName(many).mapInArrow(_finished, _WHOLE)


def _edited(batches: Iterator[pa.RecordBatch]):
    """Conversations pass in order, each behind a row with its audit."""
    audit, at, place, odd, conv = "", 0, 0, 0, None
    rows: list[tuple] = []

    def put(edit: str, role: str | None, text: str):
        nonlocal place
        rows.append((conv, place, edit, ("user", "assistant")[(place - odd) % 2] if role is None else role, text))
        place += 1

    def ready():
        columns = [list(c) for c in zip(*rows)] or [[] for _ in _EDITED_SCHEMA]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EDITED_SCHEMA)], schema=_EDITED_SCHEMA)

    for batch in batches:
        for part in slices(batch):
            for conv_id, head, role, text in zip(*[part.column(c).to_pylist() for c in ("conv_id", "is_turn", "role", "text")]):
                if not head:
                    for _ in audit[at:]:  # inserts behind the last turn
                        put(rg.INSERT, None, "")
                    conv, audit, at, place = conv_id, text, 0, 0
                    odd = (len(audit) - audit.count(rg.DELETE)) % 2  # only what begins with s has an odd length
                    continue
                while audit[at] == rg.INSERT:
                    put(rg.INSERT, None, "")
                    at += 1
                edit, at = audit[at], at + 1
                if edit == rg.KEEP:
                    put(edit, role, text)
                elif edit == rg.REROLE:
                    put(edit, None, text)
            yield ready()
    for _ in audit[at:]:
        put(rg.INSERT, None, "")
    yield ready()


_EDITED = "conv_id bigint, place bigint, edit string, role string, text string"
_EDITED_SCHEMA = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), *[(c, pa.string()) for c in ("edit", "role", "text")]])


def repair(
    conversations: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text", block: int = BLOCK, factors: int = FACTORS,
) -> tuple[DataFrame, DataFrame]:
    """``(report, turns)``. ``block`` and ``factors`` change no result.

    ``report`` has a row for every conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``
    has the repaired ones: conv_id, place (from 0), edit (K, R or I), role, text; those of a conversation lie in one
    partition, in order.

    Turns go by turn, nulls first, those of equal turn by role and text. Null roles and texts count as one space. Rows
    with a null conv_id are a conversation of their own. A role whose initial is not s, u or a is illegal and
    never kept. An empty table gives empty results.
    """
    given = conversations.select(
        F.col(conv_column).cast("bigint").alias("conv_id"), F.col(turn_column).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), F.lit(" ")).alias("text"),
    ).withColumns({"head": F.left("text", F.lit(HEAD)), "digest": F.md5(F.col("text").cast("binary"))})
    lettered = _lettered(given)
    judged = settle(_judged(lettered, block, factors), "judged")
    gaps = lettered.groupBy(F.col("conv_id").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    report = judged.join(gaps, judged["conv_id"].eqNullSafe(F.col("c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    heads = judged.select("conv_id", F.lit(False).alias("is_turn"), F.col("audit").alias("text"))
    stream = given.withColumn("is_turn", F.lit(True)).unionByName(heads, allowMissingColumns=True)
    in_order = stream.repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", *_order())
    return report, in_order.select("conv_id", "is_turn", "role", "text").mapInArrow(_edited, _EDITED)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired turns in order, as ``role:text`` joined by newlines. A hash is fed line by
    line: no conversation is held."""

    def feed(batches: Iterator[pa.RecordBatch]):
        import hashlib

        conv, hashed, done = None, None, []
        for batch in batches:
            for part in slices(batch):
                for conv_id, place, role, text in zip(*[part.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
                    if place == 0:
                        if hashed is not None:
                            done.append((conv, hashed.hexdigest()))
                        conv, hashed = conv_id, hashlib.sha256()
                    else:
                        hashed.update(b"\n")
                    hashed.update(f"{role}:{text}".encode())
                yield _digest_batch(done)
                done = []
        if hashed is not None:
            yield _digest_batch([(conv, hashed.hexdigest())])

    return turns.select("conv_id", "place", "role", "text").mapInArrow(feed, "conv_id bigint, repaired_sha256 string")


def _digest_batch(done: list[tuple]) -> pa.RecordBatch:
    ids, values = zip(*done) if done else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.string())], names=["conv_id", "repaired_sha256"])
