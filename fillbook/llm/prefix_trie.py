"""Operator 13, prefix trie of conversations by Euler tours.

A node is a sequence of first turns. Its key is the depth and a polynomial hash
(two words, 127 bits) of the turns' digests, so a key follows from its parent's
in one step and a long conversation is hashed part by part: parts of a sorted
table are affine maps that compose, and no conversation is one task.

The tree is walked by a tour of two arcs a node: enter and exit. Siblings lie
side by side in a global order by parent, so each arc knows the next one. The
tour is ranked as a linked list: first, stretches whose arcs lie in one block (a
piece of one conversation's path, then a run of siblings) become one element
each, then elements with a head's coin take in a successor with a tail's, until
``LAST`` elements at most are left, which one task walks through. Removed
elements wait with the sum to the next one that stayed, and get their place back
round by round. Every element carries the sums of the arcs behind it, so a
node's leaves and savings are the difference of the sums at its two arcs.

The conversations that end at a node are hashed in the order of their ids: each
part of a sorted table writes them as text, and the texts are streamed through
SHA-256 in order, never held together.

Defined results: rows without conv_id belong to no conversation; a null turn
comes first, equal turns are ordered by the digest of role and text; repeated
rows are separate turns; null role or text is empty; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import frugal, register, table, word_count, write_read
from fillbook.llm.merkle import crc32_sql
from fillbook.llm.ordered import numbered, sorted_parts

#: Conversations of one family share the first turns of its first member.
FAMILY = 20
#: At most ``SHARED - 1`` turns are taken over.
SHARED = 4
#: The last elements of a list are walked through by one task.
LAST = 1 << 14
#: Depths of a path, and siblings, that lie in one block.
BLOCK = 1024
#: Characters of a list of ids that travel as one row.
CHUNK = 1 << 16

_PRIME = (1 << 127) - 1
_BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15], "big")
_WORD = (1 << 64) - 1


@lru_cache(maxsize=1 << 16)
def _power(n: int) -> int:
    return pow(_BASE, n, _PRIME)


def _turn(digest: bytes) -> int:
    """A turn as a number, never 0, so that a longer sequence has another sum."""
    return 1 + int.from_bytes(digest[:15], "big")


def _words(key: int) -> tuple[int, int]:
    """The two signed words of a key."""
    return int.from_bytes((key >> 64).to_bytes(8, "big"), "big", signed=True), int.from_bytes((key & _WORD).to_bytes(8, "big"), "big", signed=True)


def taken_over(conv_id: int) -> int:
    """Turns that a conversation takes over from the first of its family."""
    return zlib.crc32(str(conv_id).encode()) % SHARED


def _batch(schema: str, rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=schema.split())


_LONG, _BIN = pa.int64(), pa.binary()


# --- turns: places and sums ---------------------------------------------------

def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, words`` of each row with a conv_id; texts go no further."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select("conv_id", "turn", F.unhex(F.sha2(whole, 256)).alias("digest"), word_count(text).alias("words"))


_SUMS = "part at conv_id i digest words upto"


def _sum_batches(batches: Iterator[pa.RecordBatch]):
    """Sorted rows of a part: place ``i`` in the conversation's share of the part, sum up to there."""
    conv, i, total = None, 0, 0
    for b in batches:
        out = []
        for c, digest, words, part, at in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            if c != conv:
                conv, i, total = c, 0, 0
            total = (total + _turn(digest) * _power(i)) % _PRIME
            out.append((part, at, c, i, digest, words, total.to_bytes(16, "big")))
            i += 1
        yield _batch(_SUMS, out, [pa.int32(), _LONG, _LONG, _LONG, _BIN, _LONG, _BIN])


def _carry_batches(batches: Iterator[pa.RecordBatch]):
    """Shares of conversations that lie in several parts, in order: turns and sum before each."""
    conv, before, total = None, 0, 0
    for b in batches:
        out = []
        for c, part, n, upto in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            if c != conv:
                conv, before, total = c, 0, 0
            out.append((c, part, before, total.to_bytes(16, "big")))
            total = (total + _power(before) * int.from_bytes(upto, "big")) % _PRIME
            before += n
        yield _batch("conv_id part before sum", out, [_LONG, pa.int32(), _LONG, _BIN])


def _summed_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with the sum up to them inside their part, and per (part,
    conversation) the turns and sum before it."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    cut = sorted_parts(rows, order, "turns").select("conv_id", "digest", "words", "part", "at")
    # A written part is read again in order: one file a part.
    turns = write_read(cut.repartition("part").sortWithinPartitions("part", "at").mapInArrow(
        frugal(_sum_batches), "part int, at bigint, conv_id bigint, i bigint, digest binary, words bigint, upto binary"), "sums")
    shares = turns.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("turns"), F.max_by("upto", "i").alias("upto"))
    shares = write_read(shares, "shares")
    several = shares.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")  # two a part at most
    carried = shares.join(several, "conv_id").select("conv_id", "part", "turns", "upto").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    carried = carried.mapInArrow(frugal(_carry_batches), "conv_id bigint, part int, before bigint, sum binary")
    shares = shares.join(carried, ["conv_id", "part"], "left")
    return turns, shares.select("part", "conv_id", "turns", F.coalesce("before", F.lit(0)).alias("before"),
                                F.coalesce("sum", F.lit(bytes(16))).alias("sum"))


# --- members: one row per rebuilt conversation and prefix ---------------------

_MEMBER = "d k1 k2 p1 p2 conv_id words ends"
_MEMBER_TYPES = [_LONG, _LONG, _LONG, _LONG, _LONG, _LONG, _LONG, pa.bool_()]
_MEMBER_SCHEMA = "d bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv_id bigint, words bigint, ends boolean"


def _start(digests: list[bytes]) -> list[int]:
    """Sums of 0, 1, ... first turns."""
    out = [0]
    for i, d in enumerate(digests):
        out.append((out[-1] + _turn(d) * _power(i)) % _PRIME)
    return out


def _head_batches(batches: Iterator[pa.RecordBatch]):
    """Root and taken-over turns of each conversation."""
    for b in batches:
        out = []
        for conv, turns, digests, words in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            h = taken_over(conv)
            sums = _start(digests[:h])
            m = len(sums) - 1
            for d, s in enumerate(sums):
                parent = _words(sums[d - 1]) if d else (None, None)
                out.append((d, *_words(s), *parent, conv, words[d - 1] if d else 0, d == m and turns <= h))
        yield _batch(_MEMBER, out, _MEMBER_TYPES)


def _own_batches(batches: Iterator[pa.RecordBatch]):
    """A conversation's own turns behind those it takes over."""
    for b in batches:
        out = []
        for conv, i, digest, words, upto, before, carry, turns, own, base in zip(*(b.column(k).to_pylist() for k in range(10)), strict=True):
            h, at = taken_over(conv), before + i
            if at < h:
                continue
            m = min(h, len(base))
            total = (int.from_bytes(carry, "big") + _power(before) * int.from_bytes(upto, "big")) % _PRIME
            shift = _power(m - h) if m >= h else pow(_power(h - m), -1, _PRIME)
            place = m + at - h
            key = (_start(base[:m])[-1] + shift * (total - _start(own[:h])[-1])) % _PRIME
            parent = (key - _turn(digest) * _power(place)) % _PRIME
            out.append((place + 1, *_words(key), *_words(parent), conv, words, at == turns - 1))
        yield _batch(_MEMBER, out, _MEMBER_TYPES)


def members(conversations: DataFrame) -> DataFrame:
    """One row for each rebuilt conversation and each of its prefixes: depth
    ``d``, key (``k1``, ``k2``), parent's key, words of the last turn, ``ends``."""
    turns, shares = _summed_turns(turn_rows(conversations))
    # The first turns of every conversation: SHARED - 1 rows at most.
    first = turns.where(F.col("i") < SHARED - 1).join(shares.select("part", "conv_id", "before"), ["part", "conv_id"])
    first = first.withColumn("i", F.col("before") + F.col("i")).where(F.col("i") < SHARED - 1)
    first = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", "digest", "words"))).alias("first"))
    sizes = shares.groupBy("conv_id").agg(F.sum("turns").alias("n"))
    heads = write_read(sizes.join(first, "conv_id").select("conv_id", "n", F.col("first.digest").alias("own"), F.col("first.words").alias("own_words")), "heads")
    base = heads.select(F.col("conv_id").alias("base_id"), F.col("own").alias("base"), F.col("own_words").alias("base_words"))
    heads = heads.join(base, F.col("base_id") == F.col("conv_id") - F.col("conv_id") % FAMILY, "left")
    none = F.array().cast("array<binary>"), F.array().cast("array<bigint>")
    heads = heads.select("conv_id", "n", "own", F.coalesce("base", none[0]).alias("base"), F.coalesce("base_words", none[1]).alias("base_words"))
    taken = heads.select("conv_id", "n", "base", "base_words").mapInArrow(frugal(_head_batches), _MEMBER_SCHEMA)
    # (part, conversation) meets a part's share of a long conversation only.
    known = shares.select("part", "conv_id", "before", "sum").join(heads.select("conv_id", "n", "own", "base"), "conv_id")
    own = turns.join(known, ["part", "conv_id"]).select("conv_id", "i", "digest", "words", "upto", "before", "sum", "n", "own", "base")
    return write_read(taken.unionByName(own.mapInArrow(frugal(_own_batches), _MEMBER_SCHEMA)), "members")


# --- list ranking -------------------------------------------------------------

_RANKED = "id bigint, next bigint, arcs bigint, leaves bigint, saved bigint"
_SUM = ("arcs", "leaves", "saved")


def _stretch(ids: np.ndarray, succ: np.ndarray, weight: np.ndarray) -> Iterator[tuple]:
    """Elements of a block: (id, next, sums, stays). Members of a stretch sum up
    to its end and name the element behind it; the stretch's head stays."""
    at = {x: i for i, x in enumerate(ids.tolist())}
    after = [at.get(x, -1) for x in succ.tolist()]
    inner = set(after)
    for head in range(len(ids)):
        if head in inner:
            continue
        path = [head]
        while after[path[-1]] >= 0:
            path.append(after[path[-1]])
        sums = np.cumsum(weight[path][::-1], axis=0)[::-1]
        end = succ[path[-1]]
        for i, s in zip(path, sums.tolist(), strict=True):
            yield int(ids[i]), None if end < 0 else int(end), *s, i == head


def _by_key(work: Callable):
    """Calls ``work`` on the rows of each value of the first column (sorted)."""
    def run(batches: Iterator[pa.RecordBatch]):
        key, held = None, []
        for b in batches:
            keys = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
            for a, z in zip(cuts, cuts[1:], strict=False):
                if keys[a] != key:
                    yield from work(held)
                    key, held = keys[a], []
                held.append(b.slice(a, z - a))
        yield from work(held)
    return frugal(run)


def _stretch_rows(held: list[pa.RecordBatch]):
    if not held:
        return
    rows = pa.Table.from_batches(held)
    cols = [np.concatenate([c.fill_null(-1).to_numpy() for c in rows.column(k).chunks]) for k in range(1, 6)]
    out = list(_stretch(cols[0], cols[1], np.stack(cols[2:], 1)))
    yield _batch("id next arcs leaves saved stays", out, [_LONG] * 5 + [pa.bool_()])


def _contract(items: DataFrame, block: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """(elements that stay, elements that wait) after joining the stretches inside each block."""
    dealt = items.select(block.alias("block"), "id", "next", *_SUM)
    dealt = dealt.repartition("block").sortWithinPartitions("block")
    done = write_read(dealt.mapInArrow(_by_key(_stretch_rows), f"{_RANKED}, stays boolean"), name)
    return done.where("stays").drop("stays"), done.where("not stays").drop("stays")


def _take_in(items: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """One coin round: an element with coin 0 takes in a successor with coin 1."""
    coin = lambda c: F.pmod(F.xxhash64(F.lit(turn), c), F.lit(2))
    takes = (coin(F.col("id")) == 0) & (coin(F.col("next")) == 1)
    marked = items.withColumn("takes", F.coalesce(takes, F.lit(False)))
    gone = marked.where("takes").select(F.col("next").alias("gone"), F.col("id").alias("by"))
    after = items.select(F.col("id").alias("gone"), F.col("next").alias("_next"), *[F.col(c).alias(f"_{c}") for c in _SUM])
    pairs = write_read(gone.join(after, "gone"), "pairs")
    waits = pairs.select(F.col("gone").alias("id"), F.col("_next").alias("next"), *[F.col(f"_{c}").alias(c) for c in _SUM])
    grown = marked.join(pairs, F.col("id") == F.col("by"), "left").select(
        "id", F.when(F.col("by").isNotNull(), F.col("_next")).otherwise(F.col("next")).alias("next"),
        *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in _SUM])
    return write_read(grown.join(pairs.select(F.col("gone").alias("id")), "id", "left_anti"), "items"), waits


def _walk(held: list[pa.RecordBatch]):
    """The sums behind each of the last elements, from the end of the list to its start."""
    if not held:
        return
    rows = pa.Table.from_batches(held)
    ids, after = rows.column(1).to_pylist(), rows.column(2).to_pylist()
    weight = list(zip(*(rows.column(k).to_pylist() for k in (3, 4, 5)), strict=True))
    before = {x: i for i, x in enumerate(after)}
    at, total, out = before.get(None), (0, 0, 0), []
    while at is not None:
        total = tuple(a + b for a, b in zip(total, weight[at], strict=True))
        out.append((ids[at], *total))
        at = before.get(ids[at])
    yield _batch("id arcs leaves saved", out, [_LONG] * 4)


def rank_list(items: DataFrame, blocks: list[Column], last: int = LAST) -> DataFrame:
    """``(id, arcs, leaves, saved)``: sums from each element to the list's end.

    ``items``: id, next (null at the end), arcs, leaves, saved, and the columns of ``blocks``
    (the first one; later ones may use ``id`` alone): elements of a block lie side by side often.
    """
    waiting = []
    for turn, block in enumerate(blocks):
        items, waits = _contract(items, block, f"stretch-{turn}")
        waiting.append(waits)
    turn = 0
    while items.count() > last:
        items, waits = _take_in(items, turn)
        waiting.append(waits)
        turn += 1
    one = items.select(F.lit(0).alias("block"), "id", "next", *_SUM).repartition(1)
    ranked = write_read(one.mapInArrow(_by_key(_walk), "id bigint, arcs bigint, leaves bigint, saved bigint"), "ranked")
    for waits in reversed(waiting):
        behind = ranked.select(F.col("id").alias("next"), *[F.col(c).alias(f"_{c}") for c in _SUM])
        back = waits.join(behind, "next", "left").select("id", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in _SUM])
        ranked = write_read(ranked.unionByName(back), "ranked")
    return ranked


# --- nodes ----------------------------------------------------------------------

def _chunk_batches(batches: Iterator[pa.RecordBatch]):
    """Sorted (node, conversation) rows of a part -> texts of ids, a node's in order."""
    node, held, size, seq, part = None, [], 0, 0, 0
    names, types = "d k1 k2 part seq ids", [_LONG, _LONG, _LONG, pa.int32(), _LONG, pa.string()]
    for b in batches:
        out = []
        for *key, conv, p in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            if key != node or size > CHUNK:
                if held:
                    out.append((*node, part, seq, ",".join(held)))
                node, held, size, seq, part = key, [], 0, seq + 1, p
            held.append(str(conv))
            size += len(held[-1]) + 1
        yield _batch(names, out, types)
    if held:
        yield _batch(names, [(*node, part, seq, ",".join(held))], types)


def _sha_batches(batches: Iterator[pa.RecordBatch]):
    node, sha = None, None
    names, types = "d k1 k2 ends_sha256", [_LONG, _LONG, _LONG, pa.string()]
    for b in batches:
        out = []
        for *key, ids in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            if key != node:
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield _batch(names, out, types)
    if node:
        yield _batch(names, [(*node, sha.hexdigest())], types)


def end_hashes(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node."""
    key = ["d", "k1", "k2"]
    cut = sorted_parts(rows.where("ends").select(*key, "conv_id"), [*key, "conv_id"], "ends")
    chunks = cut.repartition("part").sortWithinPartitions("part", "at").select(*key, "conv_id", "part").mapInArrow(
        frugal(_chunk_batches), "d bigint, k1 bigint, k2 bigint, part int, seq bigint, ids string")
    return chunks.repartition(*key).sortWithinPartitions(*key, "part", "seq").select(*key, "ids").mapInArrow(
        frugal(_sha_batches), "d bigint, k1 bigint, k2 bigint, ends_sha256 string")


def trie(conversations: DataFrame, last: int = LAST, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    rows = members(conversations)
    key = ["d", "k1", "k2"]
    nodes = rows.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
                                   F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    # Siblings side by side, the root first; ``pos`` is the node's number.
    nodes = numbered(nodes, ["d", "p1", "p2", "conv_id"], "nodes")
    nodes = write_read(nodes, "numbered")
    kids = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.min("pos").alias("first"), F.count(F.lit(1)).alias("n_children"))
    family = write_read(nodes.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "family")
    above = family.select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("pos").alias("parent"),
                          F.col("conv_id").alias("parent_conv_id"), (F.col("first") + F.col("n_children")).alias("stop"))
    tree = write_read(family.join(above, ["d", "p1", "p2"], "left"), "tree")

    enter, leave = F.col("pos") * 2, F.col("pos") * 2 + 1
    down = F.coalesce(F.col("first") * 2, leave)
    on = F.when(F.col("pos") + 1 < F.col("stop"), enter + 2).otherwise(F.col("parent") * 2 + 1)
    zero = F.lit(0).cast("long")
    path = F.xxhash64("conv_id", F.floor(F.col("d") / block).cast("long"))
    arc = lambda i, n, leaves, saved: F.struct(i.alias("id"), n.alias("next"), F.lit(1).cast("long").alias("arcs"), leaves.alias("leaves"), saved.alias("saved"))
    both = F.array(arc(enter, down, (F.col("n_children") == 0).cast("long"), F.col("saved")), arc(leave, on, zero, zero))
    arcs = tree.select(path.alias("path"), F.explode(both).alias("a")).select("path", "a.*")
    side = F.floor(F.col("id") / (2 * block)).cast("long")
    ranked = rank_list(arcs, [F.col("path"), side], last)
    entered = F.col("id") % 2 == 0
    part = lambda c: F.sum(F.when(entered, F.col(c)).otherwise(-F.col(c)))
    sums = ranked.groupBy(F.floor(F.col("id") / 2).cast("long").alias("pos")).agg(part("leaves").alias("n_leaves"), part("saved").alias("saved_tokens"))
    ends = end_hashes(rows)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return tree.join(sums, "pos").join(ends, key, "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


SQL = f"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
        sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, x, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS i FROM o),
c AS (SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {SHARED} AS h, conv_id - conv_id % {FAMILY} AS base FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, x, words, 0 AS own, i FROM c JOIN t ON t.conv_id = c.base AND t.i < c.h
      UNION ALL SELECT c.conv_id, x, words, 1, i FROM c JOIN t ON t.conv_id = c.conv_id AND t.i >= c.h),
q AS (SELECT conv_id, words, row_number() OVER w AS depth, sha256(string_agg(x, '') OVER w) AS k, count(*) OVER (PARTITION BY conv_id) AS n
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)),
m AS (SELECT conv_id, words, depth, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY depth), 'root') AS parent, depth = n AS ends FROM q
      UNION ALL SELECT conv_id, 0, 0, 'root', NULL, NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = c.conv_id) FROM c),
n AS (SELECT depth, k, max(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY depth, k),
kids AS (SELECT depth - 1 AS depth, parent AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY depth, parent),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, k)),
s AS (SELECT m.depth, m.k, count(*) FILTER (f.n_children = 0) AS n_leaves, sum(f.saved) AS saved_tokens
      FROM f JOIN m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.depth, m.k)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs, CAST(f.n_children AS BIGINT) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (depth, k) LEFT JOIN n AS p ON p.depth = f.depth - 1 AND p.k = f.parent"""


@register("op13_prefix_trie", SQL)
def op13_prefix_trie(spark, sf_dir) -> DataFrame:
    """The prefix trie of all rebuilt ``conversations``."""
    return trie(table(spark, sf_dir, "conversations"))
