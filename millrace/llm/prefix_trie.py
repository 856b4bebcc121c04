"""Operator 11: shared beginnings of conversations, in double-array tries by prefix shard.

A conversation is a path of turns (role and text); a node is a distinct beginning of paths, its members
the conversations that start with it.

* A turn becomes 16 bytes of its SHA-256 and its number of words; texts go no further.  Conversations with
  the same path become one row with their number, the smallest id and the hash of their ids,
  streamed in order, so that a common conversation is one row by then.
* Paths are dealt to shards by their first turn; where more than ``SHARD`` turns are below it, by their
  first two, four, eight and so on.  Paths that end before such a cut have no shard of their own.
* Each shard numbers its turns densely and packs its paths into a double-array trie: the child of
  state ``s`` by turn ``c`` is ``BASE[s] + c``, and is there if ``CHECK`` has ``s`` at that place.  Walking all
  paths through the arrays gives the members of each node, the states in reverse the sums below it.
* Nodes above a cut are shared by shards.  What shards and paths add to them is summed below hashes of the
  beginnings; words and leaves of the shared nodes themselves are counted once, on the path
  that has the smallest conversation, and summed from there up.

Cases: null role and text are empty; a turn without number comes first, turns with the same number
come in order of their hashes; turns without ``conv_id`` belong to no conversation; repeated rows are
turns each; a path may have no turns and then ends in the root; an empty table gives no rows; one
conversation is one row, and its hashes (not its texts) must fit into a task; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import importable, partitions, stored

#: Turns of distinct paths in a shard.
SHARD = 50_000
#: Free places that are tried for the children of a state before the end of the arrays.
TRIES = 64
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_NODE = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string())]
)
_MADE = pa.schema(
    [*_NODE, ("key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int64()), ("words", pa.int64())]
)
MADE = f"{NODE}, key binary, parent_key binary, shard long, words long"


def symbols(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``symbol`` (16 bytes that stand for role and text) and ``n_words`` of each turn."""
    importable(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("symbol"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
    )


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id`` with its turns in order: ``symbols`` and ``words``."""
    found = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "symbol", "n_words"))).alias("t"))
    return found.select("conv_id", F.col("t.symbol").alias("symbols"), F.col("t.n_words").alias("words"))


def continued(found: DataFrame, base: Column, turns: Column, most: int) -> DataFrame:
    """Paths that begin with the first ``turns`` (at most ``most``) of the conversation ``base``, and go on with what
    comes after as many of their own."""
    heads = found.select(
        F.col("conv_id").alias("base"), *(F.slice(c, 1, most).alias(f"head_{c}") for c in ("symbols", "words"))
    )
    own = found.withColumns({"base": base, "h": turns.cast("int")}).join(heads, "base", "left")

    def made(c):
        head = F.when(F.col(f"head_{c}").isNotNull(), F.slice(f"head_{c}", F.lit(1), F.col("h"))).otherwise(F.slice(c, 1, 0))
        return F.concat(head, F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1)))).alias(c)

    return own.select("conv_id", made("symbols"), made("words"))


def _prefix(depth: Column) -> Column:
    """A hash of the first turns of a path."""
    return F.unhex(F.substring(F.sha2(F.array_join(F.transform(F.slice("symbols", F.lit(1), depth), F.hex), ""), 256), 1, 32))


def _ended(found: DataFrame) -> DataFrame:
    """``conv_id`` (the smallest), ``n`` and ``ends``, the hash of their ids in order, of the conversations of each path."""

    def stream(batches):
        path, least, n, digest, rows = None, 0, 0, None, []
        for batch in batches:
            for p, c in zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist()):
                if p != path:
                    if path is not None:
                        rows.append((least, n, digest.hexdigest()))
                    path, least, n, digest = p, c, 0, hashlib.sha256()
                digest.update(b",%d" % c if n else b"%d" % c)
                n += 1
            if rows:
                yield _batch(rows, ended)
                rows = []
        if path is not None:
            yield _batch([(least, n, digest.hexdigest())], ended)

    ended = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    keyed = found.select(_prefix(F.size("symbols")).alias("path"), "conv_id")
    dealt = keyed.repartition(partitions(found.sparkSession), "path").sortWithinPartitions("path", "conv_id")
    return dealt.mapInArrow(stream, "conv_id long, n long, ends string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)


def _cut(distinct: DataFrame, shard: int) -> DataFrame:
    """Paths with the depth of their ``cut`` and the ``group`` of paths that share what is above it.

    A group has at most ``shard`` turns.  A path that ends above the cut of a larger group has its cut below its end.
    """
    rest, done, depth = distinct, [], 1
    while True:
        short = rest.where(F.size("symbols") < depth)
        done.append(short.select("*", (F.size("symbols") + 1).alias("cut"), F.lit(None).cast("binary").alias("group")))
        rest = rest.where(F.size("symbols") >= depth).withColumn("group", _prefix(F.lit(depth)))
        sums = rest.groupBy("group").agg(F.sum(F.size("symbols")).alias("turns"))
        large = stored(sums.where(F.col("turns") > shard).select("group", F.lit(True).alias("large")), "large")
        if large.isEmpty():
            done.append(rest.select(*distinct.columns, F.lit(depth).alias("cut"), "group"))
            return reduce(DataFrame.union, done)
        marked = stored(rest.join(large, "group", "left"), "cut")
        small = marked.where("large IS NULL")
        done.append(small.select(*distinct.columns, F.lit(depth).alias("cut"), "group"))
        rest = marked.where("large").select(*distinct.columns)
        depth *= 2


def double_array(found: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """BASE, CHECK and the states, parents first, of the trie of sorted paths of numbers from one; state 0 is the root."""
    base, check, order = [0], [0], [0]
    low = 1  # no place below it is free
    queue = [(0, 0, 0, len(found))]
    for state, depth, start, stop in queue:
        while start < stop and len(found[start]) == depth:
            start += 1
        if start == stop:
            continue
        children: list[tuple[int, int, int]] = []
        for i in range(start, stop):
            if not children or children[-1][0] != found[i][depth]:
                children.append((found[i][depth], i, i + 1))
            else:
                children[-1] = (found[i][depth], children[-1][1], i + 1)
        first, last = children[0][0], children[-1][0]
        while low < len(check) and check[low] >= 0:
            low += 1
        place, tries = max(low, first), 0
        while True:
            if tries == TRIES:
                place = max(len(check), first)
            free = (place + c - first >= len(check) or check[place + c - first] < 0 for c, *_ in children)
            if all(free):
                break
            place, tries = place + 1, tries + 1
        need = place + last - first + 1 - len(check)
        if need > 0:
            check.extend([-1] * need)
            base.extend([0] * need)
        base[state] = place - first
        for c, a, b in children:
            check[base[state] + c] = state
            order.append(base[state] + c)
            queue.append((base[state] + c, depth + 1, a, b))
    return base, check, order


def shard_nodes(rows: list[tuple]):
    """The nodes of a shard, and what it adds to the nodes above its cuts, as rows of ``MADE``.

    ``rows`` are (smallest conversation, number, hash of ids, symbols, words, cut) of distinct paths.
    """
    numbers: dict = {}
    listed = []
    for row in rows:
        _, _, _, turns, _, cut = row
        if len(turns) < cut:
            yield from _above(row)
        else:
            listed.append(([numbers.setdefault(x, len(numbers) + 1) for x in (b"".join(turns[:cut]), *turns[cut:])], row))
    listed.sort(key=lambda x: x[0])
    if not listed:
        return
    base, check, order = double_array([x for x, _ in listed])
    size = len(check)
    members, least, words, depths, ends = [0] * size, [0] * size, [0] * size, [0] * size, [NOTHING] * size
    for codes, (conv, n, end, _, w, cut) in listed:
        state = 0
        for k, c in enumerate(codes):
            child = base[state] + c
            if check[child] != state:
                raise AssertionError("a path is not in its trie")
            state = child
            if not members[state]:
                least[state], words[state], depths[state] = conv, w[cut + k - 1], cut + k
            members[state] += n
            least[state] = min(least[state], conv)
        ends[state] = end
    children, leaves, every, once = [0] * size, [0] * size, [0] * size, [0] * size
    for state in reversed(order[1:]):
        every[state] += members[state] * words[state]
        once[state] += words[state]
        leaves[state] = leaves[state] or 1
        above = check[state]
        children[above] += 1
        if above:
            every[above] += every[state]
            once[above] += once[state]
            leaves[above] += leaves[state]
    tops = {}
    for codes, row in listed:
        tops.setdefault(base[0] + codes[0], row)
    for state in order[1:]:
        above = check[state]
        row, key = tops.get(state), None
        if row:
            yield from _above((least[state], members[state], None, row[3], row[4], row[5]), every[state], once[state], leaves[state])
            key = _keys(row[3][: row[5] - 1])[-1]
        yield (
            least[state], depths[state], least[above] if above else None, members[state], children[state],
            leaves[state], every[state] - once[state], ends[state], None, key, None, None,
        )


def _keys(turns: list[bytes]) -> list[bytes]:
    """The hashes of the beginnings of a path, the empty one first."""
    keys = [b""]
    for turn in turns:
        keys.append(hashlib.sha256(keys[-1] + turn).digest()[:16])
    return keys


def _above(row: tuple, every: int = 0, once: int = 0, leaves: int = 0):
    """What the paths below a cut, or one that ends above it, add to the nodes above it.

    Columns are those of a node, but ``n_children`` has only children at the cut, ``n_leaves`` and ``saved_tokens`` only
    what is below it and what grows with the members: the words of the nodes themselves are taken off later.
    """
    conv, n, end, turns, words, cut = row
    keys = _keys(turns[: cut - 1])
    for depth in range(cut - 1, -1, -1):
        w = words[depth - 1] if depth else 0
        every += n * w
        last = depth == cut - 1
        yield (
            conv, depth, None, n, int(last and len(turns) >= cut), leaves, every - once, end if last and len(turns) < cut else None,
            keys[depth], keys[depth - 1] if depth else None, conv, w,
        )


def _merged(added: DataFrame) -> DataFrame:
    """Nodes above cuts, with ``key`` and ``parent_key``, from what is added to them."""
    sums = added.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.coalesce(F.max("ends_sha256"), F.lit(NOTHING)).alias("ends_sha256"),
    )
    sums = stored(sums, "sums")
    more = sums.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    sums = stored(sums.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))), "upper")
    # each node counts once, on the path of its smallest conversation
    own = sums.select("key", F.col("conv_id").alias("shard"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    rows = added.select("key", "shard", "depth", "words").join(own, ["key", "shard"], "left")
    up = Window.partitionBy("shard").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "key",
        F.sum(F.when(F.col("leaf").isNotNull(), F.col("words")).otherwise(0)).over(up).alias("once"),
        F.sum(F.coalesce("leaf", F.lit(0))).over(up).alias("leaf"),
    )
    rows = rows.groupBy("key").agg(F.sum("once").alias("once"), F.sum("leaf").alias("leaf"))
    found = sums.join(rows, "key")
    return found.withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") - F.col("once")})


def nodes(found: DataFrame, shard: int = SHARD) -> DataFrame:
    """Every node of the trie of ``conv_id`` and its ``symbols`` and ``words``: its smallest member, depth, parent, numbers of
    members, children and leaves, the words that sharing saves below it, and the hash of the ids that end there."""
    spark = found.sparkSession
    found = stored(found, "paths")
    distinct = stored(found.join(_ended(found), "conv_id"), "distinct")
    turns = distinct.agg(F.sum(F.size("symbols"))).first()[0] or 0
    buckets = -(-turns // shard) or 1
    bucket = F.pmod(F.xxhash64(F.coalesce("group", F.col("conv_id").cast("string").cast("binary"))), F.lit(buckets))

    def build(batches):
        def shards():
            number, held = None, []
            for batch in batches:
                for row in zip(*(batch[c].to_pylist() for c in ("bucket", "conv_id", "n", "ends", "symbols", "words", "cut"))):
                    if row[0] != number:
                        if held:
                            yield held
                        number, held = row[0], []
                    held.append(row[1:])
            if held:
                yield held

        for rows in shards():
            made = []
            for row in shard_nodes(rows):
                made.append(row)
                if len(made) == 8192:
                    yield _batch(made, _MADE)
                    made = []
            if made:
                yield _batch(made, _MADE)

    dealt = _cut(distinct, shard).withColumn("bucket", bucket)
    dealt = dealt.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    made = stored(dealt.mapInArrow(build, MADE), "made")
    upper = stored(_merged(made.where("shard IS NOT NULL")), "merged")
    parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    lower = made.where("shard IS NULL").select(*_NODE.names, "parent_key")
    top = upper.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*_NODE.names, "parent_key")
    tops = lower.where("parent_key IS NOT NULL").union(top).join(parents, "parent_key", "left")
    tops = tops.withColumn("parent_conv_id", F.col("above")).select(*_NODE.names)
    return lower.where("parent_key IS NULL").select(*_NODE.names).union(tops)
