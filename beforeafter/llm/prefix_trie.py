"""Prefix tries of conversations: ternary search trees per range shard, shards merged at their edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.ranks import numbered
from beforeafter.llm.text import word_count
from beforeafter.staging import broadcast_if_small, stage

#: Turns of a conversation that one row holds; longer ones go on in further segments.
SEGMENT_TURNS = 64
#: Nodes of one search tree at most (and one sequence beyond), and turns dealt to a task.
TREE_TURNS = 1 << 15
TASK_TURNS = 1 << 20
#: Conversation ids are listed in blocks of so many, as a power of two.
BLOCK_BITS = 12
#: Stands for no member: a null would turn Arrow's lists of numbers into floats.
NOBODY = (1 << 63) - 1

_RECORD = (
    "state long, ids array<long>, words array<long>, start int, n array<long>, member array<long>, "
    "kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
)
_OUT = (
    "depth int, parent long, parent_at string, at string, one_member long, one_n long, one_kids long, one_leaves long, "
    f"one_saved long, one_ends string, {_RECORD}"
)


def coded_turns(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``pos`` (0, 1, ... in each conversation), ``id`` and ``words``.

    Turns are ordered by the turn column, nulls first; ties by a digest of role and
    text, so that reruns agree. ``id`` is the dictionary's number of a (role, text),
    null counting as empty; ``words`` is the number of words of the text. Rows without
    a conversation id are left out. A conversation may hold any share of the rows.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = df.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        key.alias("key"),
        word_count(text).alias("words"),
    )
    turns = numbered(stage(turns, "trie-turns"), [F.col("turn").asc_nulls_first(), F.col("key")], ["conv_id"], "pos")
    turns = stage(turns.drop("turn"), "trie-numbered")
    dictionary = turns.select("key").distinct().select("key", F.monotonically_increasing_id().alias("id"))
    dictionary = broadcast_if_small(stage(dictionary, "trie-dictionary"))
    return stage(turns.join(dictionary, "key").select("conv_id", "pos", "id", "words"), "trie-coded")


def grafted(coded: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns in which each conversation's first ``head`` ones are replaced by those of
    its ``base`` (all if that has fewer, none if it is absent), and all ``conv_id``.

    ``base`` and ``head`` are expressions of ``conv_id``; ``head`` is at most ``most``.
    """
    ids = coded.select("conv_id").distinct()
    plan = stage(ids.select("conv_id", base.alias("base"), head.cast("long").alias("head")), "trie-plan")
    wanted = plan.select(F.col("base").alias("conv_id")).distinct()
    heads = coded.filter(F.col("pos") < most).join(broadcast_if_small(wanted), "conv_id", "left_semi")
    heads = heads.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("turns"))
    heads = heads.withColumnRenamed("conv_id", "base")
    taken = F.slice(F.col("turns"), F.lit(1), F.col("head").cast("int"))
    plan = stage(
        plan.join(heads, "base", "left").select(
            "conv_id", "head", F.coalesce(taken, F.array().cast("array<struct<pos:bigint,id:bigint,words:bigint>>")).alias("taken")
        ),
        "trie-heads",
    )
    shift = plan.select("conv_id", "head", F.size("taken").alias("shift"))
    own = coded.join(broadcast_if_small(shift), "conv_id").filter(F.col("pos") >= F.col("head"))
    own = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("shift")).alias("pos"), "id", "words")
    return plan.select("conv_id", F.expr("inline(taken)")).unionByName(own), plan.select("conv_id")


class SearchTree:
    """A ternary search tree of sequences: one node per prefix, siblings in a binary tree.

    All arrays run over nodes in order of creation, so a prefix precedes what extends it.
    """

    def __init__(self) -> None:
        self.symbol: list[int] = []
        self.less: list[int] = []
        self.more: list[int] = []
        self.below: list[int] = []
        self.up: list[int] = []
        self.depth: list[int] = []
        self.words: list[int] = []
        self.n: list[int] = []
        self.member: list[int] = []
        self.kids: list[int] = []
        self.leaves: list[int] = []
        self.saved: list[int] = []
        self.ends: list[str | None] = []
        self.top = -1

    def _create(self, symbol: int, up: int, words: int) -> int:
        self.symbol.append(symbol)
        for links in (self.less, self.more, self.below):
            links.append(-1)
        self.up.append(up)
        self.depth.append(0 if up < 0 else self.depth[up] + 1)
        self.words.append(words)
        for sums in (self.n, self.kids, self.leaves, self.saved):
            sums.append(0)
        self.member.append(NOBODY)
        self.ends.append(None)
        return len(self.symbol) - 1

    def insert(self, symbols: list[int], words: list[int]) -> list[int]:
        """The nodes of all prefixes of the sequence, shortest first."""
        path: list[int] = []
        up = -1
        for symbol, n_words in zip(symbols, words):
            at = self.top if up < 0 else self.below[up]
            if at < 0:
                at = self._create(symbol, up, n_words)
                if up < 0:
                    self.top = at
                else:
                    self.below[up] = at
            while self.symbol[at] != symbol:
                side = self.less if symbol < self.symbol[at] else self.more
                if side[at] < 0:
                    side[at] = self._create(symbol, up, n_words)
                at = side[at]
            path.append(at)
            up = at
        return path

    def add(self, path: list[int], record) -> None:
        """Adds what the record says about the prefixes from its ``start`` on."""
        for i, at in enumerate(path[record.start :]):
            self.n[at] += int(record.n[i])
            self.member[at] = min(self.member[at], int(record.member[i]))
            self.kids[at] += int(record.kids[i])
            self.leaves[at] += int(record.leaves[i])
            self.saved[at] += int(record.saved[i])
            if record.ends[i] is not None:
                self.ends[at] = record.ends[i]

    def accumulate(self, is_open: set[int]) -> None:
        """Hands members, children, leaves and savings of each node up, last node first.
        Open nodes, all of whose prefixes are open too, keep theirs."""
        for at in range(len(self.symbol) - 1, -1, -1):
            if at in is_open:
                continue
            self.saved[at] += (self.n[at] - 1) * self.words[at]
            if not self.kids[at]:
                self.leaves[at] += 1
            up = self.up[at]
            if up >= 0:
                self.n[up] += self.n[at]
                self.member[up] = min(self.member[up], self.member[at])
                self.kids[up] += 1
                self.leaves[up] += self.leaves[at]
                self.saved[up] += self.saved[at]

    def digests(self, nodes) -> dict[int, str]:
        """A name for each prefix; ``nodes`` ascend and hold all prefixes of theirs."""
        found: dict[int, str] = {}
        for at in nodes:
            head = found.get(self.up[at], "")
            found[at] = hashlib.sha256(f"{head},{self.symbol[at]}".encode()).hexdigest()
        return found


def _medians(n: int) -> Iterator[int]:
    """0 .. n-1, the middle first, then the middles of both halves, and so on."""
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            todo += [(mid + 1, b), (a, mid)]


def _solved(records: list, whole: bool, named: bool) -> tuple[list[tuple], list[tuple]]:
    """Finished nodes and the two edge paths of one shard of sorted sequences.

    What precedes or follows the shard can only extend prefixes of its first and last
    sequence: these stay open, unless the shard is ``whole``. ``named``: give finished
    nodes their digests, as shards asked for them before.
    """
    tree = SearchTree()
    paths: dict[int, list[int]] = {}
    for i in _medians(len(records)):
        r = records[i]
        path = tree.insert([int(r.state), *map(int, r.ids)], [0, *map(int, r.words)])
        tree.add(path, r)
        if i in (0, len(records) - 1):
            paths[i] = path
    is_open = set() if whole else {at for path in paths.values() for at in path}
    tree.accumulate(is_open)
    names = tree.digests(range(len(tree.symbol))) if named else tree.digests(sorted(is_open))
    state = {}
    nodes = []
    for at, up in enumerate(tree.up):
        state[at] = tree.symbol[at] if up < 0 else state[up]
        if at not in is_open:
            open_up = up in is_open
            nodes.append((
                tree.depth[at], None if up < 0 or open_up else tree.member[up], names[up] if open_up else None, names.get(at) if named else None,
                tree.member[at], tree.n[at], tree.kids[at], tree.leaves[at], tree.saved[at], tree.ends[at], state[at], *[None] * 9,
            ))
    edges, done = [], set()
    for i, path in sorted(paths.items()) if not whole else ():
        mine = [at for at in path if at not in done]
        done.update(mine)
        sums = [[column[at] for at in mine] for column in (tree.n, tree.member, tree.kids, tree.leaves, tree.saved, tree.ends)]
        edges.append((*[None] * 10, int(records[i].state), list(map(int, records[i].ids)), list(map(int, records[i].words)), len(path) - len(mine), *sums))
    return nodes, edges


def _solve(whole: bool, named: bool, tree_turns: int):
    names = [field.split(" ")[0] for field in _OUT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        turns = 0
        for batch in batches:
            for record in batch.itertuples(index=False):
                held.append(record)
                turns += len(record.ids) + 1
                if turns >= tree_turns and not whole:
                    nodes, edges = _solved(held, whole, named)
                    yield pd.DataFrame(nodes + edges, columns=names, dtype=object)
                    held, turns = [], 0
        if held:
            nodes, edges = _solved(held, whole, named)
            yield pd.DataFrame(nodes + edges, columns=names, dtype=object)

    return run


def _forest(records: DataFrame, tree_turns: int) -> DataFrame:
    """All nodes of the tries of ``records``, one trie per state: state, depth, conv_id,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends.

    Sequences are dealt by range and cut into shards of bounded size. Each shard is
    solved by itself but for the prefixes of its first and last sequence, which go to
    the next round as two sequences with the sums so far; rounds shrink by some
    hundred times, until one shard holds all.
    """
    spark = records.sparkSession
    found: list[DataFrame] = []
    last = None
    while True:
        turns = records.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
        whole = turns <= tree_turns
        if last is not None and not whole and turns >= last:
            raise ArithmeticError("shards hold too few sequences to shrink: raise tree_turns")
        order = ("state", "ids")
        if whole:
            dealt = records.coalesce(1)
        else:
            many = -(-turns // tree_turns)
            if last is None:
                many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TASK_TURNS))
            dealt = records.repartitionByRange(many, *order)
        solved = dealt.sortWithinPartitions(*order).mapInPandas(_solve(whole, last is not None, tree_turns), _OUT)
        solved = stage(solved, "trie-shards")
        found.append(solved.filter(F.col("one_n").isNotNull()))
        if whole:
            break
        last = turns
        records = solved.filter(F.col("one_n").isNull()).select(*[f.split(" ")[0] for f in _RECORD.split(", ")])
    nodes = reduce(DataFrame.unionByName, found)
    edges = reduce(DataFrame.unionByName, found[1:], found[0].limit(0)).select(
        F.col("at").alias("parent_at"), F.col("one_member").alias("edge_member")
    )
    nodes = nodes.select(
        "state", "depth", F.col("one_member").alias("conv_id"), "parent", "parent_at", F.col("one_n").alias("n_convs"),
        F.col("one_kids").alias("n_children"), F.col("one_leaves").alias("n_leaves"), F.col("one_saved").alias("saved_tokens"),
        F.col("one_ends").alias("ends"),
    )
    inner = nodes.filter(F.col("parent_at").isNull()).drop("parent_at").withColumnRenamed("parent", "parent_conv_id")
    outer = nodes.filter(F.col("parent_at").isNotNull()).join(broadcast_if_small(edges), "parent_at", "left")
    return inner.unionByName(outer.drop("parent_at", "parent").withColumnRenamed("edge_member", "parent_conv_id"))


def _end_digests(ended: DataFrame) -> DataFrame:
    """``key`` and ``ends``: SHA-256 of the ascending ids of each key, joined by commas.

    Ids are listed in blocks first; a task reads a key's blocks in order as a stream,
    so a key that holds a third of all conversations takes few rows and no memory.
    """
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    blocks = ended.groupBy("key", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(ids.alias("listed"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sha = None, None
        for batch in batches:
            done = []
            for k, listed in zip(batch["key"], batch["listed"]):
                if k != key:
                    if sha is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(listed.encode())
                else:
                    sha.update(b"," + listed.encode())
            yield pd.DataFrame(done, columns=["key", "ends"])
        if sha is not None:
            yield pd.DataFrame([(key, sha.hexdigest())], columns=["key", "ends"])

    ordered = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "listed")
    return ordered.mapInPandas(digest, "key string, ends string")


def nodes(
    turns: DataFrame, convs: DataFrame, segment_turns: int = SEGMENT_TURNS, tree_turns: int = TREE_TURNS
) -> DataFrame:
    """One row per node of the prefix trie of all conversations.

    ``turns`` has ``conv_id``, ``pos``, ``id``, ``words`` as ``coded_turns`` gives them;
    ``convs`` lists each ``conv_id`` once, those without turns too. A node is a distinct
    sequence of first turns, from the empty one, the root; its members are the
    conversations that start with it. Columns: ``conv_id`` (least member), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``
    (childless nodes of its subtree, itself included), ``saved_tokens`` (over its
    subtree, a node's members less one times the words of its last turn) and
    ``ends_sha256`` (of the ascending ids of members that end at it, joined by commas).
    Without any conversation there is no node.

    Sequences are cut into segments, so a row stays bounded however long a conversation
    is: equal first segments form a group, and the next segments of its members a trie
    below the node it ends at, known by its least member. A conversation that is alone
    in its group shares nothing further: its remaining nodes are written out directly.
    Segments are solved from the deepest to the first, each handing its roots' sums up.
    """
    sized = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    no = F.expr(f"pos div {segment_turns}")
    rows = turns.groupBy("conv_id", no.alias("seg")).agg(F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("t"))
    final = F.expr(f"(coalesce(_n, 1) - 1) div {segment_turns}")
    first = convs.join(sized, "conv_id", "left").select("conv_id", final.alias("final"), F.coalesce("_n", F.lit(0)).alias("_n"))
    segments = first.join(rows, "conv_id", "left").select(
        "conv_id",
        F.coalesce("seg", F.lit(0)).cast("long").alias("seg"),
        (F.coalesce("seg", F.lit(0)) == F.col("final")).alias("last"),
        *[F.coalesce(F.col("t")[c], F.array().cast("array<bigint>")).alias(a) for c, a in (("id", "ids"), ("words", "words"))],
    )
    segments = stage(segments, "trie-segments")

    groups: list[DataFrame] = []
    alone: list[DataFrame] = []
    current = segments.filter("seg = 0").withColumn("state", F.lit(0).cast("long"))
    while True:
        listed = F.concat_ws(",", F.col("state").cast("string"), F.array_join(F.col("ids").cast("array<string>"), ","))
        keyed = stage(current.withColumn("key", F.sha2(listed, 256)), "trie-keyed")
        grouped = keyed.groupBy("key").agg(
            *[F.first(c).alias(c) for c in ("state", "ids", "words")],
            F.count(F.lit(1)).alias("n"),
            F.min("conv_id").alias("member"),
            F.bool_and("last").alias("all_end"),
        )
        ended = _end_digests(keyed.filter("last").select("key", "conv_id"))
        grouped = stage(grouped.join(ended, "key", "left"), "trie-groups")
        groups.append(grouped)
        going = keyed.filter("NOT last").select("conv_id", "key")
        if going.isEmpty():
            break
        going = stage(going.join(grouped.select("key", "n", "member"), "key").drop("key"), "trie-going")
        alone.append(going.filter("n = 1").select("conv_id", F.lit(len(groups)).alias("from")))
        shared = going.filter("n > 1").select("conv_id", F.col("member").alias("state"))
        if shared.isEmpty():
            break
        current = segments.filter(F.col("seg") == len(groups)).join(broadcast_if_small(shared), "conv_id")

    out: list[DataFrame] = []
    roots = None
    for k in range(len(groups) - 1, -1, -1):
        solo = (~F.col("all_end")) & (F.col("n") == 1)
        tails = groups[k].withColumn("one", F.when(solo, 1).otherwise(0).cast("long"))
        if roots is not None:
            tails = tails.join(broadcast_if_small(roots), "member", "left")
            more = [F.coalesce(c, F.lit(0)) for c in ("root_kids", "root_leaves", "root_saved")]
        else:
            more = [F.lit(0).cast("long")] * 3
        records = tails.select(
            "state", "ids", "words", F.size("ids").alias("start"), F.array("n").alias("n"), F.array("member").alias("member"),
            F.array(F.col("one") + more[0]).alias("kids"), F.array(F.col("one") + more[1]).alias("leaves"),
            F.array(more[2]).alias("saved"), F.array("ends").alias("ends"),
        )
        solved = _forest(stage(records, "trie-records"), tree_turns)
        if k:
            solved = stage(solved, "trie-solved")
            roots = solved.filter("depth = 0").select(
                F.col("state").alias("member"), F.col("n_children").alias("root_kids"),
                F.col("n_leaves").alias("root_leaves"), F.col("saved_tokens").alias("root_saved"),
            )
            # The node above is known by its least member, which may have ended there.
            parent = F.when(F.col("depth") == 1, F.col("state")).otherwise(F.col("parent_conv_id"))
            solved = solved.filter("depth > 0").withColumn("parent_conv_id", parent)
        out.append(solved.withColumn("depth", F.col("depth").cast("long") + k * segment_turns).drop("state"))
    for lone in alone:
        out.append(_lone_nodes(segments.join(broadcast_if_small(lone), "conv_id").filter(F.col("seg") >= F.col("from")), segment_turns))
    every = reduce(DataFrame.unionByName, out)
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _lone_nodes(segments: DataFrame, segment_turns: int) -> DataFrame:
    """The nodes that only one conversation reaches, one per turn."""
    turns = segments.select("conv_id", "seg", "last", F.size("ids").alias("size"), F.posexplode("ids").alias("i", "id"))
    end = F.col("last") & (F.col("i") == F.col("size") - 1)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return turns.select(
        "conv_id",
        (F.col("seg") * segment_turns + F.col("i") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(end, none).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        none.alias("saved_tokens"),
        F.when(end, F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends"),
    )
