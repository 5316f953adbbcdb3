"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a sequence of turns; its key is its depth and 128 bits, the exclusive or
of a hash of each turn with its place, so keys come from running sums that need no
conversation in one task. Nodes are sorted by reverse level order; each takes the
totals that its children have sent, from a priority queue that spills to sorted
runs, and sends its own to its parent. Subtrees of limited weight are shards,
processed side by side; the nodes above them form bands of levels, processed in
the same way within each band, then across the bands' roots, then once more with
what the roots have sent.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD_GAP, batch_of, numbered, pieces, staged

KEY = ["depth", "x", "y"]
NO_ENDS = hashlib.sha256().hexdigest()
#: Turns of one conversation that are summed up in one window.
STRETCH = 4096


class SpillingQueue:
    """Messages in order of their keys; beyond ``most`` in memory they go to sorted runs on disk.

    Runs are unnamed temporary files of the task: nothing outlives it, and a
    repeated task makes its own.
    """

    def __init__(self, most: int = 200_000):
        self.most, self.held, self.runs = most, [], []

    def push(self, key: tuple, leaves: int, saved: int) -> None:
        heapq.heappush(self.held, (key, leaves, saved))
        if len(self.held) > self.most:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for message in sorted(self.held):
            pickle.dump(message, file)
        pickle.dump(None, file)
        file.seek(0)
        self.held = []
        self._next(file)

    def _next(self, file) -> None:
        message = pickle.load(file)
        if message is None:
            file.close()
        else:
            heapq.heappush(self.runs, (message, id(file), file))

    def take(self, key: tuple) -> tuple[int, int]:
        """Sums of all messages for ``key``; keys must be asked for in rising order."""
        leaves = saved = 0
        while self.held and self.held[0][0] == key:
            _, a, b = heapq.heappop(self.held)
            leaves, saved = leaves + a, saved + b
        while self.runs and self.runs[0][0][0] == key:
            (_, a, b), _, file = heapq.heappop(self.runs)
            leaves, saved = leaves + a, saved + b
            self._next(file)
        return leaves, saved


_TOTALS = pa.schema(
    [(c, pa.int64()) for c in ("depth", "x", "y", "leaves", "saved", "up_depth", "up_x", "up_y")]
)


def _forward(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Totals of nodes sorted by reverse level order; a shard's root also names its parent.

    Columns: key, parent's key, whether the parent is of the same shard, own leaves
    and own saved tokens, both with what has come from other shards.
    """
    queue = SpillingQueue(most)
    for batch in pieces(batches, 8192):
        rows = []
        for depth, x, y, px, py, inside, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
            more_leaves, more_saved = queue.take((-depth, x, y))
            leaves, saved = leaves + more_leaves, saved + more_saved
            if inside:
                queue.push((1 - depth, px, py), leaves, saved)
            up = (depth - 1, px, py) if not inside and depth > 0 else (None, None, None)
            rows.append((depth, x, y, leaves, saved, *up))
        if rows:
            yield batch_of(_TOTALS, *zip(*rows))


def time_forward(nodes: DataFrame, shard: list[str], most: int = 200_000) -> DataFrame:
    """``depth, x, y, leaves, saved`` of each node, and ``up_*``, the parent's key, for roots of shards.

    ``nodes`` has the key, ``px, py`` of the parent, ``inside`` (the parent is in
    the same shard), ``leaves`` and ``saved``. All nodes of a shard meet in one
    task, which streams them in sorted order; their number is the caller's matter.
    """
    chosen = [*KEY, "px", "py", "inside", "leaves", "saved"]
    dealt = nodes.repartition(*shard) if shard else nodes.repartition(1)
    return (
        dealt.select(*chosen)
        .sortWithinPartitions(F.desc("depth"), "x", "y")
        .mapInArrow(lambda batches: _forward(batches, most), ", ".join(f"{f.name} long" for f in _TOTALS))
    )


def _digest(names: tuple[str, ...]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    return F.sha2(F.concat(F.char_length(parts[0]).cast("string"), F.lit(":"), *parts), 256)


def _turns(df: DataFrame) -> DataFrame:
    """``c, pos, digest, words``: numbered turns; the text itself is left behind."""
    gap = WORD_GAP.replace("[", "[^") + "+"
    rows = df.select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").cast("long").alias("turn"),
        _digest(("role", "text")).alias("digest"),
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(gap)).cast("long").alias("words"),
    ).filter("c is not null")
    bucket = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62)))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    return numbered(rows, order, bucket, "pos", within=["c"]).select("c", "pos", "digest", "words")


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share the opening of another, as ``c, pos, digest, words`` and ``c, n``.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % group``
    (``h`` is the crc32 of the decimal ``c`` modulo ``heads``), then its own turns
    after its first ``h``. Turns are ordered with null first; equal ones by a hash
    of role and text. Rows without a conversation id belong to no conversation.
    """
    turns = staged(_turns(conversations), "turns")
    h = F.crc32(F.col("c").cast("string").cast("binary")) % heads
    sizes = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    sized = staged(sizes.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % group).alias("base")), "sizes")
    bases = sized.filter("c = base").select("base", F.col("n").alias("base_n"))
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = sized.join(bases, "base", "left").select("c", "n", "h", "base", shared.alias("shared"))
    opening = turns.filter((F.col("pos") < heads) & (F.col("c") % group == 0)).withColumnRenamed("c", "base")
    lent = convs.join(opening, "base").filter("pos < shared").select("c", "pos", "digest", "words")
    own = turns.join(convs.select("c", "h", "shared"), "c").filter("pos >= h")
    kept = own.select("c", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "digest", "words")
    lengths = convs.select("c", (F.col("shared") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n"))
    return lent.unionByName(kept), lengths


def _paths(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``c, n, depth, x, y, px, py, words``: the node that each conversation is in at each depth, the root included."""
    terms = turns.select(
        "c", "pos", "words", F.floor(F.col("pos") / STRETCH).alias("part"),
        F.xxhash64("pos", "digest").alias("tx"), F.xxhash64("digest", F.lit("y"), "pos").alias("ty"),
    )
    inner = Window.partitionBy("c", "part").orderBy("pos")
    run = terms.withColumns({v: F.bit_xor(t).over(inner) for v, t in (("vx", "tx"), ("vy", "ty"))})
    whole = terms.groupBy("c", "part").agg(F.bit_xor("tx").alias("bx"), F.bit_xor("ty").alias("by"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select("c", "part", *[F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias(b) for b in ("bx", "by")])
    placed = run.join(starts.filter("part > 0"), ["c", "part"], "left").join(lengths, "c")
    x = F.col("vx").bitwiseXOR(F.coalesce("bx", F.lit(0)))
    y = F.col("vy").bitwiseXOR(F.coalesce("by", F.lit(0)))
    deep = placed.select(
        "c", "n", (F.col("pos") + 1).alias("depth"), x.alias("x"), y.alias("y"),
        x.bitwiseXOR(F.col("tx")).alias("px"), y.bitwiseXOR(F.col("ty")).alias("py"), "words",
    )
    nothing = F.lit(0).cast("long")
    roots = lengths.select("c", "n", *[nothing.alias(c) for c in ("depth", "x", "y", "px", "py", "words")])
    return deep.unionByName(roots)


def _ends(batches: Iterator[pa.RecordBatch], size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Ids of one node, in order, joined into lists of some ``size`` bytes."""
    kind = pa.schema([(c, pa.int64()) for c in (*KEY, "first")] + [("ids", pa.string())])
    node, first, ids, held = None, None, [], 0
    done = []
    for batch in pieces(batches, 8192):
        for *key, c in zip(*(x.to_pylist() for x in batch.columns)):
            if key != node or held > size:
                if ids:
                    done.append((*node, first, ",".join(ids)))
                node, first, ids, held = key, c, [], 0
            ids.append(str(c))
            held += len(ids[-1]) + 1
        if done:
            yield batch_of(kind, *zip(*done))
            done = []
    if ids:
        yield batch_of(kind, *zip((*node, first, ",".join(ids))))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists, one after the other."""
    kind = pa.schema([(c, pa.int64()) for c in KEY] + [("ends_sha256", pa.string())])
    node, state = None, None
    for batch in pieces(batches, 64):
        done = []
        for *key, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
            if key != node:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode("ascii"))
        if done:
            yield batch_of(kind, *zip(*done))
    if node:
        yield batch_of(kind, *zip((*node, state.hexdigest())))


def ends(paths: DataFrame) -> DataFrame:
    """``depth, x, y, ends_sha256`` of the nodes where conversations end.

    Ids are dealt out by node and id and joined into lists first, so a node where
    a third of all conversations ends is sorted by many tasks, and the task that
    hashes it streams a few long rows.
    """
    done = paths.filter("depth = n").select(*KEY, "c")
    number = max(1, int(done.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lists = (
        done.repartitionByRange(number, *KEY, "c")
        .sortWithinPartitions(*KEY, "c")
        .mapInArrow(_ends, "depth long, x long, y long, first long, ids string")
    )
    return (
        lists.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first")
        .mapInArrow(_hashes, "depth long, x long, y long, ends_sha256 string")
    )


def _totals(nodes: DataFrame, paths: DataFrame, limit: int, band: int, most: int) -> DataFrame:
    """``depth, x, y, n_leaves, saved_tokens`` of every node.

    A node's weight is the number of its members' turns from it on, never less
    than the nodes below it. Nodes beyond ``limit`` are heavy. Their children
    within it are roots of shards.
    """
    heavy = nodes.filter(F.col("weight") > limit)
    light = nodes.filter(F.col("weight") <= limit)
    # a path is heavy down to some depth and light from there on
    on = paths.select("c", *KEY).join(heavy.select(*KEY), KEY, "left_semi").groupBy("c").agg(F.count(F.lit(1)).alias("cut"))
    cut = paths.select("c", *KEY).join(on, "c", "left").filter(F.col("depth") == F.coalesce("cut", F.lit(0)))
    shards = cut.select("c", F.col("depth").alias("s_depth"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    inside = light.join(shards, light.conv_id == shards.c).withColumn("inside", F.col("depth") > F.col("s_depth"))
    low = staged(time_forward(inside, ["s_depth", "sx", "sy"], most), "light")
    sent = _sent(low)

    top = heavy.withColumn("s_depth", F.col("depth") - F.col("depth") % band)
    anchors = paths.filter(F.col("depth") % band == 0).select("c", F.col("depth").alias("s_depth"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    banded = top.join(anchors, (top.conv_id == anchors.c) & (top.s_depth == anchors.s_depth)).drop(anchors.s_depth)
    banded = _with(banded.withColumn("inside", F.col("depth") > F.col("s_depth")), sent)
    banded = staged(banded.select(*KEY, "px", "py", "inside", "leaves", "saved", "s_depth", "sx", "sy"), "bands")
    alone = staged(time_forward(banded, ["s_depth", "sx", "sy"], most), "alone")
    # across roots: a band's root sends its total to the root of the band that holds its parent
    homes = banded.select(*[F.col(k).alias(f"up_{k}") for k in KEY], *[F.col(c).alias(f"h{c}") for c in ("sx", "sy")])
    roots = alone.filter("up_depth is not null").join(homes, ["up_depth", "up_x", "up_y"])
    tree = roots.select(
        (F.col("depth") / band).cast("long").alias("depth"), "x", "y", F.col("hsx").alias("px"), F.col("hsy").alias("py"),
        (F.col("depth") > band).alias("inside"), "leaves", "saved",
    )
    across = time_forward(tree, [], most).select((F.col("depth") * band).alias("depth"), "x", "y", "leaves", "saved")
    further = roots.select(*KEY, "up_depth", "up_x", "up_y").join(across, KEY)
    high = time_forward(_with(banded, _sent(further)), ["s_depth", "sx", "sy"], most)
    return low.unionByName(high).select(*KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def _sent(totals: DataFrame) -> DataFrame:
    """Totals of shard roots, added up per parent."""
    up = totals.filter("up_depth is not null").groupBy("up_depth", "up_x", "up_y")
    summed = up.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    return summed.select(*[F.col(f"up_{k}").alias(k) for k in KEY], "more_leaves", "more_saved")


def _with(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    more = nodes.join(sent, KEY, "left")
    added = {v: F.col(v) + F.coalesce(f"more_{v}", F.lit(0)) for v in ("leaves", "saved")}
    return more.withColumns(added).drop("more_leaves", "more_saved")


def trie(
    conversations: DataFrame, group: int = 20, heads: int = 4, limit: int | None = None, band: int = 4096, most: int = 200_000
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Nodes are the distinct first ``depth`` turns (role, text) of rebuilt
    conversations (see ``rebuilt``), from the root without turns on. ``conv_id`` is
    the smallest member, ``saved_tokens`` sums (members - 1) x words of the last
    turn over the subtree, ``ends_sha256`` hashes the ids of the conversations that
    end here. Null role and text read as empty; a null turn comes first; repeated
    rows are turns of their own; rows without ``conv_id`` are left out. Without
    conversations there is no node. ``limit`` (by default the root of the number
    of turns, 1,000 at least) and ``band`` shape the shards, not the result.
    """
    turns, lengths = rebuilt(conversations.select("conv_id", "turn", "role", "text"), group, heads)
    paths = staged(_paths(turns, lengths), "paths")
    grouped = paths.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"), F.max("words").alias("words"),
        F.min("px").alias("px"), F.min("py").alias("py"), F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
    )
    found = staged(grouped, "nodes")
    up = (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")
    children = found.filter("depth > 0").select(*up).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    counted = found.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved = (F.col("n_convs") - 1) * F.col("words")
    nodes = staged(
        counted.withColumns({"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": saved}), "nodes"
    )
    if limit is None:
        limit = max(1_000, int(paths.count() ** 0.5))
    totals = _totals(nodes, paths, limit, band, most)
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        nodes.join(totals, KEY)
        .join(parents, ["depth", "px", "py"], "left")
        .join(ends(paths), KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
