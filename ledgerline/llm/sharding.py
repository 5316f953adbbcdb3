"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix; DataFrame functions only.

Rows sit in source blocks. How many rows block i sends to shard j follows the
multivariate hypergeometric law of a uniform permutation, so the matrix is
drawn first, from block sizes alone. Each block then permutes its rows, deals
them out by its row of the matrix, and each shard permutes what it received.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import let, numbered, staged, uniform

ROWS_PER_BLOCK = 1024
FAN_OUT = 32


#: Spread above which draws are made by ratio of uniforms instead of walking over the values; tries of that.
WIDE, TRIES = 64.0, 64


def _spread(p: Column) -> Column:
    share = p["good"] / F.greatest(p["total"], F.lit(1))
    left = F.greatest(p["total"] - p["drawn"], F.lit(0)) / F.greatest(p["total"] - 1, F.lit(1))
    return F.sqrt(p["drawn"] * share * (1 - share) * left)


def _rise(x: Column, step: Column) -> Column:
    """log((x + step)!) - log(x!) by Stirling's series of the difference, so that large terms do not cancel."""
    x, step = x.cast("double") + 1, step.cast("double")
    y = x + step
    series = (1 / y - 1 / x) / 12 - (1 / F.pow(y, 3) - 1 / F.pow(x, 3)) / 360
    return (y - 0.5) * F.log1p(step / x) + step * F.log(x) - step + series


def _walked(p: Column) -> Column:
    """Inversion: weights follow the exact ratio of neighbouring probabilities, ten standard deviations (and ten more) either way."""

    def ratio(k: Column) -> Column:
        up = (p["good"] - k).cast("double") * (p["drawn"] - k)
        return up / ((k + 1).cast("double") * (p["total"] - p["good"] - p["drawn"] + k + 1))

    places = F.sequence(p["least"], p["most"])
    weight = F.aggregate(
        places,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
        lambda s, k: F.struct((s["w"] * ratio(k)).alias("w"), (s["sum"] + s["w"]).alias("sum")),
        lambda s: s["sum"],
    )

    def pick(goal: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), p["least"].alias("x")),
            lambda s, k: F.struct(
                (s["w"] * ratio(k)).alias("w"),
                (s["sum"] + s["w"]).alias("sum"),
                F.when(s["sum"] < goal, k).otherwise(s["x"]).alias("x"),
            ),
            lambda s: s["x"],
        )

    return let(weight * p["u"], pick)


def _tried(p: Column) -> Column:
    """Ratio of uniforms around the mean: about four tries in five are taken, whatever the spread.

    A try that is taken follows the exact law. All tries fail with a chance below
    1 in 10^40; the mode would then be drawn. Counts stay far from their ends here.
    """
    # 2 sqrt(2 / e) and 3 - 2 sqrt(3 / e).
    wide, more = 1.7155277699214135, 0.8989161620588988
    bad = p["total"] - p["good"]
    mean = p["drawn"] * (p["good"] / p["total"])
    mode = F.floor((p["drawn"] + 1).cast("double") * ((p["good"] + 1) / (p["total"] + 2))).cast("long")
    given = F.struct(
        mode.alias("mode"), (mean + 0.5).alias("mid"), (wide * F.sqrt(F.pow(_spread(p), 2) + 0.5) + more).alias("h"),
        (p["good"] - mode).alias("g"), (p["drawn"] - mode).alias("d"), (bad - p["drawn"] + mode).alias("b"), p["u"].alias("u"),
    )

    def search(q: Column) -> Column:
        def log_ratio(step: Column) -> Column:
            """Logarithm of the probability of mode + step over that of the mode."""
            return -(_rise(q["mode"], step) + _rise(q["g"], -step) + _rise(q["d"], -step) + _rise(q["b"], step))

        def once(found: Column, i: Column) -> Column:
            def tested(t: Column) -> Column:
                step = F.floor(q["mid"] + q["h"] * (t["v"] - 0.5) / t["x"]).cast("long") - q["mode"]
                near = F.abs(step) < 12 * q["h"]  # beyond, the law has no weight that a double can hold
                return let(step, lambda k: F.when(near & (2 * F.log(t["x"]) <= log_ratio(k)), q["mode"] + k))

            drawn = F.struct(F.greatest(uniform(q["u"], i), F.lit(2.0**-53)).alias("x"), uniform(q["u"], i, F.lit("v")).alias("v"))
            return F.when(found.isNotNull(), found).otherwise(let(drawn, tested))

        tries = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("long"), once)
        return F.coalesce(tries, q["mode"])

    return let(given, search)


def hypergeometric(u: Column, good: Column, total: Column, drawn: Column) -> Column:
    """The number of good items among ``drawn`` of ``total``, from a uniform ``u``; its cost is bounded whatever the counts."""
    bare = F.struct(good.alias("good"), total.alias("total"), drawn.alias("drawn"))

    def bounded(p: Column) -> Column:
        spread, mean = _spread(p), p["drawn"] * (p["good"] / F.greatest(p["total"], F.lit(1)))
        least = F.greatest(F.lit(0), p["drawn"] - (p["total"] - p["good"]), F.floor(mean - 10 * spread) - 10).cast("long")
        most = F.least(p["drawn"], p["good"], F.ceil(mean + 10 * spread) + 10).cast("long")
        given = F.struct(
            u.alias("u"), p["good"].alias("good"), p["total"].alias("total"), p["drawn"].alias("drawn"),
            least.alias("least"), most.alias("most"), spread.alias("spread"),
        )
        return let(
            given,
            lambda q: F.when(q["least"] >= q["most"], q["least"]).when(q["spread"] > WIDE, _tried(q)).otherwise(_walked(q)),
        )

    return let(bare, bounded)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def _deal(caps: Column, size: Column, seed: Column) -> Column:
    """How many of ``size`` rows go to each shard when ``caps`` places are left: one multivariate draw."""
    start = F.struct(
        F.array().cast("array<bigint>").alias("row"), size.alias("left"), _sum(caps).alias("rest"), F.lit(0).alias("j")
    )

    def step(s: Column, cap: Column) -> Column:
        def taken(x: Column) -> Column:
            return F.struct(
                F.concat(s["row"], F.array(x)).alias("row"),
                (s["left"] - x).alias("left"),
                (s["rest"] - cap).alias("rest"),
                (s["j"] + 1).alias("j"),
            )

        return let(hypergeometric(uniform(seed, s["j"]), cap, s["rest"], s["left"]), taken)

    return F.aggregate(caps, start, step, lambda s: s["row"])


def _splitter(seed: str) -> Callable[[Column, Column], Column]:
    """One step over a node's children: deal places to the child and keep the rest."""

    def step(s: Column, c: Column) -> Column:
        def dealt(row: Column) -> Column:
            return F.struct(
                F.zip_with(s["caps"], row, lambda cap, x: cap - x).alias("caps"),
                F.concat(s["out"], F.array(F.struct(c["child"].alias("node"), row.alias("caps")))).alias("out"),
            )

        return let(_deal(s["caps"], c["n"], F.xxhash64(F.lit(seed), c["child"])), dealt)

    return step


def communication_matrix(sizes: DataFrame, blocks: int, capacities: list[int], seed: str) -> DataFrame:
    """``block`` and ``sent``, one count per shard, for block ``sizes`` (block, n) with sum(n) = sum(capacities).

    A tree over the blocks: each node splits its places among at most 32
    children, and children are split side by side, so the number of rounds
    grows with the logarithm of the number of blocks and no table is collected.
    """
    depth, span = 1, FAN_OUT
    while span < blocks:
        depth, span = depth + 1, span * FAN_OUT
    caps = F.array(*[F.lit(c).cast("long") for c in capacities])
    nodes = sizes.sparkSession.range(1).select(F.lit(0).cast("long").alias("node"), caps.alias("caps"))
    for level in range(depth):
        below = FAN_OUT ** (depth - 1 - level)
        child = F.floor(F.col("block") / below).cast("long")
        groups = sizes.groupBy(child.alias("child")).agg(F.sum("n").alias("n"))
        children = groups.groupBy(F.floor(F.col("child") / FAN_OUT).cast("long").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children")
        )
        start = F.struct(F.col("caps").alias("caps"), F.array().cast("array<struct<node:bigint,caps:array<bigint>>>").alias("out"))

        split = F.aggregate(F.col("children"), start, _splitter(f"{seed}/{level}"), lambda s: s["out"])
        nodes = nodes.join(children, "node").select(F.explode(split).alias("c")).select("c.*")
    return nodes.select(F.col("node").alias("block"), F.col("caps").alias("sent"))


def _copies_numbered(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add ``copy``: 0 for a row like no other, 0, 1, ... for equal rows, without one task seeing all of them."""
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    named = repeated.select(*[F.col(c).alias(f"_{c}") for c in key], F.xxhash64(*key).alias("_name"))
    marked = rows.join(named, reduce(Column.__and__, same), "left").drop(*[f"_{c}" for c in key])
    marked = staged(marked, "shard-copies")
    many = marked.filter("_name is not null")
    counted = numbered(many, [F.col("_at")], F.shiftright("_at", 33), "copy", ["_name"])
    alone = marked.filter("_name is null").withColumn("copy", F.lit(0).cast("long"))
    return alone.unionByName(counted).select(*key, "copy")


def shard_rows(
    df: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "shard",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Deal every row into shards whose row counts differ by at most one, in uniformly shuffled order.

    Returns ``doc_id``, ``size`` (UTF-8 bytes plus 16), ``text_crc32``,
    ``shard`` and ``slot`` (0, 1, ... in the shard). Texts are read once and
    not moved. Random numbers are seeded hashes of a row's id, size and
    checksum, so a task that runs again deals alike; rows equal in all three
    change places freely. A null text has no bytes; an empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    row_key = ("doc_id", "size", "text_crc32")
    rows = staged(_copies_numbered(staged(rows.withColumn("_at", F.monotonically_increasing_id()), "shard-read"), row_key), "shard-rows")
    n = rows.count()
    blocks = max(1, -(-n // rows_per_block))
    part = F.floor(F.col("copy") / rows_per_block)
    block = F.pmod(F.xxhash64(F.lit(seed), *row_key, part), F.lit(blocks))
    local = F.xxhash64(F.lit(seed + "/local"), *row_key, "copy")
    again = F.lit(seed + "/again")
    placed = rows.withColumn("block", block)
    sizes = staged(placed.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "shard-blocks")
    capacities = [n // shards + (j < n % shards) for j in range(shards)]
    matrix = staged(communication_matrix(sizes, blocks, capacities, seed), "shard-matrix")
    running = F.transform(
        F.sequence(F.lit(1), F.lit(shards)), lambda j: _sum(F.slice(F.col("sent"), F.lit(1), j))
    )
    ends = matrix.select("block", running.alias("ends"))
    rank = F.row_number().over(Window.partitionBy("block").orderBy(local, *row_key, "copy")) - 1
    sent = placed.withColumn("rank", rank).join(ends, "block")
    dealt = sent.select(
        *row_key, "rank", F.size(F.filter("ends", lambda end: end <= F.col("rank"))).alias("shard")
    )
    buckets = max(1, -(-n // (shards * rows_per_block)))
    key = uniform(again, *row_key, "rank")
    out = numbered(
        dealt.withColumn("_key", key), [F.col("_key"), *map(F.col, row_key), F.col("rank")],
        F.floor(F.col("_key") * buckets), "slot", ["shard"],
    )
    return out.select(*row_key, "shard", "slot")
