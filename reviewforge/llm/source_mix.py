"""Operator 11: mixing sources to target weights by a multivariate-hypergeometric splitting tree. Native.

Targets: a source gets words by its weight, at most ``repeats`` times its own
size; what is over is shared anew by weight until no source is over. Sorted by
size over weight, the sources that stop are a prefix, so one window settles it.

Documents of a source follow each other by the MD5 of their id, ``repeats`` times
over: a fixed random order. A source is taken up to its target; where that falls
inside a document, the document is left out and the one among the later ones of
that round which fits the gap best, if any fits better than nothing, ends the mix.
Positions come from sums of hash ranges (at most 4096 a source) and within them,
so no task holds a source.

A block is ``block_words`` words of that order, and a source's quota the number
of blocks up to its target. The blocks are dealt to output shards by a tree: a
node holds how many blocks of each source its shards get; the left half gets a
multivariate hypergeometric draw of them, the right half the rest, and so on. So
all shards have the same number of blocks, and the quotas hold exactly. A source
is drawn after the other by inversion of its distribution, in the order of its
values from the mode on, as far as doubles can tell from 0. Nodes carry the first
block of each source, so shards get disjoint runs of permuted block numbers
without a count over shards. The tree has a row per shard, each with one number a
source; it is written out every few levels and dealt anew.

A copy joins its shard by (source, block), a key with one block's documents, and
the shards are shuffled each by itself, by hashes. Hashes of ids and of tree nodes
decide everything, so reruns agree however the rows are dealt.

Defined results: a null or empty text has size 0 and is taken 0 words; a null
source is one more source, after the others; a null id is hashed as the empty
text; rows with the same id are taken each, in the order of their sizes; without
words every target is 0; an empty table gives no row. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewforge.plans.joins import join_per_key

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
EPOCHS, REPEATS = 1.5, 2
BLOCK_WORDS, SHARD_BLOCKS = 1 << 16, 64
SEED = 11
#: Hash ranges of a source: the leading 12 of 60 bits.
KEY_BITS, RANGE_BITS = 60, 12
#: Levels of the tree between two writes.
LEVELS = 6
#: Multiplier of the block permutation: a prime above any quota (fixed value).
PRIME = 2_147_483_647


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


# -- targets ----------------------------------------------------------------------------------


def sized(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, doc_id, source, g, size, key) of every row, written out; the columns ``keep`` of ``docs`` as a struct ``own``, if any.

    ``g`` is the source without nulls.
    """
    own = [F.struct(*[docs[c] for c in keep]).alias("own")] if keep else []
    name = F.coalesce(docs[doc_col].cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs[doc_col].cast("long").alias("doc_id"),
        docs[source_col].cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), docs[source_col].cast("string")), F.lit("")).alias("g"),
        F.coalesce(F.regexp_count(docs[text_col], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        *own,
    )
    return stored(rows, "mix-sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: float = EPOCHS, repeats: int = REPEATS) -> DataFrame:
    """(g, nth, source_size, target) from (g, source_size): a row per source."""
    by_name = Window.orderBy(F.col("g") == "", "g")
    weight = F.get(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights)).cast("int"))
    named = sizes.withColumn("nth", F.row_number().over(by_name)).withColumn("weight", weight).withColumn("most", F.col("source_size") * repeats)
    tight = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(epochs))
    before = F.sum("most").over(tight.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("most")
    rest = F.sum("weight").over(tight.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    shared = named.select("*", (total - before).alias("left"), rest.alias("rest"))
    full = F.col("most") * F.col("rest") <= F.col("left") * F.col("weight")
    # The first source that does not stop sees the final share; for later ones the same formula gives less.
    share = F.max(F.when(~full, F.col("left") / F.col("rest"))).over(everything)
    target = F.when(full, F.col("most").cast("double")).otherwise(share * F.col("weight"))
    return shared.select("g", "nth", "source_size", target.alias("target"))


# -- which copies -----------------------------------------------------------------------------


def placed(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``rows`` with (nth, source_size, target, start): the words before the row in its source."""
    part = F.shiftright("key", KEY_BITS - RANGE_BITS).alias("part")
    parts = rows.groupBy("g", part).agg(F.sum("size").alias("words"))
    earlier = F.sum("words").over(Window.partitionBy("g").orderBy("part")) - F.col("words")
    heads = parts.select("g", "part", earlier.alias("head")).join(goals, "g")
    inside = Window.partitionBy("g", "part").orderBy("key", "doc_id", "size", "row")
    ranked = rows.select("*", part).withColumn("inner", F.sum("size").over(inside) - F.col("size"))
    joined = ranked.join(heads, ["g", "part"])
    return joined.select(*rows.columns, "nth", "source_size", "target", (F.col("head") + F.col("inner")).alias("start"))


def copies(at: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """The columns of ``at`` and (epoch, first): a row per copy that the mix takes; ``first`` counts the words before it."""
    every = at.where("size > 0 and target > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("epoch"))
    every = every.withColumn("first", F.col("epoch") * F.col("source_size") + F.col("start"))
    whole = every.where("first + size <= target")
    # The document in which the target falls, of each source (one row at most), and what is missing before it.
    edge = every.where("first < target and first + size > target").select("nth", "epoch", F.col("first").alias("cut"), (F.col("target") - F.col("first")).alias("gap"))
    later = join_per_key(every, edge, ["nth", "epoch"]).where("first >= cut").withColumn("off", F.abs(F.col("size") - F.col("gap")))
    best = later.where("off < gap").groupBy("nth").agg(F.min(F.struct("off", "key", "doc_id", "size", "row")).alias("b"), F.min("cut").alias("cut"), F.min("epoch").alias("epoch"))
    last = at.join(best.select(F.col("b.row").alias("row"), "cut", "epoch"), "row")
    return whole.unionByName(last.withColumnRenamed("cut", "first"))


# -- the tree ---------------------------------------------------------------------------------


def hypergeometric(u: Column, good: Column, total: Column, drawn: Column) -> Column:
    """How many of ``good`` blocks are among ``drawn`` of ``total``, for a uniform ``u`` in [0, 1).

    Inversion over the values from the mode up, then from below it down. Terms
    beyond 40 values and 12 standard deviations vanish beside the mode's in doubles.
    """
    bad = total - good
    low, high = F.greatest(F.lit(0), drawn - bad), F.least(drawn, good)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1.0) * (good + 1) / (total + 2)).cast("long")))
    spread = F.ceil(40 + 12 * F.sqrt(drawn * (good / F.greatest(total, F.lit(1))) * (bad / F.greatest(total, F.lit(1))))).cast("long")

    def values(v: Column) -> Column:
        up = F.sequence(v["mode"], F.least(v["high"], v["mode"] + v["spread"]))
        bottom = F.greatest(v["low"], v["mode"] - v["spread"])
        return F.when(bottom < v["mode"], F.concat(up, F.sequence(v["mode"] - 1, bottom, F.lit(-1).cast("long")))).otherwise(up)

    def weight(v: Column, last: Column, k: Column) -> Column:
        """The mode's term is 1; the others follow from their neighbour on the mode's side."""
        g, n, b = v["good"], v["drawn"], v["bad"]
        above = (g - k + 1.0) * (n - k + 1) / (k * (b - n + k))
        below = (k + 1.0) * (b - n + k + 1) / ((g - k) * (n - k))
        return F.when(k == v["mode"], F.lit(1.0)).when(k > v["mode"], last * above).otherwise(F.when(k == v["mode"] - 1, F.lit(1.0)).otherwise(last) * below)

    def found(v: Column) -> Column:
        def add(s: Column, k: Column) -> Column:
            return _bound(weight(v, s["w"], k), lambda w: F.struct((s["sum"] + w).alias("sum"), w.alias("w")))

        def seek(s: Column, k: Column) -> Column:
            return _bound(weight(v, s["w"], k), lambda w: F.struct((s["sum"] + w).alias("sum"), w.alias("w"), F.when(s["k"] >= 0, s["k"]).when(s["sum"] + w > s["goal"], k).otherwise(F.lit(-1).cast("long")).alias("k"), s["goal"].alias("goal")))

        zero, one = F.lit(0.0).alias("sum"), F.lit(1.0).alias("w")
        goal = u * F.aggregate(v["ks"], F.struct(zero, one), add, lambda s: s["sum"])
        hit = F.aggregate(v["ks"], F.struct(zero, one, F.lit(-1).cast("long").alias("k"), goal.alias("goal")), seek, lambda s: s["k"])
        return F.when(hit >= 0, hit).otherwise(v["mode"])

    named = [x.cast("long").alias(n) for x, n in ((good, "good"), (drawn, "drawn"), (bad, "bad"), (low, "low"), (high, "high"), (mode, "mode"), (spread, "spread"))]
    with_values = _bound(F.struct(*named), lambda v: F.struct(*[v[n].alias(n) for n in ("good", "drawn", "bad", "mode")], values(v).alias("ks")))
    return _bound(with_values, found)


def _uniform(*of: Column) -> Column:
    return F.xxhash64(*of).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))


def _left(seed: int) -> Column:
    """The left child's blocks of each source: one source's draw from what the sources before it left over."""
    total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, q: a + q)

    def draw(s: Column, i: Column) -> Column:
        q = F.get("quota", i)
        k = hypergeometric(_uniform(F.lit(seed), F.col("lo"), F.col("hi"), i), q, s["total"], s["drawn"])
        return _bound(k, lambda k: F.struct((s["total"] - q).alias("total"), (s["drawn"] - k).alias("drawn"), F.concat(s["left"], F.array(k)).alias("left")))

    start = F.struct(total.alias("total"), F.col("draw").alias("drawn"), F.array().cast("array<long>").alias("left"))
    return F.aggregate(F.sequence(F.lit(0), F.size("quota") - 1), start, draw, lambda s: s["left"])


def shard_quotas(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """(shard, nth, first, blocks) from (nth, quota): how many blocks of which source each shard gets, and from which one on."""
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    shards = -(-total // shard_blocks)
    root = quotas.where("quota > 0").agg(F.sort_array(F.collect_list(F.struct("nth", "quota"))).alias("q"))  # one number a source
    nodes = root.select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), F.col("q.nth").alias("nths"), F.col("q.quota").alias("quota"), F.transform("q", lambda x: F.lit(0).cast("long")).alias("first"))
    nodes = nodes.where("hi > 0")
    middle = F.floor((F.col("lo") + F.col("hi")) / 2)
    up_to = lambda shard: F.floor(shard * F.lit(total) / F.lit(max(shards, 1)))  # noqa: E731  blocks before a shard
    for level in range(max(shards - 1, 0).bit_length()):
        ready = nodes.withColumn("mid", middle).withColumn("draw", up_to(F.col("mid")) - up_to(F.col("lo")))
        split = ready.select("lo", "hi", "mid", "nths", "quota", "first", F.when(F.col("hi") - F.col("lo") > 1, _left(seed)).alias("left"))
        here = F.struct("lo", "hi", "quota", "first")
        one = F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("quota"), F.col("first"))
        other = F.struct(
            F.col("mid").alias("lo"), F.col("hi"), F.zip_with("quota", "left", lambda q, k: q - k).alias("quota"), F.zip_with("first", "left", lambda f, k: f + k).alias("first")
        )
        nodes = split.select("nths", F.explode(F.when(F.col("left").isNull(), F.array(here)).otherwise(F.array(one, other))).alias("c")).select("c.lo", "c.hi", "nths", "c.quota", "c.first")
        if level % LEVELS == LEVELS - 1:
            nodes = stored(nodes.repartition("lo"), "mix-tree")
    each = F.explode(F.arrays_zip("nths", "quota", "first")).alias("e")
    return nodes.select(F.col("lo").alias("shard"), each).select("shard", F.col("e.nths").alias("nth"), F.col("e.first").alias("first"), F.col("e.quota").alias("blocks")).where("blocks > 0")


def dealt_blocks(goals: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """(nth, block, shard): every block of every quota, once."""
    quotas = goals.select("nth", F.ceil(F.col("target") / block_words).alias("quota"))
    runs = shard_quotas(quotas, shard_blocks, seed)
    slots = runs.select("shard", "nth", F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1)).alias("slot"))
    # A prime above the quota has no factor in common with it: slot -> block is a permutation.
    block = (F.col("slot") * PRIME + F.pmod(F.xxhash64(F.lit(seed), "nth"), F.col("quota"))) % F.col("quota")
    return slots.join(quotas, "nth").select("nth", block.alias("block"), "shard")


# -- the mix ----------------------------------------------------------------------------------


def mix(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: float = EPOCHS, repeats: int = REPEATS, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The mix and the rows that it is made of, from :func:`sized` rows.

    The mix has a row per copy: (shard, place, row, epoch, and the other columns
    of ``rows``), ``place`` being its turn in the shuffled shard. The rows have
    their source's size and target.
    """
    goals = stored(targets(rows.groupBy("g").agg(F.sum("size").alias("source_size")), weights, epochs, repeats), "mix-targets")
    narrow = stored(placed(rows.drop("own"), goals), "mix-places")
    taken = copies(narrow, repeats).withColumn("block", F.floor(F.col("first") / block_words))
    blocks = stored(dealt_blocks(goals, block_words, shard_blocks, seed), "mix-blocks")
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "key", "epoch"), "doc_id", "size", "row", "epoch")
    out = taken.join(blocks, ["nth", "block"]).withColumn("place", F.row_number().over(shuffled)).select("shard", "place", "epoch", "row", "doc_id", "source", "size")
    return (out.join(rows.select("row", "own"), "row") if "own" in rows.columns else out), narrow


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row: the words that the mix takes of it."""
    mixed, rows = mix(sized(docs))
    words = mixed.groupBy("row").agg(F.sum("size").alias("taken"))
    joined = rows.join(words, "row", "left")
    return joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


SQL = f"""
with d as (select row_number() over () as r, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
  cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as k from documents),
s as (select source, sum(size)::bigint as sz, row_number() over (order by source nulls last) as nth from d group by source),
w as (select *, [{', '.join(map(str, WEIGHTS))}][(nth - 1) % {len(WEIGHTS)} + 1] as wt, {REPEATS} * sz as most from s),
f as (select *, {EPOCHS} * sum(sz) over () - (sum(most) over (order by most / wt, nth) - most) as lft, sum(wt) over (order by most / wt desc, nth desc) as rst from w),
t as (select source, sz, case when most * rst <= lft * wt then most::double
  else max(case when most * rst > lft * wt then lft::double / rst end) over () * wt end as target from f),
p as (select d.*, sz, target, sum(size) over (partition by d.source order by k, doc_id nulls first, size, r) - size as start
  from d join t on d.source is not distinct from t.source),
c as (select *, e, e * sz + start as a from p, range({REPEATS}) as g(e) where size > 0),
edge as (select source, e, a, target - a as gap from c where a < target and a + size > target),
fit as (select c.source, arg_min(c.r, (abs(size - gap), k, doc_id, size)) as r from c join edge on c.source is not distinct from edge.source
  and c.e = edge.e and c.a >= edge.a where abs(size - gap) < gap group by c.source),
n as (select r, count(*) as n from (select r from c where a + size <= target union all select r from fit) group by r)
select doc_id, size, sz as source_size, target, cast(coalesce(n, 0) * size as bigint) as taken from p left join n using (r)"""
