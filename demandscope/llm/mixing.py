"""Mixing sources to target weights by weighted fair queueing.

Each source gets a target of words: its weight's share of the budget, stopped at ``max_epochs`` times its size, the excess
shared anew by weight until no target is above its stop (the exact water level, found with one sorted prefix sum). Its documents are
shuffled by a hash of id and text and queued, pass after pass; an entry's virtual finish time is the source's words up to its end
divided by the target. The queue serves one order over all sources, that of virtual finish times, and stops when the words served reach the total budget.

The service is by words, as in a fair queue of very small packets: an entry that is being served at the cut counts in part. Serving whole documents
would leave each source up to its largest document away from its target. The cut is found without a global sort of words: entries are dealt into ranges
of virtual time (an entry that spans several counts in each with its words there), running totals over the ranges give the one in which the budget is reached,
and this range is divided anew until so few words are left that they can be sorted one by one.

Running sums inside a source never gather it in one task: the hash is cut into ``16 ** RANGES_HEX`` ranges, sums of ranges become offsets, and only the
rest is summed inside a range. Rows that agree in id, source and text are counted before anything is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, release, table

SEED = "mix"
RANGES_HEX = 4  # 16**4 ranges of the shuffle hash
TIME_RANGES = 1024  # ranges of virtual time at a level of the search for the cut
SORTED_WORDS = 100_000  # so many words are sorted one by one
FEW_SOURCES = 100_000  # a row for each of so many is sent to all tasks; more are joined by their number
TOGETHER = 1 << 16  # rows made at once of a counted one


def targets(sizes: DataFrame, weights=(5, 2, 1), budget_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """One row a source from (src, source_size): adds rank (1.. by code point, null last) and target.

    Sources without words get target 0. The result has as many rows as there are sources; the two windows over it need one
    ordered pass, which is the only step that isn't split.
    """
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_epochs).cast("double")
    level = ranked.withColumn("w", w).withColumn("cap", cap)
    by_level = Window.orderBy((F.col("cap") / F.col("w")), "rank").rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(all_of).cast("double") * budget_percent / 100
    left = budget - F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))
    weight_left = F.sum("w").over(all_of) - F.coalesce(F.sum("w").over(by_level), F.lit(0.0))
    level = level.withColumn("lam", left / weight_left)
    # the first source, in order of its stop, that the level doesn't reach
    stop = F.col("cap") / F.col("w")
    level = level.withColumn("lam", F.min_by("lam", F.when(F.col("lam") <= stop, F.struct(stop, F.col("rank")))).over(all_of))
    target = F.when(F.col("lam").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("lam")))
    return level.select("src", "rank", "source_size", target.alias("target"), budget.alias("budget"))


def _keyed(docs: DataFrame) -> dict[str, Column]:
    """Source, shuffle key and size of a row."""
    text = lambda c: F.coalesce(c, F.lit("null"))
    key = F.concat(F.lit(SEED + "|"), text(F.col("doc_id").cast("string")), F.lit("|"), text(F.md5(F.col("text").cast("binary"))))
    return {"src": F.col("source"), "key": F.md5(key.cast("binary")), "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")}


def _queued(docs: DataFrame, weights, budget_percent: int, max_epochs: int) -> DataFrame:
    """One row for each distinct (doc_id, src, key): size, n (its rows), source_size, target, budget, rank, and cum, its source's words up to its end."""
    sizes = docs.select("doc_id", *[v.alias(k) for k, v in _keyed(docs).items()]).groupBy("doc_id", "src", "key", "size").agg(F.count("*").alias("n"))
    sizes = materialize(sizes, "mix-sizes")
    base = sizes.withColumn("part", F.substring("key", 1, RANGES_HEX))
    run = F.col("size") * F.col("n")
    parts = base.groupBy("src", "part").agg(F.sum(run).alias("part_size"))
    goal = targets(parts.groupBy("src").agg(F.sum("part_size").alias("source_size")), weights, budget_percent, max_epochs)
    # sums before a range in two steps, so that no task sees more than 256 ranges of a source
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("head", F.substring("part", 1, 2)).withColumn("near", F.coalesce(F.sum("part_size").over(earlier("src", "head", "part")), F.lit(0)))
    heads = parts.groupBy("src", "head").agg(F.sum("part_size").alias("head_size")).withColumn("far", F.coalesce(F.sum("head_size").over(earlier("src", "head")), F.lit(0)))
    heads = heads.join(goal.withColumnRenamed("src", "g_src"), F.col("src").eqNullSafe(F.col("g_src"))).drop("g_src", "head_size").withColumnsRenamed({"src": "h_src", "head": "h_head"})
    parts = parts.join(heads, F.col("src").eqNullSafe(F.col("h_src")) & (F.col("head") == F.col("h_head"))).withColumn("before", F.col("near") + F.col("far"))
    parts = parts.drop("part_size", "head", "near", "far", "h_src", "h_head").withColumnsRenamed({"src": "p_src", "part": "p_part"})
    inside = Window.partitionBy("src", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    queued = base.withColumn("cum", F.sum(run).over(inside)).join(parts, F.col("src").eqNullSafe(F.col("p_src")) & (F.col("part") == F.col("p_part")))
    queued = materialize(queued.select("doc_id", "src", "key", "size", "n", "source_size", "target", "budget", "rank", (F.col("cum") + F.col("before")).alias("cum")), "mix-queue")
    release(sizes)
    return queued


def _entries(queue: DataFrame, max_epochs: int) -> DataFrame:
    """One row for each row of ``queue`` with words and each pass: rank, target, and first and last, its words' numbers in the source."""
    passes = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch")
    start = F.col("cum") - F.col("size") * F.col("n") + F.col("source_size") * F.col("epoch")
    return queue.where("size > 0 AND target > 0").select("rank", "target", "cum", "size", "n", "source_size", passes).select("rank", "target", (start + 1).alias("first"), (start + F.col("size") * F.col("n")).alias("last"))


def _below(edge: Column) -> Column:
    """How many of a source's words have a virtual finish time (number / target) below ``edge``."""
    t = F.col("target")
    k = F.floor(edge * t).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.when(F.try_divide(k + 1, t) < edge, k + 1).when(F.try_divide(k, t) >= edge, k - 1).otherwise(k))


def _served(queue: DataFrame, max_epochs: int) -> DataFrame:
    """(s_rank, upto): the words of each source that stand before the cut, that is among the first ``budget`` in order of virtual finish time, then rank."""
    known = queue.agg(F.max("budget").alias("budget"), F.max(F.try_divide(F.col("source_size") * max_epochs, F.col("target"))).alias("end")).first()
    left, low, end = int(known.budget or 0), 0.0, float(known.end or 0.0) * (1 + 1e-9)
    high = min(2.0, end)  # all targets together are the budget, so the cut lies near one
    entries = _entries(queue, max_epochs)
    while True:
        step = (high - low) / TIME_RANGES
        edge = lambda j: F.lit(low) + j * F.lit(step)  # noqa: B023, E731
        place = lambda c: F.least(F.greatest(F.floor((F.col(c) / F.col("target") - F.lit(low)) / F.lit(step)), F.lit(-1)), F.lit(TIME_RANGES + 1))  # noqa: B023, E731
        if left <= 0 or step <= 0:
            return queue.groupBy(F.col("rank").alias("s_rank")).agg(F.max(_below(F.lit(low))).alias("upto"))
        # an edge too many on either side, as quotients are rounded; what lies beyond the last edge is one open range
        pieces = entries.where(F.col("last") / F.col("target") >= low).select("*", F.explode(F.sequence(F.greatest(place("first") - 1, F.lit(0)), F.least(place("last") + 1, F.lit(TIME_RANGES)))).alias("j"))
        beyond = F.col("j") == TIME_RANGES
        words = F.least(F.when(beyond, F.col("last")).otherwise(_below(edge(F.col("j") + 1))), F.col("last")) - F.greatest(_below(edge(F.col("j"))), F.col("first") - 1)
        sums = pieces.select("j", words.alias("words")).where("words > 0").groupBy("j").agg(F.sum("words").alias("words"))  # at most TIME_RANGES + 1 rows
        upto = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
        cut = sums.withColumn("upto", F.sum("words").over(upto)).where(F.col("upto") >= left).orderBy("j").limit(1).first()
        if cut is None:  # fewer words than the budget: all are served
            return queue.groupBy(F.col("rank").alias("s_rank")).agg(F.max(F.col("source_size") * max_epochs).alias("upto"))
        left -= cut.upto - cut.words
        if cut.j == TIME_RANGES:
            low, high = low + TIME_RANGES * step, end
            continue
        low, high = low + cut.j * step, low + (cut.j + 1) * step
        if cut.words <= SORTED_WORDS or high - low < 1e-12:
            break
    sources = queue.groupBy("rank").agg(F.max("target").alias("target"), F.max("source_size").alias("source_size")).where("target > 0")
    have = F.least(_below(F.lit(low)), F.col("source_size") * max_epochs)
    until = F.least(_below(F.lit(high)), F.col("source_size") * max_epochs)
    numbers = sources.select("rank", "target", have.alias("have"), until.alias("until")).where("until > have").select("rank", "target", F.explode(F.sequence(F.col("have") + 1, F.col("until"))).alias("k"))
    first = numbers.orderBy(F.col("k") / F.col("target"), "rank", "k").limit(left).groupBy("rank").agg(F.count("*").alias("more"))
    every = queue.groupBy("rank").agg(F.max("target").alias("target"), F.max("source_size").alias("source_size")).select("rank", F.when(F.col("target") > 0, have).otherwise(F.lit(0).cast("long")).alias("have"))
    return every.join(first, "rank", "left").select(F.col("rank").alias("s_rank"), (F.col("have") + F.coalesce("more", F.lit(0))).alias("upto"))


def _with_cut(queue: DataFrame, max_epochs: int) -> DataFrame:
    """``queue`` with upto. A source may hold a third of all rows, so what is known of a source goes to the rows where sources are few."""
    served = _served(queue, max_epochs)
    few = (queue.agg(F.max("rank")).first()[0] or 0) <= FEW_SOURCES
    return queue.join(F.broadcast(served) if few else served, F.col("rank") == F.col("s_rank"))


def _numbered(df: DataFrame, n: Column, name: str) -> DataFrame:
    """A row for each number from 0 to n - 1, in two steps so that a count of any size makes no array of its size."""
    runs = F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.greatest(n, F.lit(1)) - 1) / TOGETHER)))
    begun = df.withColumn("__run", F.explode(runs))
    return begun.withColumn(name, F.explode(F.sequence(F.col("__run") * TOGETHER, F.least(n, (F.col("__run") + 1) * TOGETHER) - 1))).drop("__run")


def mix(docs: DataFrame, weights=(5, 2, 1), budget_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """Returns doc_id, source, size, source_size, target, finish, taken: one row for each row of ``docs`` (doc_id, text, source used).

    ``finish`` is the virtual finish time of the first pass (null where the target is 0), ``taken`` the words served before the budget is used up.
    Null and empty texts have size 0 and taken 0; a null source is a source of its own, ranked last; a null id is hashed as such;
    repeated rows are entries of their own, and rows that agree in id, source and text are interchangeable; words that finish at the same time are
    served in order of their sources; an empty table gives an empty table; very long texts are taken whole, one in service at the cut in part. Other columns
    are ignored.
    """
    queue = _queued(docs, weights, budget_percent, max_epochs)
    rows = _numbered(_with_cut(queue, max_epochs), F.col("n"), "copy")
    end = F.col("cum") - F.col("size") * (F.col("n") - 1 - F.col("copy"))
    part = lambda e: F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("upto") - (end - F.col("size") + F.col("source_size") * e)))
    finish = F.when(F.col("target") > 0, F.try_divide(end, F.col("target")))
    return rows.select("doc_id", F.col("src").alias("source"), "size", "source_size", "target", finish.alias("finish"), sum(part(e) for e in range(max_epochs)).alias("taken"))


def take(docs: DataFrame, weights=(5, 2, 1), budget_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, range-sorted by virtual finish time over all partitions.

    Documents stay whole: an entry is there if at least half of its words are served before the budget is used up. Rows without words cost nothing and come
    with their place in the queue. Of rows that agree in id, source and text one stands for all, as often as they are taken together. Nulls, empty and long
    texts and empty tables are as in ``mix``; clashing column names are no matter.
    """
    queue = _with_cut(_queued(docs, weights, budget_percent, max_epochs), max_epochs)
    start = lambda e: F.col("cum") - F.col("size") * F.col("n") + F.col("source_size") * e
    # copy i of a pass is half served if start + (i + 1/2) size <= upto
    half = lambda e: F.when(F.col("size") > 0, F.floor((2 * (F.col("upto") - start(e)) + F.col("size")) / (2 * F.col("size")))).when(start(e) <= F.col("upto"), F.col("n")).otherwise(0)
    times = lambda e: F.least(F.greatest(half(e), F.lit(0)), F.col("n")).cast("long")
    passes = F.array(*[F.struct(start(e).alias("start"), times(e).alias("times")) for e in range(max_epochs)])
    keys = {"__mix_src": F.coalesce("src", F.lit("")), "__mix_none": F.col("src").isNull(), "__mix_key": F.col("key")}
    told = {"__mix_size": F.col("size"), "__mix_target": F.col("target"), "__mix_rank": F.col("rank"), "__mix_passes": F.filter(passes, lambda p: p["times"] > 0)}
    queue = queue.select(*[v.alias(k) for k, v in (keys | told).items()]).where(F.size("__mix_passes") > 0)
    own = _keyed(docs)
    marked = docs.select(F.struct(*docs.columns).alias("__mix_row"), F.coalesce(own["src"], F.lit("")).alias("__mix_src"), own["src"].isNull().alias("__mix_none"), own["key"].alias("__mix_key"), F.xxhash64(*docs.columns).alias("__mix_order"))
    one = marked.groupBy(*keys).agg(F.min_by("__mix_row", "__mix_order").alias("__mix_row"))
    told = ["__mix_row", "__mix_key", "__mix_size", "__mix_target", "__mix_rank"]
    out = one.join(queue, list(keys)).select(*told, F.inline("__mix_passes").alias("__mix_start", "__mix_times"))
    out = _numbered(out, F.col("__mix_times"), "__mix_copy")
    end = F.col("__mix_start") + F.col("__mix_size") * (F.col("__mix_copy") + 1)
    out = out.withColumn("__mix_time", F.when(F.col("__mix_target") > 0, F.try_divide(end, F.col("__mix_target"))).otherwise(0.0))
    order = [F.col("__mix_time"), F.col("__mix_rank"), F.col("__mix_key")]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select("__mix_row.*")


def op8_mix_sources(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("source")


SQL = r"""
WITH d AS (
  SELECT doc_id, source AS src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(md5(text), 'null')) AS key FROM documents),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
r AS (SELECT *, row_number() OVER (ORDER BY src ASC NULLS LAST) AS rank FROM s),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, (2 * source_size)::DOUBLE AS cap FROM r),
l AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 150 / 100 AS budget,
         ((sum(source_size) OVER ())::DOUBLE * 150 / 100 - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS lam
  FROM w WINDOW before AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT *, (SELECT lam FROM l WHERE lam <= cap / w ORDER BY cap / w, rank LIMIT 1) AS level FROM l),
g AS (SELECT src, rank, source_size, budget, CASE WHEN level IS NULL THEN cap ELSE least(cap, w * level) END AS target FROM m),
v AS (SELECT rank, target, budget, unnest(range(1, 2 * source_size + 1)) AS k FROM g WHERE target > 0),
o AS (SELECT rank, row_number() OVER (ORDER BY k / target, rank, k) AS place, floor(budget) AS budget FROM v),
u AS (SELECT rank, count(*) AS upto FROM o WHERE place <= budget GROUP BY rank),
q AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, coalesce(u.upto, 0) AS upto,
         sum(d.size) OVER (PARTITION BY d.src ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cum
  FROM d JOIN g ON d.src IS NOT DISTINCT FROM g.src LEFT JOIN u USING (rank))
SELECT doc_id, size, source_size, target, CASE WHEN target > 0 THEN cum / target END AS finish,
       (greatest(0, least(size, upto - cum + size)) + greatest(0, least(size, upto - cum + size - source_size)))::BIGINT AS taken FROM q
"""
