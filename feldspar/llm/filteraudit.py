"""Filter interaction audit: what each filter removes after every other choice of filters has run before it.

One table of row ids is stored per filter: the rows that fail it. Rows of no table survive everything and are only
counted. All others take part once per prefix (a set of filters that ran before): a left-anti join with the id tables
of the prefix leaves its survivors, a left-semi join with the id table of the next filter leaves what that one removes.
Only ids, a part and two label marks go through these joins, hashed on ids that are unique, so no key is hot.

A filter's redundant rows fail it but were removed earlier; its unique rows fail it alone; its Shapley value is the sum
over all orders of what it removes in them. ``audit`` takes any filters, as conditions on the text or as id tables.

Defined cases: null texts are empty (no word, no letter: they fail A and, unless first, E). A null id is no smaller and
no larger than any: its row never fails E and makes none fail; rows with the same id and text do not fail E by each
other. A null source and an empty one are the same part, ''. Repeated rows count as often as they occur. A document
has a label mark if any row of its id in ``labels`` has it. An empty table has no part, so no row. Other columns
of the tables, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feldspar.llm.storage import discard, materialize
from feldspar.plans.lookup import lookup_join

GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def text_filters() -> dict[str, Column]:
    """Failure conditions on ``text`` (never null) and its ``words``."""
    n = F.size("words")
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct("words")) < 65 * n,
        "C": 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 5 * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }


def later_copies(facts: DataFrame) -> DataFrame:
    """(uid) of rows whose text, named by its digest, also occurs with a smaller ``doc_id``."""
    known = facts.where("doc_id IS NOT NULL").select("uid", "doc_id", "digest")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return lookup_join(known, firsts, ["digest"], weight="n", null_safe=False).where("doc_id > first").select("uid")


def removals(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """(part, prefix, bit, removed, good_lost, toxic_lost) for every prefix and next filter that removes anything.

    ``rows``: uid (unique), part, doc_good, doc_toxic. ``failing``: a table of uids per filter; filter i has bit 2^i,
    and a prefix is the sum of its filters' bits.
    """
    bits = {name: 1 << i for i, name in enumerate(failing)}
    ids = reduce(DataFrame.union, [t.select(F.col("uid").alias("id"), F.lit(bits[f]).alias("fails")) for f, t in failing.items()])
    ids = ids.hint("shuffle_hash")
    suspects = rows.join(ids, F.col("uid") == F.col("id"), "left_semi")
    prefixes = suspects.withColumn("prefix", F.explode(F.sequence(F.lit(0), F.lit((1 << len(bits)) - 1))))
    before = (F.col("uid") == F.col("id")) & (F.col("prefix").bitwiseAND(F.col("fails")) != 0)
    survivors = prefixes.join(ids, before, "left_anti")
    others = F.filter(F.array(*[F.lit(b) for b in bits.values()]), lambda b: F.col("prefix").bitwiseAND(b) == 0)
    coming = survivors.withColumn("bit", F.explode(others))
    now = (F.col("uid") == F.col("id")) & (F.col("bit").bitwiseAND(F.col("fails")) != 0)
    removed = coming.join(ids, now, "left_semi")
    sums = [F.count(F.lit(1)).alias("removed"), F.count_if("doc_good").alias("good_lost"), F.count_if("doc_toxic").alias("toxic_lost")]
    return removed.groupBy("part", "prefix", "bit").agg(*sums)


def report(totals: DataFrame, cells: DataFrame, names: str) -> DataFrame:
    """A row per part, order and step. ``totals``: part, total; ``cells``: what ``removals`` returns."""
    bits = {name: 1 << i for i, name in enumerate(names)}
    every = (1 << len(names)) - 1
    size = F.bit_count("prefix")
    orders_after = reduce(
        lambda rest, s: F.when(size == s, factorial(s) * factorial(len(names) - 1 - s)).otherwise(rest), range(len(names)), F.lit(0)
    )
    alone = F.sum(F.when(F.col("prefix") == 0, F.col("removed")).otherwise(0))
    only = F.sum(F.when(F.col("prefix") == every - F.col("bit"), F.col("removed")).otherwise(0))
    per_filter = cells.groupBy("part", "bit").agg(
        alone.alias("fails"), only.alias("unique_fails"), F.sum(F.col("removed") * orders_after).alias("shapley")
    )
    orders = F.split(F.lit(" ".join(map("".join, permutations(names)))), " ")
    grid = totals.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))
    bit_of = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])
    ran = F.slice(F.split("filter_order", ""), F.lit(1), F.col("step") - 1)
    grid = grid.withColumns({
        "prefix": F.aggregate(ran, F.lit(0), lambda a, f: a + F.element_at(bit_of, f)),
        "bit": F.element_at(bit_of, F.substr("filter_order", F.col("step"), F.lit(1))),
    })
    rows = grid.join(cells, ["part", "prefix", "bit"], "left").join(per_filter, ["part", "bit"], "left")
    rows = rows.na.fill(0, ["removed", "good_lost", "toxic_lost", "fails", "unique_fails", "shapley"])
    # All removals of an order's steps so far: the steps of a part and order are a handful of rows.
    passed = rows.groupBy("part", "filter_order").agg(F.collect_list(F.struct("step", "removed")).alias("all"))
    rows = rows.join(passed, ["part", "filter_order"])
    gone = F.aggregate(F.filter("all", lambda x: x["step"] <= F.col("step")), F.lit(0).cast("long"), lambda a, x: a + x["removed"])
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - gone).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five text filters over ``docs`` (doc_id, text, source) in all 120 orders; ``labels``: doc_id, quality, toxic."""
    text = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    conditions = text_filters()
    read = text.withColumn("words", words(F.col("text"))).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(f"fails_{f}") for f, c in conditions.items()]
    )
    facts = materialize(read.withColumn("uid", F.monotonically_increasing_id()))
    failing = {f: materialize(facts.where(f"fails_{f}").select("uid")) for f in conditions}
    failing["E"] = materialize(later_copies(facts))
    marked = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("g"), F.max(F.col("toxic") == 1).alias("t"))
    marked = marked.select(F.col("doc_id").alias("labelled"), F.coalesce("g", F.lit(False)).alias("g"), F.coalesce("t", F.lit(False)).alias("t"))
    rows = facts.join(marked, F.col("doc_id") == F.col("labelled"), "left")
    rows = rows.select("uid", "part", F.coalesce("g", F.lit(False)).alias("doc_good"), F.coalesce("t", F.lit(False)).alias("doc_toxic"))
    cells = materialize(removals(rows, failing))
    totals = materialize(facts.groupBy("part").agg(F.count(F.lit(1)).alias("total")))
    for done in (facts, *failing.values()):
        discard(done)
    return report(totals, cells, "".join(failing))
