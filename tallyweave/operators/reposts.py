"""Expenses that several sources publish: kept once where two sources share two or more.

Two sources are a repost pair if the multisets of their expenses share at least 2. Within each expense, sources linked by
such pairs form components; each keeps the records of the source with most of them (the earliest published of equals) and
lists the others' as repeats. Repeats inside one source are never reduced. Confirmations by people come first:
`same_expense` links the declared sources, `separate_expenses` unlinks them and takes that expense out of their evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.graphs import components
from tallyweave.tables import cut_lineage, with_facts

#: Sources with more shared items than this don't carry them from line to line; their pairs are counted instead.
LONG_SOURCE = 128
#: The sources of a line are paired by blocks of about so many.
BLOCK = 1024
#: Sources of a line that so many have, at most, are linked pair by pair; those of wider ones by stars.
NARROW = 8


def publish_ranks(sources: DataFrame) -> DataFrame:
    """source, rank: order of publication (unknown dates last), then source. sources: source, posted.

    Ranks order values and need not be dense, so no single task numbers all sources.
    """
    return sources.groupBy("source").agg(F.struct(F.coalesce(F.min("posted"), F.lit("9999-12-31").cast("date")).alias("posted"), F.col("source").alias("source")).alias("rank"))


def expense_counts(records: DataFrame) -> DataFrame:
    """source, expense, n: the multiset of each source."""
    return records.groupBy("source", "expense").agg(F.count("*").alias("n"))


def _overlaps(pairs: DataFrame, counts: DataFrame, separated: DataFrame | None) -> DataFrame:
    """a, b, shared: the size of the multiset intersection of each pair, without separated expenses."""
    x, y = counts.alias("x"), counts.alias("y")
    met = pairs.alias("p").join(x, F.col("x.source") == F.col("p.a")).join(y, (F.col("y.source") == F.col("p.b")) & (F.col("y.expense") == F.col("x.expense")))
    met = met.select("p.a", "p.b", F.col("x.expense").alias("expense"), F.least("x.n", "y.n").alias("n"))
    if separated is not None:
        met = met.join(separated, ["expense", "a", "b"], "left_anti")
    return met.groupBy("a", "b").agg(F.sum("n").alias("shared"))


def _sets(items: DataFrame) -> DataFrame:
    """source, items (from the one of fewest sources on), narrow: how many of them have at most NARROW sources. items: source, item, m (its sources)."""
    held = items.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("m", "item"))).alias("s"))
    return cut_lineage(held.select("source", F.transform("s", lambda x: x["item"]).alias("items"), F.size(F.filter("s", lambda x: x["m"] <= NARROW)).alias("narrow")))


def _common_items(sets: DataFrame, most: Column) -> DataFrame:
    """a < b, common: the shared items of each pair of sources that share two or more, if the rarest is among the first `most` items of both.

    A pair is met at its rarest shared item, with both sources' items at hand, so pairs are neither made twice nor shuffled. The
    sources of an item are dealt into blocks of about BLOCK, and blocks are paired, so no task holds all pairs of one.
    """
    rare = sets.select("source", "items", F.explode(F.slice("items", F.lit(1), most)).alias("item"))
    wide = rare.groupBy("item").agg(F.count("*").alias("k")).where(F.col("k") > BLOCK).select("item", F.ceil(F.col("k") / BLOCK).alias("blocks"))
    dealt = rare.join(F.broadcast(wide), "item", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    own, other = F.pmod(F.xxhash64("source"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    x = dealt.select("item", own.alias("p"), other.alias("q"), F.col("source").alias("a"), F.col("items").alias("x"))
    y = dealt.select("item", own.alias("q"), other.alias("p"), F.col("source").alias("b"), F.col("items").alias("y"))
    # exploded so that the intersection is computed once
    met = x.join(y.hint("merge"), ["item", "p", "q"]).where("a < b").select("a", "b", "item", F.explode(F.array(F.array_intersect("x", "y"))).alias("common"))
    return met.where((F.get("common", F.lit(0)) == F.col("item")) & (F.size("common") >= 2)).select("a", "b", "common")


def _long_pairs(sets: DataFrame) -> DataFrame:
    """a < b, shared: as _common_items, for pairs of which a source has more than LONG_SOURCE items. Shared items are counted; the last of each source is looked up."""
    last = F.element_at("items", -1)
    rare = sets.select("source", last.alias("last"), (F.size("items") > LONG_SOURCE).alias("long"), F.explode(F.slice("items", F.lit(1), F.size("items") - 1)).alias("item"))
    x, y = rare.where("long").alias("x"), rare.alias("y")
    met = x.join(y, (F.col("x.item") == F.col("y.item")) & (F.col("x.source") != F.col("y.source")) & (~F.col("y.long") | (F.col("x.source") < F.col("y.source"))))
    pairs = met.groupBy(F.col("x.source").alias("p"), F.col("y.source").alias("q")).agg(F.count("*").alias("n"), F.first("x.last").alias("v"), F.first("y.last").alias("w"))
    held = sets.select("source", F.explode("items").alias("item"))
    found = pairs.join(held.select(F.col("source").alias("q"), F.col("item").alias("v"), F.lit(1).alias("i")), ["q", "v"], "left")
    found = found.join(held.select(F.col("source").alias("p"), F.col("item").alias("w"), F.lit(1).alias("j")), ["p", "w"], "left")
    shared = F.col("n") + F.coalesce("i", F.lit(0)) + F.when(F.col("v") != F.col("w"), F.coalesce("j", F.lit(0))).otherwise(0)
    return found.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), shared.alias("shared")).where("shared >= 2")


def repost_pairs(counts: DataFrame, separated: DataFrame | None = None) -> DataFrame:
    """a < b, shared: pairs of sources whose multisets of expenses share at least 2.

    separated: (expense, a, b), which don't count as evidence. The first, second, ... record of an expense are items of their
    own, so multisets are sets. Of two shared items one isn't the most widespread of its source, so pairs are not looked for
    by that: a line that very many sources have alone makes no pairs.
    """
    each = counts.where("source is not null and expense is not null").select("source", "expense", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("k")).select("source", F.struct("expense", "k").alias("held"))
    spread = cut_lineage(each.groupBy("held").agg(F.count("*").alias("m")).where("m > 1").select("held", "m", F.monotonically_increasing_id().alias("item")))
    sets = _sets(with_facts(each, spread, "held", "m"))
    common = _common_items(sets.where(F.size("items") <= LONG_SOURCE), F.size("items") - 1)
    pairs = common.select("a", "b", F.size("common").cast("long").alias("shared")).unionByName(_long_pairs(sets))
    if separated is None:
        return pairs
    named = separated.select("a", "b").distinct()
    return pairs.join(named, ["a", "b"], "left_anti").unionByName(_overlaps(named, counts, separated).where("shared >= 2"))


def shared_pair_links(counts: DataFrame) -> DataFrame:
    """a, b: links with the same components as repost_pairs within every expense, from stars in place of pairs.

    Of all sources that share the same two expenses (or one of which each has two), each is linked with the least. So a line
    that very many sources share makes a row for each of them and not for each pair; a source of m shared lines makes m^2 / 2.
    """
    spread = counts.groupBy("expense").agg(F.count("*").alias("m")).where("m > 1").select("expense")
    several = counts.join(spread, "expense")
    x, y = several.alias("x"), several.alias("y")
    both = x.join(y, (F.col("x.source") == F.col("y.source")) & ((F.col("x.expense") < F.col("y.expense")) | ((F.col("x.expense") == F.col("y.expense")) & (F.col("x.n") > 1))))
    both = both.select(F.col("x.expense").alias("e"), F.col("y.expense").alias("f"), F.col("x.source").alias("b"))
    heads = both.groupBy("e", "f").agg(F.min("b").alias("a"), F.count("*").alias("k")).where("k > 1")
    return both.join(heads, ["e", "f"]).where("a <> b").select("a", "b").distinct()


def _numbered(counts: DataFrame) -> DataFrame:
    """The counts with a number for each expense and m and twice: how many sources have it, and how many more than once. Written."""
    found = counts.groupBy("expense").agg(F.count("*").alias("m"), F.count_if(F.col("n") > 1).alias("twice"))
    spread = cut_lineage(found.select("expense", "m", "twice", F.monotonically_increasing_id().alias("number")))
    return cut_lineage(with_facts(counts, spread, "expense", "m"))


def _linked_rows(numbered: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """number, a, b: links with the same components as repost_pairs within every expense, without the declared pairs (a < b).

    Two sources that share two items (an expense, or a second record of it) are linked in all they share. Pairs whose rarest
    shared item has few sources are linked as they are. Of all sources that share two wider items each is linked with one, so
    a line that very many sources have makes a row for each and not for each pair. That one has the fewest declared pairs;
    sources that it is declared with are linked with all others in its place.
    """
    shared = numbered.where("m > 1 and source is not null and expense is not null")
    second = shared.where("n > 1 and twice > 1").select("source", (2 * F.col("number") + 1).alias("item"), F.col("twice").alias("m"))
    sets = _sets(shared.select("source", (2 * F.col("number")).alias("item"), "m").unionByName(second))
    near = _common_items(sets, F.col("narrow"))
    wide = F.slice("items", F.col("narrow") + 1, F.size("items"))
    several = sets.where(F.size("items") > F.col("narrow") + 1).select("source", wide.alias("items"))
    if declared is not None:
        named = cut_lineage(declared.select("a", "b").distinct())
        near = near.join(named, ["a", "b"], "left_anti")
        degree = named.select(F.col("a").alias("source")).union(named.select("b")).groupBy("source").agg(F.count("*").alias("degree"))
        several = several.join(degree, "source", "left")
    several = cut_lineage(several.withColumn("order", F.struct(F.coalesce("degree", F.lit(0).cast("long")) if declared is not None else F.lit(0).cast("long"), "source")))
    met = several.select("source", "order", "items", F.posexplode("items").alias("at", "e"))
    met = met.select("source", "order", "e", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("f"))
    met = met.select(F.struct("e", "f").alias("both"), "source", "order")
    heads = cut_lineage(met.groupBy("both").agg(F.min("order")["source"].alias("head"), F.count("*").alias("k")).where("k > 1"))
    hung = with_facts(met.select("both", "source"), heads, "both", "k").where("source <> head")
    hung = hung.select("both", F.least("head", "source").alias("a"), F.greatest("head", "source").alias("b"))
    if declared is not None:
        hung = cut_lineage(hung)
        bad = hung.join(named, ["a", "b"], "left_semi").join(heads, "both").select("both", "head", F.when(F.col("a") == F.col("head"), F.col("b")).otherwise(F.col("a")).alias("x"))
        rest = bad.join(met.select("both", "source"), "both").where("source <> x and source <> head")
        rest = rest.select("both", F.least("x", "source").alias("a"), F.greatest("x", "source").alias("b"))
        hung = hung.unionByName(rest).join(named, ["a", "b"], "left_anti")
    items = near.select("a", "b", F.explode("common").alias("item")).unionByName(hung.select("a", "b", F.explode(F.array("both.e", "both.f")).alias("item")))
    return items.select(F.shiftright("item", 1).alias("number"), "a", "b").distinct()


def repost_links(counts: DataFrame) -> DataFrame:
    """expense, a, b: links with the same components as repost_pairs within every expense; see _linked_rows."""
    numbered = _numbered(counts)
    linked = cut_lineage(_linked_rows(numbered))
    names = numbered.where("m > 1").groupBy("number").agg(F.first("expense").alias("expense"))
    return with_facts(linked, linked.groupBy("number").agg(F.count("*").alias("k")).join(names, "number"), "number", "k").select("expense", "a", "b")


def _rows_components(numbered: DataFrame, links: DataFrame) -> DataFrame:
    """expense, source, n, component (its least source) of numbered counts. links: number, a, b. Written.

    Nodes are structs of the number and the source, so the least node of a component names its least source.
    """
    node = lambda c: F.struct("number", F.col(c).alias("source"))
    found = components(links.select(node("a").alias("a"), node("b").alias("b"))).select(F.col("node.number").alias("number"), F.col("node.source").alias("source"), F.col("component.source").alias("component"))
    return cut_lineage(numbered.join(found, ["number", "source"], "left").select("expense", "source", "n", F.coalesce("component", "source").alias("component")))


def _links_of_expenses(counts: DataFrame, pairs: DataFrame, *row: str) -> DataFrame:
    """expense, a, b: the expenses that both sources of a pair carry. pairs: (a, b), or (expense, a, b) for one expense only.

    row: a column of `counts`, which is given as <row>_a and <row>_b. The sources b are looked up first, as a may be the head of very
    many pairs; a head's expenses are then facts.
    """
    keyed = ["expense"] if "expense" in pairs.columns else []
    carried = pairs.join(counts.select(F.col("source").alias("b"), "expense", *[F.col(r).alias(f"{r}_b") for r in row]), ["b", *keyed])
    carried = carried.select("expense", "a", "b", *[f"{r}_b" for r in row], F.struct("a", "expense").alias("head"))
    heads = carried.groupBy("head").agg(F.count("*").alias("n"))
    known = counts.select(F.struct(F.col("source").alias("a"), "expense").alias("head"), *[F.col(r).alias(f"{r}_a") for r in row])
    return with_facts(carried, heads.join(known, "head"), "head", "n").select("expense", "a", "b", *[f"{r}_{side}" for r in row for side in "ab"])


def expense_components(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """expense, source, component (its least source): components of the pairs among the sources of each expense.

    pairs: (a, b), or (expense, a, b) for pairs of one expense only. Nodes are numbers of the rows (expense, source), so the star
    steps close all expenses at once, and the sources of one are spread over all tasks.
    """
    numbered = cut_lineage(counts.select("expense", "source", F.monotonically_increasing_id().alias("row")))
    found = components(_links_of_expenses(numbered, pairs, "row").select(F.col("row_a").alias("a"), F.col("row_b").alias("b")))
    hung = found.union(found.select(F.col("component").alias("node"), "component").distinct())
    members = numbered.join(hung, F.col("row") == F.col("node")).select("row", "source", F.col("component").alias("group"))
    least = members.groupBy("group").agg(F.min("source").alias("component"), F.count("*").alias("n"))
    linked = with_facts(members.drop("source"), least, "group", "n").select("row", "component")
    return numbered.join(linked, "row", "left").select("expense", "source", F.coalesce("component", "source").alias("component"))


def repost_components(counts: DataFrame) -> DataFrame:
    """expense, source, n, component: as expense_components, of the pairs that share two or more."""
    numbered = _numbered(counts)
    return _rows_components(numbered, _linked_rows(numbered))


def _declared_components(counts: DataFrame, confirmations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """repost_components by the rule alone, and with the confirmations: same_expense adds links, separate_expenses takes them out.

    Only declared pairs can lose evidence, so they alone are counted; all others are linked as without confirmations.
    """
    numbered = _numbered(counts)
    rows = numbered.where("m > 1").select("expense", "number", "source", "n")
    side = lambda c: rows.select("expense", F.col("source").alias(c))
    declared = cut_lineage(confirmed_pairs(confirmations).join(rows.select("expense", "number", F.col("source").alias("a")), ["expense", "a"]).join(side("b"), ["expense", "b"]))
    apart = declared.where("decision = 'separate_expenses'").select("expense", "number", "a", "b")
    links = cut_lineage(_linked_rows(numbered, apart))
    ruled = _overlaps(apart.select("a", "b").distinct(), rows, apart.select("expense", "a", "b")).where("shared >= 2").select("a", "b")
    told = ruled.join(rows.select(F.col("source").alias("a"), "number"), "a").join(rows.select(F.col("source").alias("b"), "number"), ["b", "number"]).select("number", "a", "b")
    told = cut_lineage(told)
    same = declared.where("decision = 'same_expense'").select("number", "a", "b")
    kept = told.join(apart.select("number", "a", "b"), ["number", "a", "b"], "left_anti")
    return _rows_components(numbered, links.unionByName(told)), _rows_components(numbered, links.unionByName(kept).unionByName(same))


def confirmed_pairs(confirmations: DataFrame) -> DataFrame:
    """expense, decision, a < b of the sources that a confirmation declares. confirmations: expense, decision, sources."""
    one = confirmations.select("expense", "decision", F.explode("sources").alias("a"), "sources")
    return one.select("expense", "decision", "a", F.explode("sources").alias("b")).where("a < b").distinct()


def stale_confirmations(confirmations: DataFrame, counts: DataFrame) -> DataFrame:
    """Confirmations that name a source which does not carry the expense, or an expense confirmed twice."""
    carried = counts.groupBy("expense").agg(F.collect_set("source").alias("carried"))
    missing = confirmations.join(carried, "expense", "left").where(F.col("carried").isNull() | (F.size(F.array_except("sources", "carried")) > 0)).select("expense")
    twice = confirmations.groupBy("expense").count().where("count > 1").select("expense")
    return missing.union(twice).distinct()


def keepers(counts: DataFrame, components: DataFrame, ranks: DataFrame) -> DataFrame:
    """expense, component, keeper, kept, total: the source with most records, of equals the earliest published."""
    sized = (components if "n" in components.columns else components.join(counts, ["expense", "source"])).join(ranks, "source")
    # the greatest count, then the least rank
    best = F.min_by("source", F.struct((-F.col("n")).alias("n"), F.col("rank")))
    return sized.groupBy("expense", "component").agg(best.alias("keeper"), F.max("n").alias("kept"), F.sum("n").alias("total"))


def merge_repeats(records: DataFrame, sources: DataFrame, confirmations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept records with `repeats`, tally of one row).

    records: record, source, expense, location. sources: source, posted. repeats: the dropped records' (source, location) in
    order of publication. The tally counts expenses and records: merged by the rule, left unmerged, merged and kept apart
    by confirmations.
    """
    counts, ranks = expense_counts(records), publish_ranks(sources)
    declared = confirmations is not None
    if declared:
        automatic, final = _declared_components(counts, confirmations)
    else:
        automatic = final = repost_components(counts)
    best = keepers(counts, final, ranks)
    placed = records.join(final.drop("n"), ["expense", "source"]).join(best.select("expense", "component", "keeper"), ["expense", "component"])
    others = placed.where("source <> keeper").join(ranks, "source").groupBy("expense", "component").agg(F.array_sort(F.collect_list(F.struct("rank", "record", "source", "location"))).alias("dropped"))
    repeats = F.coalesce(F.transform("dropped", lambda d: F.struct(d["source"].alias("source"), d["location"].alias("location"))), F.array().cast("array<struct<source:string,location:string>>"))
    kept = placed.where("source = keeper").join(others, ["expense", "component"], "left").select("record", "source", "expense", "location", repeats.alias("repeats"))

    sized = lambda c, *more: c.groupBy("expense", "component").agg(F.sum("n").alias("total"), F.max("n").alias("kept")).groupBy("expense").agg(F.sum(F.col("total") - F.col("kept")), *more)
    each = sized(final, F.sum("total"), F.max("kept")).toDF("expense", "dropped", "total", "most")
    if declared:
        joins = confirmations.where("decision = 'same_expense'").select("expense", F.lit(True).alias("joins"))
        parted = confirmations.where("decision = 'separate_expenses'").select("expense", F.explode("sources").alias("keeper"))
        separated = parted.join(best, ["expense", "keeper"]).groupBy("expense").agg((F.sum("kept") - F.max("kept")).alias("separated"))
        each = each.join(sized(automatic).toDF("expense", "automatic"), "expense").join(joins, "expense", "left").join(separated, "expense", "left")
        each = each.withColumn("merged", F.when(F.coalesce("joins", F.lit(False)), F.col("automatic")).otherwise(F.col("dropped"))).withColumn("separated", F.coalesce("separated", F.lit(0)))
    else:
        each = each.withColumn("merged", F.col("dropped")).withColumn("separated", F.lit(0))
    each = each.withColumn("confirmed", F.col("dropped") - F.col("merged")).withColumn("unmerged", F.col("total") - F.col("dropped") - F.col("most") - F.col("separated"))
    sums = [x for name, out in (("merged", "merged"), ("unmerged", "unmerged"), ("confirmed", "confirmed"), ("separated", "separate")) for x in (F.count_if(F.col(name) > 0).alias(f"{out}_expenses"), F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(f"{out}_records"))]
    return kept, each.agg(*sums)


def repeated_counts(records: DataFrame, kept: DataFrame) -> DataFrame:
    """source, candidates, kept, repeated: how many of a source's records were dropped as repeats."""
    before, after = records.groupBy("source").agg(F.count("*").alias("candidates")), kept.groupBy("source").agg(F.count("*").alias("kept"))
    rows = before.join(after, "source", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
    return rows.withColumn("repeated", F.col("candidates") - F.col("kept"))


def contradictions(components: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Expenses whose components join two sources that a confirmation keeps apart."""
    apart = confirmations.where("decision = 'separate_expenses'").select("expense", F.explode("sources").alias("source"))
    return components.join(apart, ["expense", "source"]).groupBy("expense", "component").count().where("count > 1").select("expense").distinct()


def first_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_turn", turn).where("_turn = 1").drop("_turn")


def batches(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of at most `size` rows, for calls to services from the driver."""
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held
