"""Reported citations of an article compared with recorded citation events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import rules
from linkloom.functions.identifiers import doi_key
from linkloom.functions.papers import once
from linkloom.operators.joins import in_all_partitions, lookup_join
from linkloom.session import stored


def citation_links(events: DataFrame, relations: Sequence[str] = tuple(rules.CITATION_RELATIONS)) -> DataFrame:
    """Distinct ``(subj_id, obj_id)`` of the events whose relation is a citation."""
    cited = _cited(events, relations).select("subj_id", "obj_id")
    return in_all_partitions(cited, "subj_id", "obj_id").distinct()


def _cited(events: DataFrame, relations: Sequence[str] = tuple(rules.CITATION_RELATIONS)) -> DataFrame:
    return events.filter(F.col("relation_type_id").isin(*relations))


def citation_events_for(articles: DataFrame, events: DataFrame) -> DataFrame:
    """``(article_key, cited, as_subject)``: the other end of each event an article takes part in."""
    subject, object_ = F.col("subj_id"), F.col("obj_id")
    # both ends of a link in one pass over the links
    ends = F.array(
        F.struct(doi_key(subject).alias("article_key"), object_.alias("other"), F.lit(True).alias("as_subject")),
        F.struct(doi_key(object_).alias("article_key"), subject.alias("other"), F.lit(False).alias("as_subject")),
    )
    sides = citation_links(events).select(F.explode(ends).alias("end")).select("end.*")
    return lookup_join(sides, articles.select("article_key").distinct(), "article_key", "left_semi")


def _contained(inner: Column, outer: Column) -> Column:
    """Every element of ``inner`` occurs within the text of some element of ``outer``."""
    rest = F.array_except(inner, outer)
    return F.forall(rest, lambda one: F.exists(outer, lambda other: F.contains(other, one)))


def same_citations(reported: Column, events: Column) -> Column:
    """Loose equality of two short list columns: equally long, each entry contained in one of the other.

    The work grows with the product of the lengths; ``compare_citations`` does the same with rows.
    """
    left = F.transform(reported, lambda d: F.lower(d))
    right = F.transform(events, lambda d: doi_key(d))
    return (F.size(reported) == F.size(events)) & _contained(left, right) & _contained(right, left)


def _line(article: str, cited: str) -> Column:
    """Digest of a report line."""
    return F.sha2(F.concat_ws("\u001f", article, cited), 256)


#: Length of the pieces of entries by which contained entries are found.
GRAM = 5


def _grams(text: Column, length: Column) -> Column:
    """All pieces of a text that have the given length, each once."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    return F.when(F.length(text) >= length, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, length))))


def _faced(left: str, right: str) -> Column:
    """``(differ, ends)``: whether an entry is too long to lie in any other, else what is left to search, by side."""

    # what is used for every entry is bound by once(), since Spark would work it out for every entry
    def side(number: int, mine: str, other: str) -> Column:
        def with_rest(rest: Column) -> Column:
            return once(F.array_min(F.transform(rest, lambda e: F.length(e))), lambda shortest: with_shortest(rest, shortest))

        def with_shortest(rest: Column, shortest: Column) -> Column:
            longer = F.filter(other, lambda o: F.length(o) > shortest)
            return once(longer, lambda others: with_others(rest, shortest, others))

        def with_others(rest: Column, shortest: Column, others: Column) -> Column:
            longest = F.coalesce(F.array_max(F.transform(others, lambda o: F.length(o))), F.lit(0))
            differ = once(longest, lambda most: F.exists(rest, lambda e: F.coalesce(F.length(e) >= most, F.lit(True))))
            names = {"side": F.lit(number), "rest": rest, "others": others, "has_short": shortest < GRAM, "differ": differ}
            return F.struct(*[value.alias(name) for name, value in names.items()])

        return once(F.array_except(mine, other), with_rest)

    def outcome(ends: Column) -> Column:
        differ = F.exists(ends, lambda e: e["differ"])
        return F.struct(differ.alias("differ"), F.when(~differ, F.filter(ends, lambda e: F.size(e["rest"]) > 0)).alias("ends"))

    return once(F.array(side(0, left, right), side(1, right, left)), outcome)


def unmatched_lines(lists: DataFrame) -> DataFrame:
    """``line`` of the rows ``(line, left, right)`` where an entry lies in no entry of the other list."""
    faced = lists.select("line", _faced("left", "right").alias("faced"))
    known = faced.filter("faced.differ").select("line")
    return known.unionByName(_search(faced.filter("size(faced.ends) > 0").select("line", "faced.ends"))).distinct()


def _search(faced: DataFrame) -> DataFrame:
    """``line`` of ``(line, ends)`` where an entry of a side lies in none of the others of that side.

    Entries that both lists have need no search.  The others of a list are indexed by their pieces
    of ``GRAM`` characters; an entry is looked up by that of its own pieces which the fewest entries of the
    other list hold, and only those are read whole.  Every piece is a key of its own, so a list of
    any length is compared by all tasks.  Shorter entries are a piece themselves, for which lists that face
    such entries are indexed as well.
    """
    sides = stored(faced.select("line", F.explode("ends").alias("end")).select("line", "end.*"))

    def key(piece: str) -> Column:
        return F.xxhash64("line", "side", piece).alias("key")

    others = sides.select("line", "side", F.explode("others").alias("other"), "has_short")
    lengths = F.when(F.col("has_short"), F.sequence(F.lit(0), F.lit(GRAM))).otherwise(F.array(F.lit(GRAM)))
    pieces = F.explode(F.flatten(F.filter(F.transform(lengths, lambda n: _grams(F.col("other"), n)), lambda g: g.isNotNull())))
    index = others.select("line", "side", "other", pieces.alias("piece")).select("line", "other", key("piece"))
    holders = index.groupBy("key").agg(F.count(F.lit(1)).alias("holders"))

    ones = sides.select("line", "side", F.explode("rest").alias("one"))
    own = F.when(F.length("one") < GRAM, F.array("one")).otherwise(_grams(F.col("one"), F.lit(GRAM)))
    looked_up = ones.select("line", "side", "one", F.explode_outer(own).alias("piece")).select("line", "side", "one", key("piece"))
    looked_up = looked_up.join(holders, "key", "left")
    rarest = F.min(F.struct(F.coalesce("holders", F.lit(0)).alias("holders"), "key")).alias("rarest")
    looked_up = looked_up.groupBy("line", "side", "one").agg(rarest).select("line", "one", F.col("rarest.key").alias("key"))

    entries = index.select(F.col("line").alias("_line"), F.col("key").alias("_key"), "other")
    within = (
        (F.col("key") == F.col("_key"))
        & (F.col("line") == F.col("_line"))
        & (F.length("other") > F.length("one"))
        & F.contains(F.col("other"), F.col("one"))
    )
    return looked_up.join(entries, within, "left_anti").select("line")


def compare_citations(report: DataFrame, events: DataFrame) -> DataFrame:
    """Per article: reported and recorded citations, their numbers, whether they agree.

    Loose equality: lists of the same length, each entry contained in one of the other list.
    ``report(article_doi, cited)``; the recorded list holds what the article cites, then what
    cites it, each sorted.  Adds the two difference lists, compared without the resolver prefix.
    """
    keyed = report.withColumn("article_key", doi_key(F.col("article_doi")))
    found = citation_events_for(keyed, events)
    lists = found.groupBy("article_key").agg(
        F.sort_array(F.collect_set(F.when(F.col("as_subject"), F.col("other")))).alias("subj"),
        F.sort_array(F.collect_set(F.when(~F.col("as_subject"), F.col("other")))).alias("obj"),
    )
    lists = lists.select("article_key", F.array_union("subj", "obj").alias("recorded"))
    joined = lookup_join(keyed, lists, "article_key")
    empty = F.array().cast("array<string>")
    joined = joined.withColumn("recorded", F.coalesce("recorded", empty))
    joined = joined.withColumn("line", _line("article_doi", "cited"))
    reported, recorded = F.col("cited"), F.col("recorded")
    as_long = F.size(reported) == F.size(recorded)
    joined = joined.withColumn("left", F.transform(reported, lambda d: F.lower(d)))
    joined = joined.withColumn("right", F.transform(recorded, lambda d: doi_key(d)))
    joined = joined.withColumn("faced", F.when(as_long, _faced("left", "right")))
    # the lists are built once, and only the lines with something to search for are moved again
    joined = stored(joined.select("article_doi", "cited", "recorded", "line", "faced"))
    to_search = F.coalesce(F.size("faced.ends") > 0, F.lit(False))
    searched = joined.filter(to_search)
    differ = _search(searched.select("line", "faced.ends")).distinct().withColumn("_differs", F.lit(True))
    settled = joined.filter(~to_search).withColumn("_differs", F.lit(None).cast("boolean"))
    joined = settled.unionByName(searched.join(differ, "line", "left"))
    reported_keys = F.transform(reported, lambda d: doi_key(d))
    recorded_keys = F.transform(recorded, lambda d: doi_key(d))
    return joined.select(
        "article_doi",
        F.array_join(reported, ",").alias("reported"),
        F.size(reported).alias("reported_count"),
        F.array_join(recorded, ",").alias("events"),
        F.size(recorded).alias("events_count"),
        (as_long & ~F.coalesce("faced.differ", F.lit(False)) & F.col("_differs").isNull()).alias("same"),
        (F.size(reported) - F.size(recorded)).alias("count_difference"),
        F.array_join(F.array_except(reported_keys, recorded_keys), ",").alias("only_reported"),
        F.array_join(F.array_except(recorded_keys, reported_keys), ",").alias("only_events"),
    )


def citation_differences(report: DataFrame, events: DataFrame) -> DataFrame:
    """``(article_key, cited_key, reported, recorded)``: every pair either side knows, and which.

    The long form of the comparison.  No list is built, so an article with any number of
    citations stays spread over all tasks.
    """
    keyed = report.withColumn("article_key", doi_key(F.col("article_doi")))
    reported = keyed.select("article_key", F.explode("cited").alias("doi"), F.lit(True).alias("reported"))
    recorded = citation_events_for(keyed, events).select(
        "article_key", F.col("other").alias("doi"), F.lit(False).alias("reported")
    )
    pairs = reported.unionByName(recorded).withColumn("cited_key", doi_key(F.col("doi")))
    return pairs.groupBy("article_key", "cited_key").agg(
        F.max("reported").alias("reported"), F.max(~F.col("reported")).alias("recorded")
    )


def in_events(pairs: DataFrame, events: DataFrame, present: bool = True) -> DataFrame:
    """Pairs ``(article_doi, dataset_doi)`` that are (or are not) recorded as a citation."""
    # links that repeat change neither a semi nor an anti join
    links = _cited(events).select(doi_key(F.col("subj_id")).alias("_article"), doi_key(F.col("obj_id")).alias("_dataset"))
    match = (doi_key(pairs["article_doi"]) == links["_article"]) & (doi_key(pairs["dataset_doi"]) == links["_dataset"])
    return pairs.join(links, match, "left_semi" if present else "left_anti")


def missing_citations(report: DataFrame, events: DataFrame) -> DataFrame:
    """Per reported article: its citations and those not recorded with it as subject.

    A report line is taken apart into its entries, which carry a digest of the line and not the
    list, and each entry is joined by itself, so the events of a busy article are never gathered.
    Equal report lines give one row.
    """
    entries = report.select(_line("article_doi", "cited").alias("line"), "article_doi", F.posexplode_outer("cited").alias("pos", "dataset_doi"))
    entries = entries.withColumns(
        {"_article": doi_key(F.col("article_doi")), "_dataset": doi_key(F.col("dataset_doi"))}
    )
    # on one text key that the aggregate below does not have yet, so that a hot pair is split
    pair = F.concat("_article", F.lit("\u001f"), "_dataset").alias("_pair")
    links = _cited(events).select(doi_key(F.col("subj_id")).alias("_article"), doi_key(F.col("obj_id")).alias("_dataset"))
    links = in_all_partitions(links.select(pair), "_pair").distinct().withColumn("_found", F.lit(True))
    checked = lookup_join(entries.select("line", "article_doi", "pos", "dataset_doi", pair), links, "_pair")
    entry = F.struct("pos", "dataset_doi", F.col("_found").isNull().alias("absent"))
    # a set: the entries of equal lines are the same
    lines = checked.groupBy("line", "article_doi").agg(
        F.sort_array(F.collect_set(F.when(F.col("pos").isNotNull(), entry))).alias("cited")
    )
    lines = lines.withColumn("absent", F.filter("cited", lambda e: e["absent"]))

    def text(entries: str) -> Column:
        return F.array_join(F.transform(entries, lambda e: e["dataset_doi"]), ", ")

    return lines.select(
        "article_doi",
        text("cited").alias("reported"),
        F.size("cited").alias("reported_count"),
        text("absent").alias("missing"),
        F.size("absent").alias("missing_count"),
        (F.size("cited") - F.size("absent")).alias("found_count"),
    )
